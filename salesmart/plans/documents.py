"""Document collection: M1-M15."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import documents, joins, stats
from ..sources.tables import Tables
from . import bindings as b
from .aggregates import RATING_SQL
from .registry import query


def menu(t: Tables) -> DataFrame:
    """Dish documents: the words of the name are the extras."""
    return t.part.select(F.col("p_partkey").alias("_id"), F.col("p_name").alias("plato_principal"),
                         F.expr("CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE split(p_name, ' ') END").alias("ingredientes_extra"),
                         F.col("p_retailprice").cast("decimal(10,2)").alias("precio_base"))


MENU = """menu AS (SELECT p_partkey AS _id, p_name AS plato_principal, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE string_split(p_name, ' ') END AS ingredientes_extra,
      CAST(p_retailprice AS DECIMAL(10,2)) AS precio_base FROM part)"""


@query("m01_find_contains", f"WITH {MENU} SELECT _id, plato_principal FROM menu WHERE list_contains(ingredientes_extra, 'red')")
def _(t: Tables):
    return documents.find_contains(menu(t), "ingredientes_extra", "red").select("_id", "plato_principal")


@query("m02_find_any", f"WITH {MENU} SELECT plato_principal, precio_base::DOUBLE AS precio_base FROM menu WHERE list_has_any(ingredientes_extra, ['bolt','ring'])")
def _(t: Tables):
    return documents.find_any(menu(t), "ingredientes_extra", ["bolt", "ring"], ["plato_principal", "precio_base"])


@query("m03_find_unanswered", b.sql("resenas", "SELECT _id, plato, puntuacion FROM resenas WHERE puntuacion <= 2 AND respuesta_local IS NULL"))
def _(t: Tables):
    return documents.find_unanswered(b.resenas(t), 2).select("_id", "plato", "puntuacion")


@query("m04_find_all_tags", b.sql("resenas", "SELECT _id, plato FROM resenas WHERE list_has_all(etiquetas, ['red','bolt'])"))
def _(t: Tables):
    return documents.find_all_tags(b.resenas(t), ["red", "bolt"]).select("_id", "plato")


@query("m05_find_nested", b.sql("resenas", "SELECT _id, plato FROM resenas WHERE ocasion = 'Cumpleaños'"))
def _(t: Tables):
    return documents.find_nested(b.resenas(t), "visita.ocasion", "Cumpleaños").select("_id", "plato")


@query("m06_count_docs", "SELECT count(*) AS n FROM events")
def _(t: Tables):
    return documents.count_docs(t.events)


@query("m07_find_limit", b.sql("resenas", "SELECT _id, plato, puntuacion FROM resenas WHERE puntuacion <= 2 AND respuesta_local IS NULL ORDER BY _id LIMIT 5"))
def _(t: Tables):
    docs = b.resenas(t).select("_id", "plato", "puntuacion", "respuesta_local")
    hits = documents.find(docs, (F.col("puntuacion") <= 2) & F.col("respuesta_local").isNull(), ["_id"], 5)
    return hits.drop("respuesta_local")


@query("m08_top_rated", b.sql("resenas", """
    SELECT plato, sum(puntuacion)::DOUBLE / count(*) AS promedio, count(*) AS resenas FROM resenas GROUP BY 1 HAVING count(*) >= 50
    ORDER BY 2 DESC, 1 LIMIT 10"""))
def _(t: Tables):
    return documents.top_rated(b.resenas(t), "plato", 50, 10)


@query("m09_by_source", b.sql("resenas", "SELECT fuente, count(*) AS n, sum(puntuacion)::DOUBLE / count(*) AS prom FROM resenas GROUP BY 1"))
def _(t: Tables):
    return documents.by_source(b.resenas(t))


@query("m10_update_one", f"""
    WITH {MENU}, first AS (SELECT min(_id) AS f FROM menu WHERE list_contains(ingredientes_extra, 'red'))
    SELECT _id, CASE WHEN _id = f THEN 26.0 ELSE precio_base::DOUBLE END AS precio_base,
      array_to_string(CASE WHEN _id = f THEN list_append(ingredientes_extra, 'Cancha') ELSE ingredientes_extra END, ' ') AS extras FROM menu, first""")
def _(t: Tables):
    docs = menu(t)
    changed = documents.update_one(
        docs, documents.contains(docs, "ingredientes_extra", "red"), "_id", ["_id"],
        set_={"precio_base": F.lit("26.00").cast("decimal(10,2)")}, push={"ingredientes_extra": "Cancha"})
    return changed.select("_id", "precio_base", F.array_join("ingredientes_extra", " ").alias("extras"))


@query("m11_update_many", b.sql("resenas", "SELECT _id, CASE WHEN puntuacion <= 2 AND respuesta_local IS NOT NULL THEN 1 END AS atendida FROM resenas"))
def _(t: Tables):
    handled = (F.col("puntuacion") <= 2) & F.col("respuesta_local").isNotNull()
    return documents.update_many(b.resenas(t), handled, {"atendida": F.lit(True)}).select("_id", F.col("atendida").cast("int").alias("atendida"))


@query("m12_delete_many", b.sql("resenas", "SELECT _id, plato FROM resenas WHERE NOT puntuacion <= 1"))
def _(t: Tables):
    return documents.delete_where(b.resenas(t), F.col("puntuacion") <= 1).select("_id", "plato")


@query("m12_delete_one", f"WITH {MENU} SELECT _id, plato_principal FROM menu WHERE _id <> (SELECT min(_id) FROM menu WHERE ingredientes_extra IS NULL)")
def _(t: Tables):
    return documents.delete_where(menu(t), F.col("ingredientes_extra").isNull(), "_id", ["_id"]).select("_id", "plato_principal")


@query("m13_tag_counts", b.sql("resenas", "SELECT etiqueta, count(*) AS n FROM (SELECT unnest(etiquetas) AS etiqueta FROM resenas) GROUP BY 1"))
def _(t: Tables):
    return documents.tag_counts(b.resenas(t))


@query("m14_presence_counts", b.sql("resenas", """
    SELECT 'respuesta_local' AS columna, count(respuesta_local) AS presentes FROM resenas UNION ALL SELECT 'etiquetas', count(etiquetas) FROM resenas
    UNION ALL SELECT 'visita', count(ocasion) FROM resenas"""))
def _(t: Tables):
    return stats.presence_counts(b.resenas(t), ["respuesta_local", "etiquetas", "visita"])


@query("m15_rating_vs_sales", b.sql("sales resenas", RATING_SQL + " ORDER BY puntuacion_media DESC, nombre_plato LIMIT 5"))
def _(t: Tables):
    pairs = joins.sales_vs_rating(b.by_dish(t), b.resenas(t))
    return pairs.orderBy(F.desc("puntuacion_media"), "nombre_plato").limit(5)


@query("m15_text_quality", """
    SELECT source, count(*) AS documentos, sum(n_chars)::DOUBLE / count(*) AS largo_medio, sum(quality)::DOUBLE / count(*) AS calidad
    FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def _(t: Tables):
    scored = t.documents.select("doc_id", "source", "n_chars").join(t.labels, "doc_id")
    sums = scored.groupBy("source").agg(F.count(F.lit(1)).alias("documentos"), F.sum("n_chars").cast("double").alias("c"), F.sum("quality").cast("double").alias("q"))
    return sums.select("source", "documentos", (F.col("c") / F.col("documentos")).alias("largo_medio"), (F.col("q") / F.col("documentos")).alias("calidad"))
