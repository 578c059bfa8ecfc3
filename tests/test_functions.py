import datetime as dt
import unicodedata
from decimal import Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from salesmart.functions import arrays, calendar, masks, money, text

D = Decimal


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_sale_size(spark):
    rows = [(D("200"),), (D("50"),), (None,), (D("150"),)]
    assert values(spark, rows, "m decimal(10,2)", money.sale_size(F.col("m"))) == [
        ("Venta Grande",), ("Venta Pequeña",), ("Sin monto",), ("Venta Pequeña",)]


def test_valid_id(spark):
    rows = [("12345678",), ("1234567",), ("1234567a",), (None,), ("123456789",), ("12345678\n",)]
    got = values(spark, rows, "d string", text.valid_id_flag(F.col("d")))
    assert [r[0] for r in got] == [1, 0, 0, 0, 0, 0]


def test_norm_name_follows_decomposition(spark):
    names = ["  Ceviche Clásico ", "CEBICHE MIXTO", "cebiché de Conchas", "Ñandú", "Ají", "Ｃeviche ḱ", "\tlomo\n", "ÀÉÎõü",
             "ﬁlete", "№ 5", "½ kg", "\u00a0sopa\u3000", "ǆ Ⅷ ㎏", "e\u0301", "日本 ｶﾞ", "ﷺ", "का"]
    def expected(s):
        plain = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
        return plain.lower().strip().replace("cebiche", "ceviche")
    got = values(spark, [(n,) for n in names], "n string", text.norm_name(F.col("n")))
    assert [r[0] for r in got] == [expected(n) for n in names]


@pytest.mark.parametrize(("gross", "pct", "fee"), [("38.50", 25, "9.62"), ("38.70", 25, "9.68"), ("10.00", 19, "1.90")])
def test_commission_half_even(spark, gross, pct, fee):
    rows = [(D(gross), pct)]
    assert values(spark, rows, "g decimal(12,2), p int", money.commission(F.col("g"), F.col("p")))[0][0] == D(fee)
    cents = money.half_even_div(money.cents(F.col("g")) * F.col("p"), 100)
    assert values(spark, rows, "g decimal(12,2), p int", money.units(cents))[0][0] == D(fee)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**4)), min_size=1, max_size=200))
def test_half_even_div(spark, pairs):
    got = values(spark, pairs, "n bigint, d bigint", money.half_even_div(F.col("n"), F.col("d")))
    assert [r[0] for r in got] == [round(Fraction(n, d)) for n, d in pairs]


def test_cents_of_doubles_are_exact(spark):
    rows = [(i / 100,) for i in range(0, 200_000, 7)]
    got = values(spark, rows, "v double", money.cents(F.col("v")))
    assert [r[0] for r in got] == list(range(0, 200_000, 7))


def test_tenure_half_even(spark):
    as_of = dt.date(2026, 9, 28)
    rows = [(as_of - dt.timedelta(days=d),) for d in (76, 0, 15, 16, 46, 380)]
    got = values(spark, rows, "d date", calendar.tenure_months(F.col("d"), as_of))
    assert [r[0] for r in got] == [round(d / 30.4) for d in (76, 0, 15, 16, 46, 380)]
    assert got[0][0] == 2


def test_safe_date(spark):
    rows = [("05/01/2026",), ("5/1/2026",), ("Ayer",), ("No se sabe",), ("31/02/2026",), ("",), (None,)]
    got = values(spark, rows, "d string", calendar.safe_date(F.col("d")))
    assert [r[0] for r in got] == [dt.date(2026, 1, 5), dt.date(2026, 1, 5), None, None, None, None, None]


def test_shift(spark):
    rows = [("11:30",), ("14:59",), ("15:00",), ("17:59",), ("18:00",), ("08:00",), (None,)]
    got = [r[0] for r in values(spark, rows, "h string", calendar.shift_of(F.col("h")))]
    assert got == [calendar.LUNCH, calendar.LUNCH, calendar.AFTERNOON, calendar.AFTERNOON, calendar.NIGHT, calendar.LUNCH, None]


def test_price_band(spark):
    rows = [(D(v),) for v in ("0", "15", "15.01", "30", "40", "40.01", "1000", "1000.01")]
    got = [r[0] for r in values(spark, rows, "p decimal(10,2)", money.price_band(F.col("p")))]
    assert got == [None, "Económico (<=15)", "Medio (16-30)", "Medio (16-30)", "Alto (31-40)", "Premium (>40)", "Premium (>40)", None]


def test_calendar_of_one_day(spark):
    parts = calendar.calendar_parts(F.col("d"))
    got = values(spark, [(dt.date(2025, 10, 1),)], "d date", *[c.alias(n) for n, c in parts.items()])[0]
    assert got == (20251001, dt.date(2025, 10, 1), 2025, 4, 10, "Octubre", "2025-10", 40, 1, 3, "Miércoles", 0)


def test_date_spine_counts_both_ends(spark):
    assert calendar.date_spine(spark, dt.date(2025, 10, 1), dt.date(2026, 12, 31)).count() == 457


def test_ratio_is_null_on_zero(spark):
    assert values(spark, [(1, 0), (1, None), (1, 4)], "a int, b int", money.ratio(F.col("a"), F.col("b"))) == [(None,), (None,), (0.25,)]


def test_masks(spark):
    row = values(
        spark, [("ana@x.pe", "987654321", D("1800"), None)], "e string, t string, s decimal(10,2), n string",
        masks.mask_email(F.col("e")), masks.mask_partial(F.col("t"), 0, "XXXXX", 4),
        masks.mask_default(F.col("s"), T.DecimalType(10, 2)), masks.hash_id(F.col("n"), "salt"))[0]
    assert row == ("aXXX@XXXX.com", "XXXXX4321", D("0.00"), None)


def test_pad_and_labels(spark):
    row = values(spark, [("123", "123456789", 7, 123456)], "a string, b string, c int, d int",
                 text.pad_id(F.col("a")), text.pad_id(F.col("b")), text.customer_label(F.col("c")), text.customer_label(F.col("d")))[0]
    assert row == ("00000123", "23456789", "C-00007", "C-123456")


def test_counter_text_prints_null_as_empty(spark):
    assert values(spark, [(1, None)], "a int, b int", text.counter_text(x=F.col("a"), y=F.col("b"))) == [("x=1; y=",)]


def test_differs_lets_null_pass(spark):
    rows = [(D("1.00"), D("1.01")), (D("1.00"), D("1.02")), (None, D("1"))]
    got = [r[0] for r in values(spark, rows, "a decimal(10,2), b decimal(10,2)", money.differs(F.col("a"), F.col("b")))]
    assert got == [False, True, False]


def test_arrays(spark):
    rows = [(["a", "b"],), (None,), ([],)]
    got = values(spark, rows, "t array<string>", arrays.has_all(F.col("t"), ["a", "b"]), arrays.push(F.col("t"), "z"))
    assert got == [(True, ["a", "b", "z"]), (False, ["z"]), (False, ["z"])]


def test_whole_number_rounding_of_refunds(spark):
    from decimal import ROUND_HALF_EVEN, Decimal

    pairs = [(n, d) for n in range(-260, 261) for d in (1, 2, 3, 7, 100)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for n, d, got in df.select("n", "d", money.half_even_div(F.col("n"), F.col("d"))).collect():
        assert got == int((Decimal(n) / Decimal(d)).quantize(Decimal(1), ROUND_HALF_EVEN)), (n, d)


def test_names_of_every_script_are_normalised_as_by_the_rule(spark):
    import unicodedata

    names = ["Cebiche Clásico", "  LOMO saltado\t", "ﬁdeos ½ ㎏", "Ｃｅｂｉｃｈｅ", "ñandú", "é", "", "ŉ 'x' \\ |", "日本 ㍿", "a "]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    got = [r[0] for r in df.select(text.norm_name(F.col("n"))).collect()]
    plain = ["".join(c for c in unicodedata.normalize("NFKD", n) if not unicodedata.combining(c)).lower().strip() for n in names]
    assert got == [p.replace("cebiche", "ceviche") for p in plain] + [None]
