from . import access, audit, documents, intake, joins, measures, olap, quality, stats, volume, warehouse, windows  # noqa: F401
