"""etoile: a retail sales star-schema warehouse expressed as Spark DataFrame operators.

Layers:
  sources    raw readers (CSV, test-table adapter), warehouse sink/reader, SQL views
  functions  column-level helpers (exact rounding, date parts, fixed lookup values)
  operators  star builders, data-quality checks, KPIs, dashboard data, mining jobs
  plans      whole jobs (ETL -> parquet -> reports) and the registry of reports
  llm        operators of a training-data pipeline (optional; nothing above imports it)
"""

__all__ = ["session"]
