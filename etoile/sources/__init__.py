"""Sources and sinks: raw CSV reader, test-table adapter, warehouse parquet sink, SQL views."""

from etoile.sources.testdata import raw_from_testdata, load_test_tables  # noqa: F401
from etoile.sources.csv import read_raw_csv  # noqa: F401
from etoile.sources.warehouse import read_star, register_views, run_sql  # noqa: F401

RAW_TABLES = ("orders", "items", "customers", "products", "sellers", "reviews", "translation", "payments")
