"""Raw CSV sources (one file or folder per source table).

Read by header with every column as text, keep only the columns the ETL uses, then cast.
Casting uses ``try_cast``/``try_to_timestamp`` so malformed values become null, which is
what the downstream filters expect. Only the reviews are read as ``multiLine`` (their texts contain
newlines inside quotes); the other files can be split into tasks.

* *Position.* With ``position``, every row carries ``POSITION``, a struct (file, block, row) that orders rows as they stand in the files, files by name: a block is read by one task from its first row to its
  last, so the task's row counter orders the rows of a block, and (file, first byte) the blocks. The star's builders use it where the source goes by file order (first row per key, date numbers).
* *Rejects.* What a permissive read hides is kept by ``rejected``: one row for each record of a wrong number of fields, and for each cell whose text no value could be
  made of. ``reject_counts`` counts them by table, column and reason. Empty cells are nulls, not rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etoile.functions.dates import parse_timestamp
from etoile.sources.schemas import RAW_COLUMNS

POSITION = "_position"
MULTILINE = ("reviews",)
DEFAULT_FILES = {name: f"{name}.csv" for name in RAW_COLUMNS}


def _reader(spark: SparkSession, table: str):
    return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
            .option("multiLine", table in MULTILINE).option("mode", "PERMISSIVE"))


def _place() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def _value(name: str, dtype: T.DataType, id_type: str) -> Column:
    """A source column from its text; null if no value can be made of it."""
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return parse_timestamp(c)
    if name.endswith("_id") and not isinstance(dtype, T.IntegerType):
        return c.try_cast(id_type)
    return c if isinstance(dtype, T.StringType) else c.try_cast(dtype)


def read_csv_table(spark: SparkSession, path: str, table: str, id_type: str = "string", position: bool = False) -> DataFrame:
    raw = _reader(spark, table).csv(path)
    cols = [_value(name, dtype, id_type).alias(name) for name, dtype in RAW_COLUMNS[table]]
    return raw.select(*cols, *([_place().alias(POSITION)] if position else []))


_RECORD = "_record"


def rejected(spark: SparkSession, path: str, table: str, id_type: str = "string") -> DataFrame:
    """``(table_name, column_name, reason, value, _position)``: a record of a wrong number of fields (reason ``fields``, no column, the record as value) and
    a cell of the source's columns that no value could be made of (reason ``cast``, the cell as value)."""
    reader = _reader(spark, table)
    header = reader.csv(path).schema
    # the parser only counts fields if it reads them all
    raw = (reader.schema(T.StructType([*header.fields, T.StructField(_RECORD, T.StringType())])).option("columnNameOfCorruptRecord", _RECORD)
           .option("columnPruning", False).csv(path))
    none = F.lit(None).cast("string")
    found = [F.when(F.col(_RECORD).isNotNull(), F.struct(none.alias("column_name"), F.lit("fields").alias("reason"), F.col(_RECORD).alias("value")))]
    found += [F.when(F.col(name).isNotNull() & _value(name, dtype, id_type).isNull(),
                     F.struct(F.lit(name).alias("column_name"), F.lit("cast").alias("reason"), F.col(name).alias("value")))
              for name, dtype in RAW_COLUMNS[table]]
    rows = raw.select(F.explode(F.array_compact(F.array(*found))).alias("r"), _place().alias(POSITION))
    return rows.select(F.lit(table).alias("table_name"), "r.column_name", "r.reason", "r.value", POSITION)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``(table_name, column_name, reason, nb)``."""
    return rejects.groupBy("table_name", "column_name", "reason").agg(F.count(F.lit(1)).alias("nb"))


def read_raw_csv(spark: SparkSession, data_dir: str, files: dict[str, str] | None = None, position: bool = True) -> dict[str, DataFrame]:
    """Read the eight source tables from ``data_dir``; ``files`` maps table -> file name."""
    return {t: read_csv_table(spark, path, t, position=position) for t, path in csv_paths(data_dir, files).items()}


def csv_paths(data_dir: str, files: dict[str, str] | None = None) -> dict[str, str]:
    files = {**DEFAULT_FILES, **(files or {})}
    return {t: f"{data_dir.rstrip('/')}/{files[t]}" for t in RAW_COLUMNS}


def rejected_of_all(spark: SparkSession, data_dir: str, files: dict[str, str] | None = None) -> DataFrame:
    """``rejected`` of the eight sources."""
    return reduce(DataFrame.unionByName, [rejected(spark, path, t) for t, path in csv_paths(data_dir, files).items()])
