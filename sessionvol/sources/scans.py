"""Typed scans of the raw tables, with pruning bounds."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sessionvol.schemas import RAW

# Derived partition column of a raw table, and the column it is derived from.
PARTITIONED_BY = {"intraday_bars": ("bar_month", "bar_time"), "daily_bars": ("trade_year", "trade_date")}

CSV_TIME = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"  # fractions are optional when read, always written
_CSV = {"header": True, "timestampNTZFormat": CSV_TIME, "dateFormat": "yyyy-MM-dd", "mode": "FAILFAST"}


def partition_number(relation: str, moment: date | datetime | str) -> int:
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return moment.year * 100 + moment.month if relation == "intraday_bars" else moment.year


def read_csv(spark: SparkSession, relation: str, *paths: str, absent_is_empty: bool = False) -> DataFrame:
    """CSV files with a header; a header that differs from the schema is an error.

    ``absent_is_empty``: a folder that is not there has no rows, as ``write_csv`` leaves none behind.
    """
    try:
        return spark.read.schema(RAW[relation]).options(enforceSchema=False, **_CSV).csv(list(paths))
    except AnalysisException as error:
        if absent_is_empty and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], RAW[relation])
        raise


def read_raw(
    spark: SparkSession,
    relation: str,
    path: str | None = None,
    table: str | None = None,
    start: date | datetime | str | None = None,
    end: date | datetime | str | None = None,
) -> DataFrame:
    """A raw table as written by ``write_raw``, from a folder or the catalogue.

    ``start`` (inclusive) and ``end`` (exclusive) bound the time column and, so that
    whole partitions are skipped, the partition column as well.
    """
    schema = RAW[relation]
    part, moment = PARTITIONED_BY.get(relation, (None, None))
    if table:
        df = spark.table(table)
        missing = set(schema.fieldNames()) - set(df.columns)
        if missing:
            raise ValueError(f"{table} lacks {sorted(missing)}")
    else:
        stored = StructType([*schema.fields, StructField(part, IntegerType())]) if part else schema
        df = spark.read.schema(stored).parquet(path)
    if (start or end) and not part:
        raise ValueError(f"{relation} has no time bounds")
    kind = schema[moment].dataType.simpleString() if part else None
    if start:
        df = df.where(F.col(part) >= partition_number(relation, start))
        df = df.where(F.col(moment) >= F.lit(str(start)).cast(kind))
    if end:
        df = df.where(F.col(part) <= partition_number(relation, end))
        df = df.where(F.col(moment) < F.lit(str(end)).cast(kind))
    return df.select(*schema.fieldNames())
