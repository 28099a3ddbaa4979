"""CSV files, partitioned raw tables and sorted mart tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from sessionvol.schemas import RAW, SORTED_BY
from sessionvol.sources.scans import CSV_TIME, PARTITIONED_BY


def write_csv(df: DataFrame, path: str, relation: str, mode: str = "error") -> bool:
    """CSV files with a header and no index; an empty frame writes nothing."""
    if df.isEmpty():
        return False
    options = {"header": True, "timestampNTZFormat": CSV_TIME, "dateFormat": "yyyy-MM-dd"}
    df.select(*RAW[relation].fieldNames()).write.mode(mode).options(**options).csv(path)
    return True


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by ``columns``.

    A range splits a hot leading column on the following ones.  The number of the input
    partition as last range column also splits rows that agree in all of them; it is the
    same when a task is run again.
    """
    ranged = df.withColumn("_spread", F.spark_partition_id())
    bounds = [*columns, "_spread"]
    ranged = ranged.repartitionByRange(partitions, *bounds) if partitions else ranged.repartitionByRange(*bounds)
    return ranged.sortWithinPartitions(*columns).drop("_spread")


def with_partition(df: DataFrame, relation: str) -> DataFrame:
    part, moment = PARTITIONED_BY[relation]
    number: Column = F.year(moment)
    if relation == "intraday_bars":
        number = number * 100 + F.month(moment)
    return df.withColumn(part, number.cast("int"))


def raw_writer(
    df: DataFrame, relation: str, mode: str = "overwrite", partitions: int | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrameWriter:
    """Writer of a raw table: bars by month, days by year, sorted by ticker and time inside.

    ``partitions`` is the number of range partitions (default: the session's shuffle
    partitions); aim at a few hundred MB each.  ``watch`` is applied to the rows as they are written.
    """
    rows = ordered_raw(df.select(*RAW[relation].fieldNames()), relation, partitions)
    ready = (watch(rows) if watch else rows).write.mode(mode)
    return ready.partitionBy(PARTITIONED_BY[relation][0]) if relation in PARTITIONED_BY else ready


def ordered_raw(df: DataFrame, relation: str, partitions: int | None = None) -> DataFrame:
    """Rows in the order of a raw table's files, with its partition column."""
    if relation not in PARTITIONED_BY:
        return clustered(df, SORTED_BY[relation], partitions)
    columns = (PARTITIONED_BY[relation][0], *SORTED_BY[relation])
    return clustered(with_partition(df, relation), columns, partitions)


def without_rows_of(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``old`` that are equal to none of ``new``, NULLs equal to each other."""
    one = new.select(*[F.col(c).alias(f"_new_{c}") for c in old.columns]).distinct()
    return old.join(one, [F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in old.columns], "left_anti")


def write_raw(
    df: DataFrame, relation: str, path: str, mode: str = "overwrite", partitions: int | None = None
) -> str:
    raw_writer(df, relation, mode, partitions).parquet(path)
    return path
