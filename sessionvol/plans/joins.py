"""Join of a large frame with a lookup whose size is measured first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

from sessionvol.session import settle_measured

BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 8      # salts of a lookup too large to broadcast
MOST_SALTS = 256  # where adaptive execution doesn't split hot keys


def total_bytes(df: DataFrame) -> Column:
    """Aggregate over all rows: measured bytes for texts, 16 for every other (flat) column."""
    sizes = [F.lit(16).cast("bigint")]
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            sizes.append(F.coalesce(F.octet_length(field.name), F.lit(0)).cast("bigint"))
        sizes.append(F.lit(16).cast("bigint"))
    return F.coalesce(F.sum(reduce(Column.__add__, sizes)), F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    """Size of a stored table or settled frame."""
    return df.agg(total_bytes(df).alias("bytes")).first()["bytes"]


def splits_hot_keys(spark: SparkSession) -> bool:
    """Does adaptive execution split a partition of a join that is too large?"""
    return all(spark.conf.get(f"spark.sql.adaptive.{name}", "true") == "true" for name in ("enabled", "skewJoin.enabled"))


def salts_for(size: int, limit: int = BROADCAST_BYTES) -> int:
    """Twice the lookup's size, twice the salts; what is shuffled of the lookup then grows with the square of its size."""
    return max(SALTS, min(MOST_SALTS, SALTS * size // max(1, limit)))


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    size: int | None = None,
    limit: int = BROADCAST_BYTES,
    salts: int | None = None,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Join ``left`` with ``lookup``, which has at most one row per key.

    The lookup is computed once and its bytes are summed; ``size`` says that this was
    done before.  Up to ``limit`` it is broadcast, so the large side is neither shuffled
    nor affected by hot keys.  Beyond it both sides are shuffled by key and salt.  The
    salt is a hash of the ``spread`` columns of ``left`` (default: all flat ones), so it is the same when a task is run
    again and filters on ``left`` still reach its scan.  It spreads a hot key, and as no later grouping can reuse
    that partitioning, adaptive execution is always free to split what is still too large.  The lookup is shuffled once for
    each salt: these are SALTS, unless ``salts`` gives their number, so that what is shuffled grows with the lookup.  Only in a session whose adaptive
    execution doesn't split hot keys do they rise with the lookup's size, up to MOST_SALTS.  ``salts=0``
    joins by key alone, for tables that are stored in shared buckets.

    Runs a job when called, unless ``size`` is given.
    """
    if size is None:
        lookup, facts = settle_measured(lookup, size=total_bytes(lookup))
        size = facts["size"]
    names = list(on)
    if salts is None:
        salts = SALTS if splits_hot_keys(left.sparkSession) else salts_for(size, limit)
    if size <= limit:
        right = F.broadcast(lookup)
    elif salts:
        flat = [f.name for f in left.schema.fields if not isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*(spread or flat)), F.lit(salts)))
        right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        names.append("_salt")
    else:
        right = lookup
    if not null_safe:
        return left.join(right, names, how).drop("_salt")
    right = right.withColumnsRenamed({key: f"_right_{key}" for key in names})
    match = [left[key].eqNullSafe(right[f"_right_{key}"]) for key in names]
    return left.join(right, match, how).drop("_salt", *[f"_right_{key}" for key in names])
