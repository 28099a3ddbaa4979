"""What the operators share around Spark: row keys, sizes, and the package on executors."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from functools import partial
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionvol.plans import joins

#: Measured bytes up to which ``lookup_join`` sends a lookup to all tasks here. The driver fetches it, builds its hash table (of texts about twice the bytes) and
#: holds that and its serialized blocks until its garbage is collected, for several lookups one after the other.
LOOKUP_BYTES = 8 << 20
lookup_join = partial(joins.lookup_join, limit=LOOKUP_BYTES)

K1, K2 = "__llm_k1", "__llm_k2"


def ship(spark: SparkSession) -> None:
    """Make this package importable for Python tasks on the executors, once per application."""
    context = spark.sparkContext
    mark = f"sessionvol-{os.getpid()}.zip"
    if mark in str(context._python_includes):
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    target = Path(tempfile.mkdtemp(prefix="sessionvol-code-")) / mark  # the driver serves it to executors
    target.write_bytes(packed.getvalue())
    context.addPyFile(str(target))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two longs that name a row by its id and text; rows equal in both share them."""
    known, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return [
        F.coalesce(known.cast("long"), F.lit(0)).alias(K1),
        F.xxhash64(known.isNull(), text.isNull(), text).alias(K2),
    ]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Row key, id and text as (K1, K2, doc_id, text), NULL text empty."""
    return docs.select(
        *row_key(id_col, text_col),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name like ``wanted`` that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_bytes(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Rows and bytes of text; one aggregation."""
    got = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()
    return got[0], got[1] or 0


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
