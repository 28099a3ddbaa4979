"""Spark session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings the plans in this package are written for.  AQE measures shuffle
# output at run time, coalesces small partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def spark_session(app: str = "sessionvol", master: str | None = None, **conf: str) -> SparkSession:
    """A session with SETTINGS; keyword arguments use '__' for '.' in a setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def with_settings(spark: SparkSession, **values: str | int) -> Iterator[None]:
    """The session's settings changed for the jobs inside, then as they were; keyword arguments use '__' for '.'."""
    values = {name.replace("__", "."): str(value) for name, value in values.items()}
    former = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in former.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


_folders: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="sessionvol-", dir="/tmp")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before.

    All paths of an application lie in one folder, to be removed when it has ended.
    """
    application = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark).rstrip('/')}/{application}/{label}-{uuid.uuid4().hex}"
    _folders.append(folder)
    return folder


def folders_since(mark: int = 0) -> list[str]:
    """The paths that ``new_folder`` has given out, from the ``mark``-th on, that were not removed."""
    return [f for f in _folders[mark:] if f]


def folder_mark() -> int:
    """Where ``folders_since`` begins for folders that are made from now on."""
    return len(_folders)


def remove_folders(spark: SparkSession, *folders: str) -> None:
    """Remove intermediate tables that nothing reads any more; only paths that ``new_folder`` has given out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in folders:
        if folder not in _folders:
            raise ValueError(f"{folder} is not a folder of this application")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        _folders[_folders.index(folder)] = ""


def settle(df: DataFrame) -> DataFrame:
    """Compute once and keep as a table in the shared folder, so that later passes and
    lost executors do not start again from the source.

    Parquet keeps large frames small, lets later passes read single columns, and gives
    the planner the true size.
    """
    folder = new_folder(df.sparkSession, "settled")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def settle_measured(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """``settle``, with aggregates over the rows taken on the way."""
    watch = Observation()
    named = [measure.alias(name) for name, measure in measures.items()]
    return settle(df.observe(watch, *named)), watch.get
