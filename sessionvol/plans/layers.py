"""Raw tables, staging relations and marts, one database per layer."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sessionvol.functions.clock import UTC_SESSION, TradingSession
from sessionvol.operators import curves, staging
from sessionvol.operators.normalize import normalized_volume
from sessionvol.operators.quality import quality_checks, watched, watched_checks
from sessionvol.operators.volatility import daily_volatility
from sessionvol.schemas import RAW
from sessionvol.plans.joins import BROADCAST_BYTES, measured_bytes
from sessionvol.sources.scans import PARTITIONED_BY, read_raw
from sessionvol.session import settle
from sessionvol.sources.sinks import ordered_raw, raw_writer, with_partition, without_rows_of

LAYERS = ("raw", "staging", "marts")

# Mart -> columns its table is sorted by.
MARTS = {
    "mart_normalized_volume": ("ticker", "bar_time"),
    "mart_daily_volatility": ("ticker", "trade_date"),
    "mart_volume_curve": ("minutes_since_open",),
    "mart_volume_curve_by_sector": ("sector", "minutes_since_open"),
    "mart_volume_curve_by_market_cap": ("market_cap_band", "minutes_since_open"),
    "mart_volume_curve_by_vol_regime": ("vol_regime", "minutes_since_open"),
}


# Marts with a row per bar or day.
LONG_MARTS = ("mart_normalized_volume", "mart_daily_volatility")

# The volatility once for each hour of the session: joined with the bars in shared buckets, where it is too large to broadcast.
BY_HOUR = "mart_daily_volatility_by_hour"

# Table -> columns it is sorted by in shared buckets of SHARED.
SHARED = ("ticker", "trade_date", "bar_hour")
BUCKETED = {"mart_normalized_volume": (*SHARED, "bar_time"), BY_HOUR: SHARED}

# Mart -> relation whose rules are counted while it is written: it has one row for each of that relation's rows.
WATCHED = {"mart_normalized_volume": "stg_intraday_bars", "mart_daily_volatility": "mart_daily_volatility"}

# Time of the load, for rows inserted without one.
_NOW = "cast(to_utc_timestamp(current_timestamp(), current_timezone()) as timestamp_ntz)"
_STAMPS = ("ingested_at", "fetched_at")


def database_name(layer: str | None, default: str, prefix: str = "") -> str:
    """The layer's name as given, without blanks around it; the default where there is none."""
    return prefix + (layer.strip() if layer is not None else default)


@dataclass
class Layers:
    """Names and builds the relations of all layers.

    ``prefix`` is put before the database names; ``location`` is a folder for the
    databases (default: the session's warehouse).  Every build replaces what was there.

    A mart is written to a folder of its own version first and then published by one change of its table's location, so its former
    rows can be read during a build and after one that failed.  The version before the present one is kept for readers that began with it.

    ``partitions`` is the number of range partitions of the raw tables of bars and days.  ``buckets`` stores the
    bars in that many buckets of (ticker, trade_date, bar_hour).  Where the volatility is too large to broadcast, it is stored
    in the same buckets, once for each hour, and the regime curve reads both without a shuffle; the hour spreads
    a ticker-day over several buckets, so that no task gets all bars of a hot one.
    ``together`` builds the four curves from two passes over the bars instead of eight; it pays where reading the bars is most of
    the work.
    """

    spark: SparkSession
    prefix: str = ""
    location: str | None = None
    session: TradingSession = UTC_SESSION
    precision: int | None = None
    partitions: int | None = None
    buckets: int | None = None
    together: bool = False
    _watches: dict[str, Observation] = field(default_factory=dict, repr=False)

    def _watch(self, df: DataFrame, relation: str) -> DataFrame:
        df, watch = watched(df, relation, self.session)
        if watch:
            self._watches[relation] = watch
        return df

    def name(self, layer: str, relation: str) -> str:
        return f"{database_name(layer, 'default', self.prefix)}.{relation}"

    def create_databases(self) -> None:
        for layer in LAYERS:
            database = database_name(layer, "default", self.prefix)
            place = f" LOCATION '{self.location}/{database}'" if self.location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")

    def create_raw_tables(self) -> None:
        """Empty raw tables where there are none, with comments and a default load time."""
        for relation, schema in RAW.items():
            columns = [
                f"`{f.name}` {f.dataType.simpleString()}"
                + (f" DEFAULT {_NOW}" if f.name in _STAMPS else "")
                + f" COMMENT '{f.metadata['comment'].replace(chr(39), chr(92) + chr(39))}'"
                for f in schema.fields
            ]
            part = PARTITIONED_BY.get(relation, (None,))[0]
            if part:
                columns.append(f"`{part}` int")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name('raw', relation)} ({', '.join(columns)}) USING parquet"
                + (f" PARTITIONED BY ({part})" if part else "")
            )

    def load_raw(self, relation: str, df: DataFrame, mode: str = "overwrite") -> None:
        """Write a raw table; ``mode='append'`` adds a load to it.

        ``mode='merge'`` adds a load so that months or years stay in order: the partitions it has rows of are written anew from old and new rows,
        range-sorted together; the others are not touched.  Stored rows that are equal to one of the load give way to it, so a load may be
        repeated.
        """
        partitions = self.partitions if relation in PARTITIONED_BY else None
        name = self.name("raw", relation)
        if mode != "merge" or not self.spark.catalog.tableExists(name):
            kind = "overwrite" if mode == "merge" else mode
            raw_writer(df, relation, kind, partitions, lambda rows: self._watch(rows, f"raw_{relation}")).saveAsTable(name)
            return
        new = settle(with_partition(df.select(*RAW[relation].fieldNames()), relation) if relation in PARTITIONED_BY else df)
        old = self.spark.table(name)
        if relation not in PARTITIONED_BY:
            merged = settle(without_rows_of(old, new).unionByName(new))
            raw_writer(merged, relation, "overwrite").saveAsTable(name)
            return
        part = PARTITIONED_BY[relation][0]
        touched = [row[part] for row in new.select(part).distinct().collect()]  # months or years
        same = F.col(part).isin([p for p in touched if p is not None])
        old = old.where(same | F.col(part).isNull() if None in touched else same)
        # Stored first: Spark doesn't write to a table that it reads.
        merged = settle(without_rows_of(old, new).unionByName(new))
        frame = ordered_raw(merged.select(*RAW[relation].fieldNames()), relation, partitions)
        # The setting, as Spark looks for no option of that name when it inserts; only the partitions with rows are replaced.
        setting = "spark.sql.sources.partitionOverwriteMode"
        former = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            frame.write.insertInto(name, overwrite=True)
        finally:
            self.spark.conf.set(setting, former)
        self.spark.catalog.refreshTable(name)

    def raw(self, relation: str, **bounds) -> DataFrame:
        return read_raw(self.spark, relation, table=self.name("raw", relation), **bounds)

    def table(self, layer: str, relation: str) -> DataFrame:
        return self.spark.table(self.name(layer, relation))

    def build_staging(self) -> None:
        """Three views; nothing is computed."""
        columns = ", ".join(f"{text} as `{c}`" for c, text in staging.intraday_columns(self.session).items())
        views = {
            "stg_intraday_bars": f"SELECT {columns} FROM {self.name('raw', 'intraday_bars')} "
                                 f"WHERE {staging.intraday_condition(self.session)}",
            "stg_daily_bars": staging.daily_sql(self.name("raw", "daily_bars")),
            "stg_ticker_metadata": staging.metadata_sql(self.name("raw", "ticker_metadata")),
        }
        for view, text in views.items():
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.name('staging', view)} AS {text}")

    def _save(self, df: DataFrame, layer: str, relation: str, order: tuple[str, ...]) -> None:
        """Every file is sorted by ``order``.  Bars and days are sorted in the partitions they come in, which
        needs no pass to find ranges: bars come by month and ticker from the raw table, days by blocks of a ticker.  A curve has a row
        per group and minute of the session and is one file."""
        if self.buckets and relation in BUCKETED:
            ready = df.repartition(self.buckets, *SHARED).sortWithinPartitions(*BUCKETED[relation])
            ready = self._watch(ready, WATCHED.get(relation, ""))
            writer = ready.write.bucketBy(self.buckets, *SHARED).sortBy(*SHARED)
        elif relation in LONG_MARTS:
            writer = self._watch(df.sortWithinPartitions(*order), WATCHED[relation]).write
        else:
            writer = df.repartition(1).sortWithinPartitions(*order).write
        self._publish(writer, layer, relation)

    def _publish(self, writer, layer: str, relation: str) -> None:
        """Write a new version beside the present one, then switch to it."""
        name, version = self.name(layer, relation), uuid.uuid4().hex
        database = database_name(layer, "default", self.prefix)
        home = self.spark.catalog.getDatabase(database).locationUri.rstrip("/")
        folder, beside = f"{home}/{relation}_versions/{version}", f"{name}__{version}"
        try:
            writer.format("parquet").option("path", folder).saveAsTable(beside)
            if not self._alike(name, beside):
                # The first build, or other columns or buckets: the table itself changes.
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                self.spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
            else:
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        except BaseException:
            self._remove_folder(folder)
            raise
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {beside}")
        self.spark.catalog.refreshTable(name)
        self._retire(f"{home}/{relation}_versions", folder)

    def _described(self, name: str) -> dict[str, str]:
        return {row[0]: row[1] for row in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}

    def _alike(self, name: str, other: str) -> bool:
        """Are both external tables with equal columns, buckets and sort columns?"""
        if not self.spark.catalog.tableExists(name):
            return False
        here, there = self._described(name), self._described(other)
        facts = ("Type", "Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
        same = all(here.get(f) == there.get(f) for f in facts)
        return same and here["Type"] == "EXTERNAL" and self.spark.table(name).schema == self.spark.table(other).schema

    def _files(self, folder: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _remove_folder(self, folder: str) -> None:
        system, path = self._files(folder)
        system.delete(path, True)

    def _retire(self, versions: str, present: str) -> None:
        """Remove all versions but the present one and the one before."""
        system, path = self._files(versions)
        found = sorted(system.listStatus(path), key=lambda f: f.getModificationTime(), reverse=True)
        others = [f.getPath() for f in found if f.getPath().getName() != present.rsplit("/", 1)[1]]
        for old in others[1:]:
            system.delete(old, True)

    def build_marts(self) -> None:
        """Normalised bars and volatility first; the four curves read their tables."""
        bars = normalized_volume(self.table("staging", "stg_intraday_bars"))
        self._save_mart("mart_normalized_volume", bars)
        # From the raw days: the volatility computes its returns in the same blocks.
        self._save_mart("mart_daily_volatility", daily_volatility(self.raw("daily_bars"), precision=self.precision))
        bars = self.table("marts", "mart_normalized_volume")
        days = self.table("marts", "mart_daily_volatility")
        by_hour = self.buckets and measured_bytes(days) > BROADCAST_BYTES
        if by_hour:
            days = self.volatility_by_hour()
        if self.together:
            built = curves.curves_in_one_build(bars, days, shared_buckets=bool(by_hour))
            for mart, curve in zip([m for m in MARTS if m.startswith("mart_volume_curve")], built, strict=True):
                self._save_mart(mart, curve)
            return
        self._save_mart("mart_volume_curve", curves.curve_overall(bars))
        self._save_mart("mart_volume_curve_by_sector", curves.curve_by_sector(bars))
        self._save_mart("mart_volume_curve_by_market_cap", curves.curve_by_cap(bars))
        self._save_mart("mart_volume_curve_by_vol_regime", curves.curve_by_regime(bars, days, shared_buckets=bool(by_hour)))

    def volatility_by_hour(self) -> DataFrame:
        """Stores the volatility mart once for each hour that bars have, in their buckets, and returns that table."""
        found = self.table("marts", "mart_normalized_volume").select("bar_hour").distinct().collect()  # 24 at most
        hours = F.array(*[F.lit(row["bar_hour"]) for row in found]) if found else F.array().cast("array<int>")
        days = self.table("marts", "mart_daily_volatility").withColumn("bar_hour", F.explode(hours))
        days = days.select(*SHARED, "vol_regime", "realized_vol_20d")
        self._save(days, "marts", BY_HOUR, SHARED)
        return self.table("marts", BY_HOUR)

    def _save_mart(self, mart: str, df: DataFrame) -> None:
        self._save(df, "marts", mart, MARTS[mart])

    def build(self, raw: dict[str, DataFrame]) -> DataFrame:
        """All layers from raw frames; returns the rows of ``quality_checks``.

        Violations are counted while the tables are written, without another scan: those of the raw tables and of the volatility in
        their own writes, those of the staged bars in the write of the mart that has a row for each.  Only the staged metadata,
        which no table is made from, are read for their rules, when the result is.
        """
        self._watches.clear()
        self.create_databases()
        for relation, df in raw.items():
            self.load_raw(relation, df)
        self.build_staging()
        self.build_marts()
        return self.checks()

    def checks(self) -> DataFrame:
        """The rows of ``quality_checks`` as the last build has counted them."""
        counts = {relation: watch.get for relation, watch in self._watches.items()}
        metadata = quality_checks({"stg_ticker_metadata": self.table("staging", "stg_ticker_metadata")}, self.session)
        return watched_checks(self.spark, counts, self.session).unionByName(metadata)
