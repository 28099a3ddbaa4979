"""Summary figures on finished curves.  A curve has at most a few rows per minute of the
session and group, so these work on small frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionvol.functions.values import CAP_BANDS, REGIMES, safe_ratio
from sessionvol.operators.curves import SLOT

OPEN_SLOT = 0
CLOSE_SLOT = 385
MIDDAY = (120, 240)  # first and last minute of the midday window

_VALUE = "avg_normalized_volume"


def _at(minute: int) -> Column:
    return F.max(F.when(F.col("minutes_since_open") == minute, F.col(_VALUE)))


def kpi_cards(curve: DataFrame, by_sector: DataFrame, midday: tuple[int, int] = MIDDAY) -> DataFrame:
    """One row: peak, midday trough, open-to-midday ratio, number of sectors.

    ``curve`` and ``by_sector`` need no median.  ``by_sector`` is only asked for its sectors: any frame with that column will do.
    """
    in_midday = F.when(F.col("minutes_since_open").between(*midday), F.col(_VALUE))
    shape = curve.agg(
        F.max(_VALUE).alias("peak_normalized_volume"),
        F.min(in_midday).alias("midday_trough"),
        safe_ratio(_at(OPEN_SLOT), F.avg(in_midday)).alias("open_to_midday_ratio"),
    )
    sectors = by_sector.select("sector").distinct().agg(F.count("sector").alias("sector_count"))
    both = shape.unionByName(sectors, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def curve_cap_pivot(curve: DataFrame, bands: Sequence[str] = CAP_BANDS) -> DataFrame:
    """Cap bands side by side, one row per slot.

    The bands given are the output's columns; the default holds every band that ``cap_band`` gives.  Slots of other bands alone stay, with NULLs.
    """
    return curve.groupBy(*SLOT).pivot("market_cap_band", list(bands)).agg(F.max(_VALUE))


def regime_close_gap(curve: DataFrame) -> DataFrame:
    """High against low regime in the last slot that occurs."""
    sides = curve.groupBy("minutes_since_open").pivot("vol_regime", list(REGIMES)).agg(F.max(_VALUE))
    last = sides.agg(F.max(F.struct("minutes_since_open", *REGIMES)).alias("last")).select("last.*")
    return last.select(
        F.col("minutes_since_open").alias("close_minute"),
        F.col("high").alias("high_close"),
        F.col("low").alias("low_close"),
        (F.col("high") - F.col("low")).alias("close_gap"),
        safe_ratio(F.col("high"), F.col("low")).alias("close_ratio"),
    )


def sector_spikes(curve: DataFrame) -> DataFrame:
    """Open and close of each sector's curve against the mean of that curve."""
    sides = curve.groupBy("sector").agg(
        _at(OPEN_SLOT).alias("opening"), _at(CLOSE_SLOT).alias("closing"), F.avg(_VALUE).alias("mean")
    )
    return sides.select(
        "sector",
        safe_ratio(F.col("opening"), F.col("mean")).alias("open_spike"),
        safe_ratio(F.col("closing"), F.col("mean")).alias("close_spike"),
    )
