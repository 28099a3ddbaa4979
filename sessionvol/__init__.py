"""Intraday shape of traded volume, on Spark DataFrames."""

from sessionvol.functions.clock import NEW_YORK_SESSION, UTC_SESSION, TradingSession
from sessionvol.functions.values import cap_band
from sessionvol.operators.curves import (
    bars_with_regime,
    curve_by_cap,
    curve_by_regime,
    curve_by_sector,
    curve_from_cells,
    curve_overall,
    curves_sketched,
    curves_together,
    sketched_cells,
    volume_curve,
)
from sessionvol.operators.metadata import (
    feed_counts,
    foreign_tickers,
    latest_metadata,
    missing_feeds,
    universe_join,
    with_cap_band,
    with_metadata_defaults,
)
from sessionvol.operators.normalize import avg_daily_volume, daily_total_volume, normalized_volume
from sessionvol.operators.quality import quality_checks
from sessionvol.operators.staging import stg_daily_bars, stg_intraday_bars, stg_ticker_metadata
from sessionvol.operators.summary import curve_cap_pivot, kpi_cards, regime_close_gap, sector_spikes
from sessionvol.operators.volatility import daily_volatility, realized_volatility, vol_threshold
from sessionvol.plans.layers import Layers, database_name
from sessionvol.session import spark_session

__all__ = [
    "Layers", "NEW_YORK_SESSION", "TradingSession", "UTC_SESSION", "avg_daily_volume", "bars_with_regime",
    "cap_band", "curve_by_cap", "curve_by_regime", "curve_by_sector", "curve_cap_pivot", "curve_from_cells", "curve_overall", "curves_sketched", "curves_together",
    "daily_total_volume", "daily_volatility", "database_name", "feed_counts", "foreign_tickers", "kpi_cards",
    "latest_metadata", "missing_feeds", "normalized_volume", "quality_checks", "realized_volatility",
    "regime_close_gap", "sector_spikes", "sketched_cells", "spark_session", "stg_daily_bars", "stg_intraday_bars",
    "stg_ticker_metadata", "universe_join", "vol_threshold", "volume_curve", "with_cap_band",
    "with_metadata_defaults",
]
