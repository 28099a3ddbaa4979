"""The registered queries as SQL on the test tables."""

from __future__ import annotations

BAND = """CASE WHEN market_cap IS NULL OR isnan(market_cap) THEN 'unknown'
  WHEN market_cap >= 10000000000 THEN 'large' WHEN market_cap >= 2000000000 THEN 'mid' ELSE 'small' END"""

UNITS = "CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE round(value * 100) END) AS BIGINT)"
PRICES = """arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, row(ts, event_id)) AS close"""




# Relation -> (relations it reads, SQL).
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_metadata": ((), f"""
        SELECT 'T' || CAST(c_custkey // 12 AS VARCHAR) AS ticker, c_name AS company_name,
          'S' || CAST((c_custkey // 12) % 5 AS VARCHAR) AS sector, c_mktsegment AS industry,
          market_cap, {BAND} AS market_cap_band,
          'NATION_' || CAST(c_nationkey AS VARCHAR) AS country, 'USD' AS currency,
          TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS fetched_at
        FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_acctbal * 2e6 END AS market_cap FROM customer)"""),
    "latest_metadata": (("raw_metadata",), """
        SELECT * FROM raw_metadata
        QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY fetched_at DESC) = 1"""),
    "universe": ((), """
        SELECT DISTINCT 'T' || CAST(c_custkey // 9 AS VARCHAR) AS ticker,
          'S' || CAST((c_custkey // 9) % 5 AS VARCHAR) AS sector FROM customer"""),
    "universe_metadata": (("universe", "latest_metadata"), """
        SELECT u.ticker, m.company_name, u.sector, m.industry, m.market_cap,
          coalesce(m.market_cap_band, 'unknown') AS market_cap_band, m.country, m.currency, m.fetched_at
        FROM universe u LEFT JOIN latest_metadata m USING (ticker)"""),
    "raw_intraday": (("latest_metadata",), f"""
        SELECT b.ticker, b.sector, coalesce(m.market_cap_band, 'unknown') AS market_cap_band, b.bar_time,
          b.open, b.high, b.low, b.close, b.volume, '5m' AS "interval",
          TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
        FROM (SELECT 'T' || CAST(user_id AS VARCHAR) AS ticker, 'S' || CAST(user_id % 5 AS VARCHAR) AS sector,
                time_bucket(INTERVAL 5 MINUTE, ts) AS bar_time, {PRICES}, {UNITS} AS volume
              FROM events GROUP BY ALL) b
        LEFT JOIN latest_metadata m USING (ticker)"""),
    "raw_daily": ((), f"""
        SELECT 'T' || CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trade_date, {PRICES},
          {UNITS} AS volume, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
        FROM events GROUP BY user_id, CAST(ts AS DATE)"""),
    "raw_daily_long": ((), """
        SELECT 'T' || CAST(o_custkey // 100 AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS trade_date,
          arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume
        FROM orders GROUP BY o_custkey // 100, CAST(o_orderdate AS DATE)"""),
    "stg_intraday": (("raw_intraday",), """
        SELECT ticker, sector, market_cap_band, bar_time, CAST(bar_time AS DATE) AS trade_date,
          CAST(hour(bar_time) AS INTEGER) AS bar_hour, CAST(minute(bar_time) AS INTEGER) AS bar_minute,
          date_diff('minute', CAST(bar_time AS DATE) + INTERVAL '14 hours 30 minutes', bar_time)
            AS minutes_since_open,
          CAST(isodow(bar_time) AS INTEGER) AS day_of_week, open, high, low, close, volume, "interval",
          ingested_at
        FROM raw_intraday
        WHERE hour(bar_time) >= 14 AND bar_time < CAST(bar_time AS DATE) + INTERVAL 21 HOUR
          AND volume > 0 AND close > 0"""),
    "stg_daily": (("raw_daily",), """
        SELECT ticker, trade_date, open, high, low, close, volume,
          close / lag(close) OVER (PARTITION BY ticker ORDER BY trade_date) - 1 AS daily_return, ingested_at
        FROM raw_daily WHERE volume > 0 AND close > 0"""),
    "stg_daily_long": (("raw_daily_long",), """
        SELECT ticker, trade_date,
          close / lag(close) OVER (PARTITION BY ticker ORDER BY trade_date) - 1 AS daily_return
        FROM raw_daily_long WHERE volume > 0 AND close > 0"""),
    "totals": (("stg_intraday",), """
        SELECT ticker, trade_date, CAST(sum(volume) AS BIGINT) AS daily_total_volume
        FROM stg_intraday GROUP BY ticker, trade_date"""),
    "averages": (("totals",), """
        SELECT ticker, avg(daily_total_volume) AS avg_daily_volume FROM totals GROUP BY ticker"""),
    "normalized": (("stg_intraday", "averages"), """
        SELECT b.* EXCLUDE ("interval", ingested_at), a.avg_daily_volume,
          b.volume / nullif(a.avg_daily_volume, 0) AS normalized_volume
        FROM stg_intraday b LEFT JOIN averages a USING (ticker)"""),
}


def _volatility(name: str, staged: str, min_periods: int = 1) -> None:
    RELATIONS[f"rated{name}"] = ((staged,), f"""
        SELECT * FROM (
          SELECT ticker, trade_date, daily_return,
            CASE WHEN count(daily_return) OVER w >= {min_periods}
              THEN round(stddev_pop(daily_return) OVER w * sqrt(252), 7) END AS realized_vol_20d
          FROM {staged}
          WINDOW w AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
        WHERE realized_vol_20d IS NOT NULL""")
    RELATIONS[f"threshold{name}"] = ((f"rated{name}",), f"""
        SELECT ticker, percentile_disc(0.5) WITHIN GROUP (ORDER BY realized_vol_20d DESC) AS vol_threshold
        FROM rated{name} GROUP BY ticker""")
    RELATIONS[f"volatility{name}"] = ((f"rated{name}", f"threshold{name}"), f"""
        SELECT ticker, trade_date, daily_return, realized_vol_20d,
          CASE WHEN realized_vol_20d > vol_threshold THEN 'high' ELSE 'low' END AS vol_regime
        FROM rated{name} JOIN threshold{name} USING (ticker)""")


_volatility("", "stg_daily")
_volatility("_long", "stg_daily_long")
_volatility("_full", "stg_daily_long", 20)

RELATIONS["regime_bars"] = (("normalized", "volatility"), """
    SELECT n.*, v.vol_regime, v.realized_vol_20d
    FROM normalized n LEFT JOIN volatility v ON n.ticker = v.ticker AND n.trade_date = v.trade_date
    WHERE v.vol_regime IS NOT NULL""")


def _curve(name: str, source: str, by: str = "", more: str = "") -> None:
    keys = f"{by}minutes_since_open, bar_hour, bar_minute"
    RELATIONS[name] = ((source,), f"""
        SELECT {keys}, count(*) AS sample_size, avg(normalized_volume) AS avg_normalized_volume,
          median(normalized_volume) AS median_normalized_volume,
          stddev_pop(normalized_volume) AS stddev_normalized_volume{more}
        FROM {source} GROUP BY {keys}""")


_curve("overall", "normalized", more=""",
          avg(normalized_volume) + stddev_pop(normalized_volume) AS upper_band,
          avg(normalized_volume) - stddev_pop(normalized_volume) AS lower_band""")
_curve("by_sector", "normalized", "sector, ")
_curve("by_cap", "normalized", "market_cap_band, ")
_curve("by_regime", "regime_bars", "vol_regime, ", ", avg(realized_vol_20d) AS avg_realized_vol")

_FED = """
    SELECT f.ticker, u.sector, coalesce(u.market_cap_band, 'unknown') AS market_cap_band, f.bar_time,
      f.open, f.high, f.low, f.close, f.volume, '5m' AS "interval",
      TIMESTAMP '2024-02-02 03:04:05' AS ingested_at
    FROM raw_intraday f LEFT JOIN universe_metadata u USING (ticker)"""
RELATIONS["fed"] = (("raw_intraday", "universe_metadata"), _FED)
RELATIONS["failed"] = (("raw_intraday",), """
    SELECT 'ticker=' || ticker AS file, ticker,
      CASE WHEN any_value(n) % 7 = 3 THEN 'no column close' ELSE 'malformed rows' END AS reason,
      CASE WHEN any_value(n) % 7 = 3 THEN 0 ELSE count(*) FILTER (WHERE minute(bar_time) = 30) END AS n_rows
    FROM (SELECT *, CAST(substr(ticker, 2) AS BIGINT) AS n FROM raw_intraday)
    GROUP BY ticker HAVING any_value(n) % 7 = 3 OR (any_value(n) % 5 = 2 AND count(*) FILTER (WHERE minute(bar_time) = 30) > 0)""")
RELATIONS["metadata_feed"] = ((), """
    SELECT 'T' || CAST(c_custkey AS VARCHAR) AS ticker,
      CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS company_name,
      CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS industry,
      CASE WHEN c_acctbal >= 0 THEN c_acctbal * 2e6 END AS market_cap,
      CASE WHEN c_custkey % 3 <> 0 THEN 'NATION_' || CAST(c_nationkey AS VARCHAR) END AS country,
      CASE WHEN c_custkey % 2 <> 0 THEN 'EUR' END AS currency
    FROM customer""")
RELATIONS["gap_sides"] = (("by_regime",), """
    SELECT minutes_since_open, max(avg_normalized_volume) FILTER (WHERE vol_regime = 'high') AS high,
      max(avg_normalized_volume) FILTER (WHERE vol_regime = 'low') AS low
    FROM by_regime GROUP BY minutes_since_open""")

_CURVE = "round(avg_normalized_volume, 10) AS avg_normalized_volume, " \
    "round(median_normalized_volume, 10) AS median_normalized_volume, " \
    "round(stddev_normalized_volume, 10) AS stddev_normalized_volume"
_SLOT = "minutes_since_open, bar_hour, bar_minute, sample_size"
_DAY_FEED = """SELECT ticker, trade_date, open, high, low, close, volume,
    TIMESTAMP '2024-02-02 03:04:05' AS ingested_at FROM raw_daily"""
_VOL = "SELECT * FROM "
_DEFAULTS = """coalesce(company_name, '') AS company_name, coalesce(industry, '') AS industry,
    market_cap, coalesce(country, '') AS country, coalesce(currency, 'USD') AS currency"""


def _rules() -> str:
    bands = "('large', 'mid', 'small', 'unknown')"
    listed = [
        ("raw_intraday_bars", "raw_intraday", "interval_is_5m", "\"interval\" = '5m'"),
        ("raw_intraday_bars", "raw_intraday", "known_cap_band", f"market_cap_band IN {bands}"),
        ("raw_intraday_bars", "raw_intraday", "volume_not_negative", "volume >= 0"),
        ("raw_intraday_bars", "raw_intraday", "volume_positive", "volume > 0"),
        ("stg_intraday_bars", "stg_intraday", "day_of_week_1_to_7", "day_of_week BETWEEN 1 AND 7"),
        ("stg_intraday_bars", "stg_intraday", "volume_positive", "volume > 0"),
        ("stg_intraday_bars", "stg_intraday", "slot_in_session", "minutes_since_open BETWEEN -30 AND 389"),
        ("raw_daily_bars", "raw_daily", "volume_not_negative", "volume >= 0"),
        ("raw_daily_bars", "raw_daily", "close_positive", "close > 0"),
        ("stg_ticker_metadata", "latest_metadata", "named_ticker", "ticker <> ''"),
        ("stg_ticker_metadata", "latest_metadata", "known_cap_band", f"market_cap_band IN {bands}"),
        ("mart_daily_volatility", "volatility", "regime_high_or_low", "vol_regime IN ('high', 'low')"),
        ("mart_daily_volatility", "volatility", "volatility_is_a_number", "NOT isnan(realized_vol_20d)"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{relation}' AS relation, '{rule}' AS rule, count(*) AS checked, "
        f"count(*) FILTER (WHERE NOT coalesce({text}, false)) AS violations FROM {source}"
        for relation, source, rule, text in listed
    )


def _layers() -> str:
    listed = [
        ("raw", "intraday_bars", "raw_intraday", "volume"),
        ("raw", "ticker_metadata", "raw_metadata", "length(company_name)"),
        ("raw", "daily_bars", "raw_daily", "volume"),
        ("staging", "stg_intraday_bars", "stg_intraday", "minutes_since_open"),
        ("staging", "stg_daily_bars", "stg_daily", "daily_return"),
        ("staging", "stg_ticker_metadata", "latest_metadata", "length(company_name)"),
        ("marts", "mart_normalized_volume", "normalized", "normalized_volume"),
        ("marts", "mart_daily_volatility", "volatility", "realized_vol_20d"),
        ("marts", "mart_volume_curve", "overall", "median_normalized_volume"),
        ("marts", "mart_volume_curve_by_sector", "by_sector", "median_normalized_volume"),
        ("marts", "mart_volume_curve_by_market_cap", "by_cap", "stddev_normalized_volume"),
        ("marts", "mart_volume_curve_by_vol_regime", "by_regime", "avg_realized_vol"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{relation}' AS relation, count(*) AS n_rows, "
        f"round(sum(CAST({number} AS DOUBLE)), 4) AS checksum FROM {source}"
        for layer, relation, source, number in listed
    )


# New York is four hours behind UTC from the second Sunday of March, 7:00 UTC, to the first of November, 6:00 UTC, else five.
# All test bars lie in 2024.
_BEHIND = """CASE WHEN bar_time >= TIMESTAMP '2024-03-10 07:00:00' AND bar_time < TIMESTAMP '2024-11-03 06:00:00'
  THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END"""


def _new_york(hours: int) -> str:
    return f"""
        SELECT ticker, sector, market_cap_band, bar_time, CAST(local AS DATE) AS trade_date,
          CAST(hour(local) AS INTEGER) AS bar_hour, CAST(minute(local) AS INTEGER) AS bar_minute,
          date_diff('minute', CAST(local AS DATE) + INTERVAL '9 hours 30 minutes', local)
            AS minutes_since_open,
          CAST(isodow(local) AS INTEGER) AS day_of_week, open, high, low, close, volume, "interval",
          ingested_at
        FROM (SELECT *, bar_time - {_BEHIND} AS local
              FROM (SELECT * REPLACE (bar_time + INTERVAL {hours} HOUR AS bar_time) FROM raw_intraday))
        WHERE hour(local) >= 9 AND hour(local) < 16 AND volume > 0 AND close > 0"""


# Query -> (relations it reads, SQL).
FINAL: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_intraday": (("raw_intraday",), "SELECT * FROM raw_intraday"),
    "raw_daily": (("raw_daily",), "SELECT * FROM raw_daily"),
    "raw_metadata": (("raw_metadata",), "SELECT * FROM raw_metadata"),
    "stg_intraday": (("stg_intraday",), "SELECT * FROM stg_intraday"),
    "stg_intraday_strict": (("stg_intraday",), "SELECT * FROM stg_intraday WHERE minutes_since_open >= 0"),
    "stg_intraday_new_york": (("raw_intraday",), _new_york(0)),
    "stg_intraday_summer": (("raw_intraday",), _new_york(4_000)),
    "stg_intraday_change_days": (("raw_intraday",), _new_york(1_600)),
    "stg_daily": (("stg_daily",), "SELECT * FROM stg_daily"),
    "stg_metadata": (("latest_metadata",), "SELECT * FROM latest_metadata WHERE ticker <> ''"),
    "daily_total_volume": (("totals",), "SELECT * FROM totals"),
    "avg_daily_volume": (("averages",), "SELECT * FROM averages"),
    "normalized_volume": (("normalized",), "SELECT * FROM normalized"),
    "curve_overall": (("overall",), f"""
        SELECT {_SLOT}, {_CURVE}, round(upper_band, 10) AS upper_band, round(lower_band, 10) AS lower_band
        FROM overall"""),
    "curve_by_sector": (("by_sector",), f"SELECT sector, {_SLOT}, {_CURVE} FROM by_sector"),
    "curve_by_cap": (("by_cap",), f"SELECT market_cap_band, {_SLOT}, {_CURVE} FROM by_cap"),
    "curve_by_regime": (("by_regime",), f"""
        SELECT vol_regime, {_SLOT}, {_CURVE}, round(avg_realized_vol + 1e-11, 9) AS avg_realized_vol
        FROM by_regime"""),
    "curves_together": (("overall", "by_sector", "by_cap"), " UNION ALL ".join(
        f"SELECT {name} AS \"grouping\", {_SLOT}, {_CURVE} FROM {source}" for name, source in (
            ("'all'", "overall"), ("sector", "by_sector"), ("market_cap_band", "by_cap")))),
    "curves_in_one_build": (("overall", "by_sector", "by_cap", "by_regime"), " UNION ALL ".join(
        f"SELECT {name} AS \"grouping\", {_SLOT}, {_CURVE}, {realized} AS avg_realized_vol FROM {source}" for name, source, realized in (
            ("vol_regime", "by_regime", "round(avg_realized_vol + 1e-11, 9)"), ("'all'", "overall", "CAST(NULL AS DOUBLE)"),
            ("sector", "by_sector", "CAST(NULL AS DOUBLE)"), ("market_cap_band", "by_cap", "CAST(NULL AS DOUBLE)")))),
    "curves_sketched": (("overall", "by_sector", "by_cap"), " UNION ALL ".join(
        f"SELECT {name} AS \"grouping\", {_SLOT}, round(avg_normalized_volume, 10) AS avg_normalized_volume, "
        f"round(stddev_normalized_volume, 10) AS stddev_normalized_volume, CAST(1 AS INTEGER) AS near_middle FROM {source}" for name, source in (
            ("'all'", "overall"), ("sector", "by_sector"), ("market_cap_band", "by_cap")))),
    "merged_loads": (("raw_daily",), "SELECT * FROM raw_daily"),
    "vol_threshold": (("threshold",), "SELECT * FROM threshold"),
    "daily_volatility": (("volatility",), _VOL + "volatility"),
    "daily_volatility_long": (("volatility_long",), _VOL + "volatility_long"),
    "daily_volatility_full_frames": (("volatility_full",), _VOL + "volatility_full"),
    "cap_band": (("metadata_feed",),
        f"SELECT ticker, market_cap, {BAND} AS market_cap_band FROM metadata_feed"),
    "metadata_defaults": (("metadata_feed",), f"SELECT ticker, {_DEFAULTS} FROM metadata_feed"),
    "latest_metadata": (("latest_metadata",), "SELECT * FROM latest_metadata"),
    "universe_join": (("universe_metadata",), "SELECT * FROM universe_metadata"),
    "missing_feeds": (("universe", "raw_intraday"), """
        SELECT ticker, sector FROM universe
        WHERE ticker NOT IN (SELECT ticker FROM raw_intraday)"""),
    "feed_counts": (("raw_intraday",), "SELECT ticker, count(*) AS n_rows FROM raw_intraday GROUP BY ticker"),
    "union_feeds": (("fed",), "SELECT * FROM fed"),
    "ingest_intraday": (("fed",), "SELECT * FROM fed"),
    "ingest_csv": (("fed",), "SELECT * FROM fed"),
    "ingest_beside_failed": (("fed", "failed"), "SELECT * FROM fed WHERE ticker NOT IN (SELECT ticker FROM failed)"),
    "failed_feeds": (("failed",), "SELECT * FROM failed"),
    "foreign_tickers": (("metadata_feed", "raw_daily", "universe"), """
        SELECT feed, ticker, count(*) AS n_rows
        FROM (SELECT 'metadata' AS feed, ticker FROM metadata_feed UNION ALL SELECT 'daily', ticker FROM raw_daily)
        WHERE ticker NOT IN (SELECT ticker FROM universe) GROUP BY feed, ticker"""),
    "ingest_daily": (("raw_daily",), _DAY_FEED),
    "ingest_metadata": (("metadata_feed", "universe"), f"""
        SELECT ticker, sector, {_DEFAULTS}, {BAND} AS market_cap_band,
          TIMESTAMP '2024-02-02 03:04:05' AS fetched_at
        FROM metadata_feed JOIN universe USING (ticker)"""),
    "sink_roundtrip": (("raw_intraday",), """
        SELECT *, CAST(year(bar_time) * 100 + month(bar_time) AS INTEGER) AS bar_month FROM raw_intraday"""),
    "sink_csv": (("raw_daily",), "SELECT * FROM raw_daily"),
    "sink_csv_bars": (("raw_intraday",), "SELECT * REPLACE (bar_time + INTERVAL 250001 MICROSECONDS AS bar_time) FROM raw_intraday"),
    "sink_csv_metadata": (("raw_metadata",),
        "SELECT * REPLACE (fetched_at + INTERVAL 250001 MICROSECONDS AS fetched_at) FROM raw_metadata"),
    "bounded_scan": (("raw_intraday",), """
        SELECT * FROM raw_intraday
        WHERE bar_time >= TIMESTAMP '2024-01-10 00:00:00' AND bar_time < TIMESTAMP '2024-01-20 12:00:00'"""),
    "layers": (("raw_intraday", "raw_metadata", "raw_daily", "stg_intraday", "stg_daily", "latest_metadata",
                "normalized", "volatility", "overall", "by_sector", "by_cap", "by_regime"), _layers()),
    "mart_normalized_volume": (("normalized",), "SELECT * FROM normalized"),
    "mart_daily_volatility": (("volatility",), _VOL + "volatility"),
    "mart_volume_curve": (("overall",), f"""
        SELECT {_SLOT}, {_CURVE}, round(upper_band, 10) AS upper_band, round(lower_band, 10) AS lower_band
        FROM overall"""),
    "mart_volume_curve_by_sector": (("by_sector",), f"SELECT sector, {_SLOT}, {_CURVE} FROM by_sector"),
    "mart_volume_curve_by_market_cap": (("by_cap",), f"SELECT market_cap_band, {_SLOT}, {_CURVE} FROM by_cap"),
    "mart_volume_curve_by_vol_regime": (("by_regime",), f"""
        SELECT vol_regime, {_SLOT}, {_CURVE}, round(avg_realized_vol + 1e-11, 9) AS avg_realized_vol
        FROM by_regime"""),
    # Groups of fewer rows than the sketch's accuracy have their lower middle value as sketched median.
    "curve_overall_approx": (("normalized",), """
        SELECT minutes_since_open, bar_hour, bar_minute, count(*) AS sample_size,
          round(avg(normalized_volume), 10) AS avg_normalized_volume,
          round(quantile_disc(normalized_volume, 0.5), 10) AS median_normalized_volume,
          round(stddev_pop(normalized_volume), 10) AS stddev_normalized_volume,
          round(avg(normalized_volume) + stddev_pop(normalized_volume), 10) AS upper_band,
          round(avg(normalized_volume) - stddev_pop(normalized_volume), 10) AS lower_band
        FROM normalized GROUP BY ALL"""),
    "kpi_cards": (("overall", "normalized"), """
        SELECT round(max(avg_normalized_volume), 8) AS peak_normalized_volume,
          round(min(avg_normalized_volume) FILTER (WHERE minutes_since_open BETWEEN 120 AND 240), 8)
            AS midday_trough,
          round(max(avg_normalized_volume) FILTER (WHERE minutes_since_open = 0)
            / avg(avg_normalized_volume) FILTER (WHERE minutes_since_open BETWEEN 120 AND 240), 6)
            AS open_to_midday_ratio,
          (SELECT count(DISTINCT sector) FROM normalized) AS sector_count
        FROM overall"""),
    "curve_sector_subset": (("by_sector",),
        f"SELECT sector, {_SLOT}, {_CURVE} FROM by_sector WHERE sector IN ('S1', 'S3')"),
    "curve_cap_pivot": (("by_cap",), "SELECT minutes_since_open, bar_hour, bar_minute, " + ", ".join(
        f"round(max(avg_normalized_volume) FILTER (WHERE market_cap_band = '{band}'), 8) AS \"{band}\""
        for band in ("large", "mid", "small", "unknown")
    ) + " FROM by_cap GROUP BY minutes_since_open, bar_hour, bar_minute"),
    "regime_close_gap": (("gap_sides",), """
        SELECT minutes_since_open AS close_minute, round(high, 8) AS high_close, round(low, 8) AS low_close,
          round(high - low, 8) AS close_gap, round(high / low, 6) AS close_ratio
        FROM gap_sides ORDER BY minutes_since_open DESC LIMIT 1"""),
    "sector_spikes": (("by_sector",), """
        SELECT sector,
          round(max(avg_normalized_volume) FILTER (WHERE minutes_since_open = 0)
            / avg(avg_normalized_volume), 6) AS open_spike,
          round(max(avg_normalized_volume) FILTER (WHERE minutes_since_open = 385)
            / avg(avg_normalized_volume), 6) AS close_spike
        FROM by_sector GROUP BY sector"""),
    "quality_checks": (("raw_intraday", "stg_intraday", "raw_daily", "latest_metadata", "volatility"),
                       _rules()),
    "build_checks": (("raw_intraday", "stg_intraday", "raw_daily", "latest_metadata", "volatility"), _rules()),
}


def _needed(names: tuple[str, ...], found: list[str]) -> list[str]:
    for name in names:
        if name not in found:
            _needed(RELATIONS[name][0], found)
            found.append(name)
    return found


def sql(query: str) -> str:
    names, final = FINAL[query]
    steps = ", ".join(f"{name} AS ({RELATIONS[name][1]})" for name in _needed(names, []))
    return f"WITH {steps} {final}"


def registered() -> dict[str, str]:
    return {query: sql(query) for query in FINAL}
