"""Counts of rows that break a stated rule: one aggregate pass per relation, or taken while its rows are written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sessionvol.functions.clock import UTC_SESSION, TradingSession
from sessionvol.functions.values import CAP_BANDS, REGIMES

INTERVAL = "5m"  # fixed value: the only bar length in use


def _in(column: str, values) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


def rules(session: TradingSession = UTC_SESSION) -> dict[str, dict[str, str]]:
    """Relation -> rule -> condition that every row should meet."""
    first, last = session.slot_range
    return {
        "raw_intraday_bars": {
            "interval_is_5m": f"`interval` = '{INTERVAL}'",
            "known_cap_band": _in("market_cap_band", CAP_BANDS),
            "volume_not_negative": "volume >= 0",
            "volume_positive": "volume > 0",
        },
        "stg_intraday_bars": {
            "day_of_week_1_to_7": "day_of_week between 1 and 7",
            "volume_positive": "volume > 0",
            "slot_in_session": f"minutes_since_open between {first} and {last}",
        },
        "raw_daily_bars": {
            "volume_not_negative": "volume >= 0",
            "close_positive": "close > 0",
        },
        "stg_ticker_metadata": {
            "named_ticker": "ticker != ''",
            "known_cap_band": _in("market_cap_band", CAP_BANDS),
        },
        "mart_daily_volatility": {
            "regime_high_or_low": _in("vol_regime", REGIMES),
            "volatility_is_a_number": "not isnan(realized_vol_20d)",
        },
    }


COUNTED = "array<struct<relation: string, rule: string, checked: bigint, violations: bigint>>"


def _measures(conditions: dict[str, str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(~F.coalesce(F.expr(text), F.lit(False))).alias(rule) for rule, text in conditions.items()],
    ]


def watched(df: DataFrame, relation: str, session: TradingSession = UTC_SESSION) -> tuple[DataFrame, Observation | None]:
    """The frame, and a watch that counts the relation's violations among its rows when they are written.

    Give what is written, behind the last shuffle: every row is then counted once, also where tasks are run again.
    """
    conditions = rules(session).get(relation)
    if not conditions:
        return df, None
    watch = Observation()
    return df.observe(watch, *_measures(conditions)), watch


def watched_checks(spark: SparkSession, counts: dict[str, dict[str, int]], session: TradingSession = UTC_SESSION) -> DataFrame:
    """The rows of ``quality_checks`` from what watches have counted, by relation."""
    rows = [
        (relation, rule, counts[relation].get("checked") or 0, counts[relation].get(rule) or 0)
        for relation, conditions in rules(session).items() if relation in counts for rule in conditions
    ]
    values = F.array(*[F.struct(*map(F.lit, row)) for row in rows]).cast(COUNTED)
    return spark.range(1).select(F.inline(values))


def quality_checks(relations: dict[str, DataFrame], session: TradingSession = UTC_SESSION) -> DataFrame:
    """relation, rule, checked, violations for every relation given.  NULL breaks a rule."""
    reports = []
    for relation, conditions in rules(session).items():
        if relation not in relations:
            continue
        counted = relations[relation].agg(*_measures(conditions))
        pairs = ", ".join(f"'{rule}', `{rule}`" for rule in conditions)
        reports.append(
            counted.selectExpr(
                f"'{relation}' as relation", "checked",
                f"stack({len(conditions)}, {pairs}) as (rule, violations)",
            ).select("relation", "rule", "checked", "violations")
        )
    return reduce(DataFrame.unionByName, reports)
