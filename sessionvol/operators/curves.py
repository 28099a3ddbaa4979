"""Time-of-day volume curves: overall, by sector, by cap band, by volatility regime."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionvol.functions.values import REGIMES
from sessionvol.plans.joins import lookup_join, measured_bytes
from sessionvol.plans.middle import SORT_ROWS, group_summaries, group_summary, number
from sessionvol.session import settle

SKETCH_K = 1_000  # of KLL sketches: a rank error of about 0.3 hundredths
APPROX_ACCURACY = 10_000  # the sketch's rank error is at most 1 / this

SLOT = ("minutes_since_open", "bar_hour", "bar_minute")


def volume_curve(
    normalized: DataFrame,
    by: Sequence[str] = (),
    bands: bool = False,
    averages: Sequence[str] = (),
    approx: bool = False,
    median: bool = True,
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """Count, mean, median and population deviation of normalized_volume per slot.

    ``by`` adds group columns, ``bands`` the mean plus and minus one deviation,
    ``averages`` the means of further columns (name -> avg_name).  The median is exact
    and interpolates; ``approx`` takes Spark's percentile sketch and one pass instead,
    ``median=False`` leaves the median out, which takes one hash aggregation.
    ``candidates`` is passed on to ``group_summary``.  Rows come in no order.
    """
    keys = [*by, *SLOT]
    if approx or not median:
        value = number("normalized_volume")
        sketch = [F.percentile_approx(value, 0.5, APPROX_ACCURACY).alias("lower")] if median else []
        summary = normalized.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(value).alias("mean"),
            F.stddev_pop(value).alias("deviation"),
            *sketch,
            *[F.avg(c).alias(c) for c in averages],
        )
        if median:
            summary = summary.withColumn("upper", F.col("lower"))
    else:
        summary = group_summary(
            normalized, keys, "normalized_volume", averages, candidates, sort_rows
        )
    return _curve(summary, keys, bands, averages)


def _curve(summary: DataFrame, keys: Sequence[str], bands: bool = False, averages: Sequence[str] = ()) -> DataFrame:
    edges = [
        (F.col("mean") + F.col("deviation")).alias("upper_band"),
        (F.col("mean") - F.col("deviation")).alias("lower_band"),
    ]
    return summary.select(
        *keys,
        F.col("rows").alias("sample_size"),
        F.col("mean").alias("avg_normalized_volume"),
        *([((F.col("lower") + F.col("upper")) / 2).alias("median_normalized_volume")] if "lower" in summary.columns else []),
        F.col("deviation").alias("stddev_normalized_volume"),
        *(edges if bands else []),
        *[F.col(c).alias(f"avg_{c}") for c in averages],
    )


def curves_together(normalized: DataFrame, sort_rows: int = SORT_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Overall, sector and cap curve, from two passes over the bars instead of six."""
    key_sets = [list(SLOT), ["sector", *SLOT], ["market_cap_band", *SLOT]]
    found = group_summaries(normalized, key_sets, "normalized_volume", sort_rows=sort_rows)
    overall, by_sector, by_cap = zip(found, key_sets, strict=True)
    return _curve(*overall, bands=True), _curve(*by_sector), _curve(*by_cap)


def curves_in_one_build(
    normalized: DataFrame, volatility: DataFrame, shared_buckets: bool = False, sort_rows: int = SORT_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Overall, sector, cap and regime curve, from two passes over the bars instead of eight.

    Bars get their day's regime, or none; the cells of (sector, band, regime, slot) are stored once and merged for each curve.
    ``volatility`` and ``shared_buckets`` are those of ``curve_by_regime``.
    """
    size = measured_bytes(volatility)
    bars = bars_with_regime(normalized, volatility, size, salts=0 if shared_buckets else None, rated_only=False)
    key_sets = [list(SLOT), ["sector", *SLOT], ["market_cap_band", *SLOT], ["vol_regime", *SLOT]]
    overall, by_sector, by_cap, by_regime = group_summaries(bars, key_sets, "normalized_volume", ["realized_vol"], sort_rows)
    rated = by_regime.where(F.col("vol_regime").isNotNull())
    return (
        _curve(overall, key_sets[0], bands=True), _curve(by_sector, key_sets[1]), _curve(by_cap, key_sets[2]),
        _curve(rated, key_sets[3], averages=["realized_vol"]),
    )


def sketched_cells(normalized: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per sector, cap band and slot: count, mean, variance and a KLL sketch of the shares, from one pass.

    A sketch holds about 3 * ``k`` numbers however many rows it stands for, and is exact below ``k`` rows. Kept as a table,
    cells of several days or loads can be merged, too.
    """
    value = number("normalized_volume")
    return normalized.groupBy("sector", "market_cap_band", *SLOT).agg(
        F.count(F.lit(1)).alias("rows"), F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("variance"),
        F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch"),
    )


def curve_from_cells(cells: DataFrame, by: Sequence[str] = (), bands: bool = False) -> DataFrame:
    """A curve from ``sketched_cells``: its median is a sketched one, the rest is exact."""
    keys = [*by, *SLOT]
    group = Window.partitionBy(*keys)
    whole = F.sum(F.col("n") * F.col("mean")).over(group) / F.nullif(F.sum("n").over(group), F.lit(0))
    apart = F.col("mean") - F.col("_whole")
    merged = cells.withColumn("_whole", whole).groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.max("_whole").alias("mean"),
        F.sqrt(F.sum(F.col("n") * (F.col("variance") + apart * apart)) / F.nullif(F.sum("n"), F.lit(0))).alias("deviation"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    middle = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))
    return _curve(merged.withColumn("lower", middle).withColumn("upper", F.col("lower")), keys, bands)


def curves_sketched(normalized: DataFrame, k: int = SKETCH_K) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Overall, sector and cap curve with sketched medians, from one pass over the bars."""
    cells = settle(sketched_cells(normalized, k))
    return curve_from_cells(cells, bands=True), curve_from_cells(cells, ["sector"]), curve_from_cells(cells, ["market_cap_band"])


def curve_overall(normalized: DataFrame, **options) -> DataFrame:
    return volume_curve(normalized, bands=True, **options)


def curve_by_sector(normalized: DataFrame, sectors: Sequence[str] | None = None, **options) -> DataFrame:
    """``sectors`` keeps a chosen subset; the filter reaches the scan of the bars."""
    if sectors is not None:
        normalized = normalized.where(F.col("sector").isin(*sectors))
    return volume_curve(normalized, by=["sector"], **options)


def curve_by_cap(normalized: DataFrame, **options) -> DataFrame:
    return volume_curve(normalized, by=["market_cap_band"], **options)


def bars_with_regime(
    normalized: DataFrame, volatility: DataFrame, size: int | None = None, salts: int | None = None, rated_only: bool = True
) -> DataFrame:
    """Bars of rated days with the day's regime.  Unrated bars drop out, unless ``rated_only`` is false: then their regime is NULL.

    ``size``: bytes of ``volatility``, if it was measured before.  ``salts=0``: join by
    key alone, as for tables in shared buckets of (ticker, trade_date), or of these and
    ``bar_hour`` where ``volatility`` has a row for each hour.
    """
    keys = ["ticker", "trade_date", *(["bar_hour"] if "bar_hour" in volatility.columns else [])]
    days = volatility.select(*keys, "vol_regime", F.col("realized_vol_20d").alias("realized_vol"))
    if salts == 0:
        # Plain equality keeps the buckets; the few bars without a ticker or a day are joined apart.
        apart = F.col("ticker").isNull() | F.col("trade_date").isNull()
        joined = lookup_join(normalized.where(~apart), days, keys, size=size, salts=0).unionByName(
            lookup_join(normalized.where(apart), days.where(apart), keys, null_safe=True, size=size, spread=("bar_time",))
        )
    else:
        joined = lookup_join(normalized, days, keys, null_safe=True, size=size, salts=salts, spread=("bar_time",))
    return (joined.where(F.col("vol_regime").isNotNull()) if rated_only else joined).select(
        "ticker", "sector", "market_cap_band", *SLOT, "trade_date", "normalized_volume",
        "vol_regime", "realized_vol",
    )


def curve_by_regime(
    normalized: DataFrame, volatility: DataFrame, shared_buckets: bool = False, **options
) -> DataFrame:
    """Curve per volatility regime, with the mean volatility behind each point.

    ``volatility`` is read up to three times: give a table or what ``daily_volatility``
    returns.  The second look of the median first cuts the bars to the value ranges of
    their slot, so that only a few bars in a hundred go through the join again.
    ``shared_buckets``: both are tables in the same buckets of (ticker, trade_date), or with the volatility once
    for each ``bar_hour`` in buckets of all three, and are joined where they lie.
    """
    size = measured_bytes(volatility)

    def near_the_middle(brackets: DataFrame) -> DataFrame:
        spans = [
            F.max(F.when(F.col("vol_regime") == regime, F.col(end))).alias(f"{end}_{regime}")
            for regime in REGIMES for end in ("_from", "_to")
        ]
        near = lookup_join(normalized, brackets.groupBy(*SLOT).agg(*spans), SLOT, "inner")
        value = F.col("normalized_volume")
        within = [value.between(F.col(f"_from_{regime}"), F.col(f"_to_{regime}")) for regime in REGIMES]
        return bars_with_regime(near.where(within[0] | within[1]), volatility, size, salts=0 if shared_buckets else None)

    return volume_curve(
        bars_with_regime(normalized, volatility, size, salts=0 if shared_buckets else None),
        by=["vol_regime"],
        averages=["realized_vol"],
        candidates=near_the_middle,
        **options,
    )
