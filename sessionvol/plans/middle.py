"""Count, mean, deviation and exact middle values of groups of any size.

Spark's own ``median`` and ``percentile_disc`` keep a value -> count map of a whole
group in one task.  Here each group is first counted into cells of an
order-preserving function of the value.  The cell counts, pre-aggregated by every
map task, give the moments and name the one cell that holds the middle ranks; only
the rows of that cell are looked at again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionvol.plans.joins import lookup_join, total_bytes
from sessionvol.session import settle, settle_measured

CELLS_PER_OCTAVE = 32  # first pass: cells 2.2 % wide, few enough to combine well map-side
CELLS = 4096           # later passes: cells of equal width inside one first-pass cell
SORT_ROWS = 4_000_000  # distinct values of a group that one task may sort

_BOUNDS = ("_from", "_to", "_before", "_total")


def _first_cell(value: Column) -> Column:
    """Cell number on a logarithmic scale; rises with the value, NULL for NULL and NaN.
    2,000 octaves bound the number of cells."""
    base = 1100 * CELLS_PER_OCTAVE  # log2 of a double lies within +-1100

    def scaled(size: Column) -> Column:
        return F.floor(F.least(F.log2(size), F.lit(1090.0)) * CELLS_PER_OCTAVE) + base

    return (
        F.when(value.isNull() | F.isnan(value), None)
        .when(value > 0, scaled(value))
        .when(value < 0, -scaled(-value))
        .otherwise(F.lit(0))
    )


def _holding(cells: DataFrame, keys: Sequence[str], before: Column, total: Column) -> DataFrame:
    """Per cell: values below it, and whether it holds the lower and upper middle rank."""
    group = Window.partitionBy(*keys)
    up_to = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = before + F.sum("_n").over(up_to) - F.col("_n")

    def holds(rank: Column) -> Column:
        return (F.col("_below") <= rank) & (rank < F.col("_below") + F.col("_n"))

    return cells.select("*", total.alias("_total"), below.alias("_below")).select(
        "*",
        holds(F.floor((F.col("_total") - 1) / 2)).alias("_has_lower"),
        holds(F.floor(F.col("_total") / 2)).alias("_has_upper"),
    )


def _bracket() -> list[Column]:
    """Lower and upper middle value where the cells already tell them, else their bounds.

    When the two middle ranks lie in different cells, the lower one is the last value of
    its cell and the upper one the first value of its own.
    """
    lower = F.col("_has_lower")
    upper = F.col("_has_upper")
    both = lower & upper
    single = F.col("_low") == F.col("_high")
    return [
        F.max(F.when(lower & (single | ~upper), F.col("_high"))).alias("_lower"),
        F.max(F.when(upper & (single | ~lower), F.col("_low"))).alias("_upper"),
        F.max(F.when(both & ~single, F.col("_low"))).alias("_from"),
        F.max(F.when(both & ~single, F.col("_high"))).alias("_to"),
        F.max(F.when(both & ~single, F.col("_below"))).alias("_before"),
        F.max(F.when(both & ~single, F.col("_distinct"))).alias("_size"),
        F.max("_total").alias("_total"),
    ]


def _settled(found: DataFrame) -> tuple[DataFrame, int, int]:
    """Cell results, their bytes, and the distinct values of the largest open bracket."""
    facts = {"size": total_bytes(found), "largest": F.coalesce(F.max("_size"), F.lit(0))}
    settled, facts = settle_measured(found, **facts)
    return settled, facts["size"], facts["largest"]


def _inside(rows: DataFrame, brackets: DataFrame, size: int, keys: Sequence[str]) -> DataFrame:
    """Rows whose value lies in their group's bracket, with the bracket attached."""
    bounds = brackets.select(*keys, *_BOUNDS)
    joined = lookup_join(rows, bounds, keys, "inner", null_safe=True, size=size)
    return joined.where(F.col("_value").between(F.col("_from"), F.col("_to")))


def _narrowed(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One pass over the distinct values inside the brackets: next, smaller brackets.
    The smallest and largest value fall into different cells, so each pass shrinks."""
    share = (F.col("_value") - F.col("_from")) / (F.col("_to") - F.col("_from"))
    cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1))
    cells = counts.groupBy(*keys, cell.alias("_cell")).agg(
        F.sum("_weight").alias("_n"),
        F.count(F.lit(1)).alias("_distinct"),
        F.min("_value").alias("_low"),
        F.max("_value").alias("_high"),
        F.max("_before").alias("_start"),
        F.max("_total").alias("_all"),
    )
    return _holding(cells, keys, F.col("_start"), F.col("_all")).groupBy(*keys).agg(*_bracket())


def _ranked(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last step: running counts over the few distinct values left in each bracket."""
    cells = counts.select(
        *keys,
        F.col("_value").alias("_cell"),
        F.col("_value").alias("_low"),
        F.col("_value").alias("_high"),
        F.col("_weight").alias("_n"),
        F.lit(1).alias("_distinct"),
        F.col("_before").alias("_start"),
        F.col("_total").alias("_all"),
    )
    return _holding(cells, keys, F.col("_start"), F.col("_all")).groupBy(*keys).agg(*_bracket())


@dataclass
class _Look:
    """First look at one set of keys: a row per group, its bytes, its largest open bracket."""

    keys: list[str]
    summary: DataFrame
    size: int
    largest: int

    @property
    def brackets(self) -> DataFrame:
        return self.summary.where(F.col("_from").isNotNull())

    def middles(self, found: DataFrame) -> DataFrame:
        """Groups whose two middle values are known."""
        return found.where(F.col("_from").isNull()).select(
            *self.keys, F.col("_lower").alias("lower"), F.col("_upper").alias("upper")
        )


def _first_cells(df: DataFrame, keys: Sequence[str], number: Column, averages: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys, _first_cell(number).alias("_cell")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(number).alias("_n"),
        F.avg(number).alias("_mean"),
        F.var_pop(number).alias("_var"),
        F.min(number).alias("_low"),
        F.max(number).alias("_high"),
        *[F.sum(c).alias(f"_sum_{c}") for c in averages],
        *[F.count(c).alias(f"_count_{c}") for c in averages],
    )


def _mean_over(keys: Sequence[str]) -> Column:
    group = Window.partitionBy(*keys)
    return F.sum(F.col("_n") * F.col("_mean")).over(group) / F.nullif(F.sum("_n").over(group), F.lit(0))


def _spread_around(mean: str) -> Column:
    """Variance of merged cells from their own variances and the distance of their means."""
    apart = F.col("_mean") - F.col(mean)
    return F.sum(F.col("_n") * (F.col("_var") + apart * apart)) / F.nullif(F.sum("_n"), F.lit(0))


def _merged(cells: DataFrame, keys: Sequence[str], averages: Sequence[str]) -> DataFrame:
    """Cells of finer groups merged to cells of ``keys``."""
    sums = [c for name in averages for c in (f"_sum_{name}", f"_count_{name}")]
    return cells.withColumn("_merged_mean", _mean_over([*keys, "_cell"])).groupBy(*keys, "_cell").agg(
        F.sum("_rows").alias("_rows"),
        F.sum("_n").alias("_n"),
        F.max("_merged_mean").alias("_mean"),
        _spread_around("_merged_mean").alias("_var"),
        F.min("_low").alias("_low"),
        F.max("_high").alias("_high"),
        *[F.sum(c).alias(c) for c in sums],
    )


def _first_look(cells: DataFrame, keys: Sequence[str], averages: Sequence[str]) -> _Look:
    at_most = F.col("_n").alias("_distinct")
    cells = cells.select("*", at_most, _mean_over(keys).alias("_group_mean"))
    held = _holding(cells, keys, F.lit(0), F.sum("_n").over(Window.partitionBy(*keys)))
    found = held.groupBy(*keys).agg(
        F.sum("_rows").alias("rows"),
        F.max("_group_mean").alias("mean"),
        F.sqrt(_spread_around("_group_mean")).alias("deviation"),
        *[
            (F.sum(f"_sum_{c}") / F.nullif(F.sum(f"_count_{c}"), F.lit(0))).alias(c)
            for c in averages
        ],
        *_bracket(),
    )
    return _Look(list(keys), *_settled(found))


def _second_look(source: DataFrame, look: _Look) -> DataFrame:
    """Counts of the distinct values inside one look's brackets."""
    inside = _inside(source.select(*look.keys, "_value"), look.brackets, look.size, look.keys)
    return inside.groupBy(*look.keys, "_value", *_BOUNDS).agg(F.count(F.lit(1)).alias("_weight"))


def _second_looks(source: DataFrame, keys: Sequence[str], looks: Sequence[_Look]) -> list[DataFrame]:
    """The same for several looks in one pass over ``source``.

    A row is counted once for every look that has it in a bracket; keys that are not the
    look's are blanked.
    """
    hits = []
    for number, look in enumerate(looks):
        low, high = f"_from_{number}", f"_to_{number}"
        bounds = look.brackets.select(*look.keys, F.col("_from").alias(low), F.col("_to").alias(high))
        source = lookup_join(source, bounds, look.keys, "left", null_safe=True, size=look.size)
        hits.append(F.when(F.col("_value").between(F.col(low), F.col(high)), number))
    own = [[number for number, look in enumerate(looks) if key in look.keys] for key in keys]
    counts = settle(
        source.select(*keys, "_value", F.explode(F.array_compact(F.array(*hits))).alias("_look"))
        .select(
            "_look", "_value",
            *[F.when(F.col("_look").isin(n), F.col(key)).alias(key) for key, n in zip(keys, own, strict=True)],
        )
        .groupBy("_look", *keys, "_value")
        .agg(F.count(F.lit(1)).alias("_weight"))
    )
    return [
        _inside(
            counts.where(F.col("_look") == number).select(*look.keys, "_value", "_weight"),
            look.brackets, look.size, look.keys,
        )
        for number, look in enumerate(looks)
    ]


def _finished(look: _Look, counts: DataFrame | None, averages: Sequence[str], sort_rows: int) -> DataFrame:
    """Narrow until what is left of each group can be sorted, then rank it."""
    found, size, largest = look.middles(look.summary), look.size, look.largest
    while largest > sort_rows:
        counts = settle(counts)
        narrowed, size, largest = _settled(_narrowed(counts, look.keys))
        found = found.unionByName(look.middles(narrowed))
        still_open = narrowed.where(F.col("_from").isNotNull())
        counts = _inside(counts.drop(*_BOUNDS), still_open, size, look.keys)
    if largest:
        found = found.unionByName(look.middles(_ranked(counts, look.keys)))
    facts = look.summary.select(*look.keys, "rows", "mean", "deviation", *averages)
    return _per_group(facts, found, look.keys)


def group_summary(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    averages: Sequence[str] = (),
    candidates: Callable[[DataFrame], DataFrame] | None = None,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """One row per group: rows, mean, deviation, lower, upper and one mean per ``averages``.

    ``rows`` counts all rows; the rest skips NULL and NaN.  ``lower`` and ``upper`` are
    the two middle values, equal for odd counts.  ``candidates`` may give a cheaper frame
    for the second look: called with the brackets (keys, _from, _to), it must return at
    least the rows of ``df`` inside them.
    """
    measure = number(value)
    look = _first_look(_first_cells(df, keys, measure, averages), keys, averages)
    counts = None
    if look.largest:
        source = candidates(look.brackets.select(*keys, "_from", "_to")) if candidates else df
        counts = _second_look(source.select(*keys, measure.alias("_value")), look)
    return _finished(look, counts, averages, sort_rows)


def group_summaries(
    df: DataFrame,
    key_sets: Sequence[Sequence[str]],
    value: str,
    averages: Sequence[str] = (),
    sort_rows: int = SORT_ROWS,
) -> list[DataFrame]:
    """``group_summary`` for several sets of keys with two passes over ``df`` in all: the
    cells of all keys together are merged for each set."""
    keys = list(dict.fromkeys(key for key_set in key_sets for key in key_set))
    measure = number(value)
    cells = settle(_first_cells(df, keys, measure, averages))
    looks = [_first_look(_merged(cells, key_set, averages), key_set, averages) for key_set in key_sets]
    counts = [None] * len(looks)
    if any(look.largest for look in looks):
        counts = _second_looks(df.select(*keys, measure.alias("_value")), keys, looks)
    return [
        _finished(look, counted, averages, sort_rows)
        for look, counted in zip(looks, counts, strict=True)
    ]


def number(value: str) -> Column:
    """The value as a double; NaN becomes NULL."""
    return F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))


def _per_group(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides have one row per group; Spark picks the join from their sizes."""
    right = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    match = [left[key].eqNullSafe(right[f"_right_{key}"]) for key in keys]
    return left.join(right, match, "left").drop(*[f"_right_{key}" for key in keys])
