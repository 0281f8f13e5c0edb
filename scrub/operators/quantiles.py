"""Quantiles of many numeric columns at once, approximate or exact.

NULL and NaN take no part. Every task sends a digest per column, whose size grows with the accuracy.
Small digests of all columns are merged in one place; larger ones by a reducer for each column.

The exact way reads the table twice, whatever its size, and never gathers a column in one task. The first
reading sketches every column; partial sketches are merged by salted groups first, so no task takes one from
each of the others. Two quantiles a little to either side bracket a wanted rank. The second reading counts
what lies below, on and between the two ends, and writes what lies between, a few hundredths of the
values. The search goes on in that table, in the same way, until so few rows are left that Spark's own exact
aggregate can take them. Values that repeat a lot end up as the ends of a bracket and are settled by
counting, so duplicates neither are written nor keep a bracket from shrinking. Should a sketch be further off
than its bracket allows, the table is read once more for the rank it missed.

Whole numbers and decimals of up to 18 digits are compared as whole numbers, all others as doubles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null, ref, rows_from_one
from ..sources.staging import materialize

# Values left in a bracket that a built-in exact aggregate may take into one task.
EXACT_VALUES = 1_000
# Size of a sketch, whose error in rank is 0.0035 with 99 % confidence, and how far a bracket goes to either side.
SKETCH_SIZE, MARGIN = 800, 0.01
# Groups in which partial sketches are merged before they meet.
SALTS = 64
# Up to this accuracy a digest is a few kilobytes and a single reducer merges those of all columns.
SMALL_ACCURACY = 200
# Spark sorts instead of hashing when such an aggregate meets more groups than 128.
COLUMNS_PER_PASS = 100


def _value(df: DataFrame, name: str) -> Column:
    return nan_to_null(ref(name), df.schema[name].dataType)


def _by_place(values: list[Column], df: DataFrame, measure: Column) -> DataFrame:
    """(place, found): the aggregate ``measure`` of ``value`` for each of the columns given.

    A column without any value has no row.
    """
    passes = []
    for start in range(0, len(values), COLUMNS_PER_PASS):
        part = values[start:start + COLUMNS_PER_PASS]
        cells = [x for i, v in enumerate(part, start) for x in (F.lit(i), v)]
        pairs = df.select(F.stack(F.lit(len(part)), *cells).alias("place", "value"))
        passes.append(
            pairs.where("value IS NOT NULL").groupBy("place").agg(measure.alias("found"))
        )
    return reduce(DataFrame.unionByName, passes)


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], relative_error: float
) -> DataFrame:
    """(place, found): approximate quantiles, as an array, of the column at that place in the list.

    A column without values has no row.
    """
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    accuracy = max(1, round(1 / relative_error))
    values = [_value(df, c).cast("double") for c in columns]
    if accuracy > SMALL_ACCURACY:
        return _by_place(values, df, F.percentile_approx("value", wanted, accuracy))
    one_row = df.agg(
        *[F.percentile_approx(v, wanted, accuracy).alias(f"q{i}") for i, v in enumerate(values)]
    )
    rows = [{"place": F.lit(i), "found": F.col(f"q{i}")} for i in range(len(values))]
    return rows_from_one(one_row, rows).where("found IS NOT NULL")


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.01,
    exact: bool = False,
    exact_values: int = EXACT_VALUES,
) -> dict[str, list[float] | None]:
    """Quantiles by column name; None for a column without values.

    Approximate: values of the column, at most ``relative_error`` off in rank. Exact: linear
    interpolation between neighbouring values; a whole number or decimal if nothing is to be interpolated.
    """
    if not columns:
        return {}
    if exact:
        return _exact(df, columns, probabilities, exact_values)
    rows = approx_quantiles(df, columns, probabilities, relative_error).collect()
    found = {r.place: r.found for r in rows}
    return {c: found.get(i) for i, c in enumerate(columns)}


@dataclass
class _Search:
    """Looking for the values at sorted positions ``first`` and ``first + 1`` of one column.

    Both lie strictly between ``low`` and ``high`` (None: no bound), after ``below`` other values.
    """

    column: str
    first: int
    wanted: set[int]
    found: dict[int, float]
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0

    def range_of(self, value: Column) -> Column:
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value > F.lit(self.low))
        if self.high is not None:
            test = test & (value < F.lit(self.high))
        return test

    @property
    def open(self) -> bool:
        self.wanted -= self.found.keys()
        return bool(self.wanted)

    def counts(self, value: Column, low, high, i: int) -> list[Column]:
        """Aggregates: values below, up to the one and the other end."""
        low, high = F.lit(low), F.lit(high)
        return [
            F.count_if(value < low).alias(f"a{i}"), F.count_if(value <= low).alias(f"b{i}"),
            F.count_if(value < high).alias(f"c{i}"), F.count_if(value <= high).alias(f"d{i}"),
        ]

    def settle(self, low, high, below_low: int, to_low: int, below_high: int, to_high: int) -> bool:
        """Learn from the counts of the whole column around two of its values. True if what is left
        lies between them.
        """
        for place in self.wanted:
            if below_low <= place < to_low:
                self.found[place] = low
            elif below_high <= place < to_high:
                self.found[place] = high
        if not self.open:
            return True
        self.first = min(self.wanted)
        if self.first < below_low:
            self.high, self.inside = low, below_low - self.below
        elif self.first >= to_high:
            self.inside -= to_high - self.below
            self.low, self.below = high, to_high
        else:
            self.low, self.high, self.below, self.inside = low, high, to_low, below_high - to_low
            return True
        return False


def _scale(kind: T.DataType) -> int | None:
    """Digits behind the point of a type whose values are compared as whole numbers, else None."""
    if isinstance(kind, T.DecimalType):
        return kind.scale if kind.precision <= 18 else None
    return 0 if isinstance(kind, T.IntegralType) else None


def _exact(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], exact_values: int
) -> dict[str, list[float] | None]:
    scales = {f"v{i}": _scale(df.schema[c].dataType) for i, c in enumerate(columns)}
    exact = {}
    for i, c in enumerate(columns):
        scale, value = scales[f"v{i}"], _value(df, c)
        if scale is None:
            exact[f"v{i}"] = value.cast("double")
        else:
            whole = value if scale == 0 else value * F.lit(10 ** scale).cast(T.DecimalType(scale + 1, 0))
            exact[f"v{i}"] = whole.cast("long")
    numbers = df.select(*[v.alias(n) for n, v in exact.items()])
    ends = [x for p in probabilities for x in (max(p - MARGIN, 0.0), min(p + MARGIN, 1.0))]
    sketched = _sketched(numbers, [F.col(c) for c in numbers.columns], ends)
    searches: dict[tuple[str, float], _Search] = {}
    for i, c in enumerate(numbers.columns):
        size, proposed = sketched.get(i, (0, []))
        for at, p in enumerate(probabilities if size else ()):
            position = p * (size - 1)
            places = {math.floor(position), math.ceil(position)}
            search = searches[c, p] = _Search(c, min(places), places, {}, inside=size)
            if size > exact_values:
                search.low, search.high = proposed[2 * at:2 * at + 2]
    left, count = list(searches.values()), True
    while left:
        table, missed = _survivors(numbers, left, count)
        _narrow(table, [s for s in left if s not in missed], exact_values)
        left, count = missed, False
    answers: dict[str, list[float] | None] = {}
    for i, name in enumerate(columns):
        size, scale = sketched.get(i, (0, []))[0], scales[f"v{i}"]
        answers[name] = [
            _between(searches[f"v{i}", p], p * (size - 1), scale) for p in probabilities
        ] if size else None
    return answers


def _between(search: _Search, position: float, scale: int | None) -> float | int | Decimal:
    """The value at a position; exact where it needs no rounding."""
    low, high = (search.found[x] for x in (math.floor(position), math.ceil(position)))
    if scale is None:
        share = position - math.floor(position)
        return low if low == high else (1 - share) * low + share * high
    share = Fraction(position) - math.floor(position)
    value = (low + (high - low) * share) / 10 ** scale
    if low != high:
        return float(value)
    return Decimal(low).scaleb(-scale) if scale else low


def _sketched(
    df: DataFrame, values: list[Column], shares: Sequence[float]
) -> dict[int, tuple[int, list]]:
    """By place of the value: how many there are, and the approximate quantiles at the shares."""
    wanted = F.array(*[F.lit(float(x)) for x in shares])
    kinds = [k for _, k in df.select(*[v.alias(f"c{i}") for i, v in enumerate(values)]).dtypes]
    found: dict[int, tuple[int, list]] = {}
    for start in range(0, len(values), COLUMNS_PER_PASS):
        part = list(zip(values, kinds))[start:start + COLUMNS_PER_PASS]
        cells = []
        for i, (v, kind) in enumerate(part, start):
            empty = F.lit(None)
            cells += [F.lit(i), *((v, empty.cast("double")) if kind == "bigint" else (empty.cast("long"), v))]
        pairs = df.select(F.stack(F.lit(len(part)), *cells).alias("place", "whole", "double"))
        salted = pairs.where("whole IS NOT NULL OR double IS NOT NULL").withColumn("salt", F.spark_partition_id() % SALTS)
        merged = salted.groupBy("place", "salt").agg(
            F.count("whole").alias("wholes"), F.count("double").alias("doubles"),
            F.kll_sketch_agg_bigint("whole", SKETCH_SIZE).alias("a"), F.kll_sketch_agg_double("double", SKETCH_SIZE).alias("b"),
        ).groupBy("place").agg(
            F.sum("wholes").alias("wholes"), F.sum("doubles").alias("doubles"),
            F.kll_merge_agg_bigint("a", SKETCH_SIZE).alias("a"), F.kll_merge_agg_double("b", SKETCH_SIZE).alias("b"),
        )
        some = {"a": F.col("wholes") > 0, "b": F.col("doubles") > 0}
        rows = merged.select(
            "place", (F.col("wholes") + F.col("doubles")).alias("n"),
            F.when(some["a"], F.kll_sketch_get_quantile_bigint(F.when(some["a"], F.col("a")), wanted)).alias("wholes"),
            F.when(some["b"], F.kll_sketch_get_quantile_double(F.when(some["b"], F.col("b")), wanted)).alias("doubles"),
        ).collect()  # a row per column
        found |= {r.place: (r.n, r.wholes if r.wholes is not None else r.doubles) for r in rows}
    return found


def _survivors(numbers: DataFrame, searches: list[_Search], count: bool) -> tuple[DataFrame, list[_Search]]:
    """One reading of the table: what lies strictly between the ends of any search, as a stored table.

    With ``count`` the searches learn how many values lie around their ends, and get the values that follow from that.
    Those whose ranks are not between their ends come back with the range that holds them.
    """
    seen = Observation()
    around = [c for i, s in enumerate(searches) if count and s.low is not None for c in s.counts(F.col(s.column), s.low, s.high, i)]
    counted = numbers.observe(seen, *around) if around else numbers
    kept = {}
    for c in numbers.columns:
        own = [s.range_of(F.col(c)) for s in searches if s.column == c]
        if own:
            kept[c] = F.when(reduce(Column.__or__, own), F.col(c)).alias(c)
    masked = counted.select(*kept.values())
    table = materialize(masked.where(reduce(Column.__or__, [F.col(c).isNotNull() for c in kept])), "between")
    if not around:
        return table, []
    found = seen.get
    ends = {i: (s.low, s.high) for i, s in enumerate(searches) if s.low is not None}
    missed = []
    for i, (low, high) in ends.items():
        searches[i].low = searches[i].high = None
        if not searches[i].settle(low, high, *(found[f"{k}{i}"] for k in "abcd")):
            missed.append(searches[i])
    return table, missed


def _narrow(numbers: DataFrame, searches: list[_Search], few_rows: int) -> None:
    while True:
        open_searches = [s for s in searches if s.open]
        if not open_searches:
            return
        few = [s for s in open_searches if s.inside <= few_rows]
        many = [s for s in open_searches if s.inside > few_rows]
        if few:
            _finish(numbers, few)
        if many:
            _bracket(numbers, many)


def _finish(numbers: DataFrame, searches: list[_Search]) -> None:
    """Few values are left inside: sort them and take those at the positions."""
    aggs, places = [], []
    for i, s in enumerate(searches):
        inside = F.sort_array(F.collect_list(F.when(s.range_of(F.col(s.column)), F.col(s.column))))
        for w in sorted(s.wanted):
            aggs.append(F.get(inside, F.lit(w - s.below)).alias(f"r{i}_{w}"))
            places.append((s, w))
    row = numbers.agg(*aggs).first()
    for (s, w), value in zip(places, row):
        s.found[w] = value


def _bracket(numbers: DataFrame, searches: list[_Search]) -> None:
    """One aggregate proposes the ends of smaller brackets, a second one counts around them."""
    inside, shares = [], []
    for s in searches:
        inside.append(F.when(s.range_of(F.col(s.column)), F.col(s.column)))
        share = (min(s.wanted) - s.below) / s.inside
        shares.append([max(share - MARGIN, 0.0), min(share + MARGIN, 1.0)])
    # The wanted shares differ by search, so each pair of ends is picked from all of them.
    every = sorted({x for ends in shares for x in ends})
    found = _sketched(numbers, inside, every)
    proposed = [[found[i][1][every.index(x)] for x in ends] for i, ends in enumerate(shares)]
    counted = numbers.agg(*[c for i, s in enumerate(searches) for c in s.counts(inside[i], *proposed[i], i)]).first()
    for i, s in enumerate(searches):
        s.settle(*proposed[i], *(s.below + counted[f"{k}{i}"] for k in "abcd"))
