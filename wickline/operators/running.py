"""Ranks, running totals and quantiles over a whole table without one task seeing it all.

A window over the full order would sort everything in one task. Here rows fall into buckets that
respect the order; each bucket's totals are small, their running sum gives every bucket its offset,
and only the rows of one bucket share a task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wickline.session import settled
from wickline.small import broadcast_table_if_small

ROWS_PER_BUCKET = 1_000_000
#: Borders that one sketch of the whole table gives; more come from sketches of the ranges between these.
FIRST_BORDERS = 1_000


def _equal_on(left: str, right: str, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def leading_digits(rows: int) -> int:
    """How many hex digits of a hash leave at most about a bucket of rows to each of their values."""
    digits = 1
    while rows > ROWS_PER_BUCKET * 16**digits:
        digits += 1
    return digits + 1


def hash_ranked(df: DataFrame, shuffle: Column, within: Sequence[str] = (), digits: int | None = None,
                name: str = "rank") -> DataFrame:
    """1-based rank of every row in the order of a hash text, per group.

    The leading hex digits of the hash split even one huge group into equal parts, as many as the row
    count calls for.
    """
    digits = digits or leading_digits(df.count())
    keys = [*within, "__part"]
    split = df.withColumn("__order", shuffle).withColumn("__part", F.substring("__order", 1, digits))
    sizes = split.groupBy(*keys).agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*within).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys).orderBy("__order")
    numbered = split.withColumn("__i", F.row_number().over(inside))
    return (numbered.alias("a").join(offsets.alias("b"), _equal_on("a", "b", keys))
            .select(*[F.col(f"a.{c}").alias(c) for c in df.columns],
                    (F.col("a.__i") + F.col("b.__before")).alias(name)))


def _even_borders(column: str, parts: int) -> Column:
    fractions = ", ".join(f"{i}D / {parts}D" for i in range(1, parts))
    name = column.replace("`", "``")
    return F.expr(f"percentile_approx(cast(`{name}` as double), array({fractions}), {4 * parts})")


def cut_points(df: DataFrame, column: str, rows_per_bucket: int = ROWS_PER_BUCKET,
               first_borders: int = FIRST_BORDERS) -> list[float]:
    """Inner borders of equally filled value ranges; empty when one bucket is enough.

    A count decides whether borders are needed at all. They come from one quantile sketch and, where more than
    ``first_borders`` ranges are wanted, from a sketch within each of its ranges.
    """
    wanted = -(-df.count() // rows_per_bucket)
    if wanted <= 1:
        return []
    cuts = sorted(set(df.agg(_even_borders(column, min(wanted, first_borders))).first()[0] or []))
    finer = -(-wanted // first_borders)
    if finer > 1:
        values = df.select(F.col(column).cast("double").alias("value")).where("value is not null and not isnan(value)")
        within = with_bucket(values, "value", cuts).groupBy("__bucket").agg(_even_borders("value", finer).alias("cuts"))
        cuts = sorted({*cuts, *(c for r in within.collect() for c in r["cuts"])})
    return cuts


def with_bucket(df: DataFrame, column: str, cuts: Sequence[float], name: str = "__bucket") -> DataFrame:
    """Number of the value range a row falls into (a range starts at its cut); ascending with the column."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    if len(cuts) <= 32:
        value = F.col(column)
        return df.withColumn(name, sum(((value >= F.lit(c)).cast("int") for c in cuts[1:]),
                                       (value >= F.lit(cuts[0])).cast("int")))
    cast = df.withColumn("__value", F.col(column).cast("double"))
    ranges = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="__value", outputCol=name, handleInvalid="keep")
    return ranges.transform(cast).withColumn(name, F.col(name).cast("int")).drop("__value")


def running_totals(df: DataFrame, order: str, sums: dict[str, str], within: Sequence[str] = (),
                   cuts: Sequence[float] = (), descending: bool = False, base: DataFrame | None = None) -> DataFrame:
    """Add inclusive running sums along ``order`` (whose values are distinct per group).

    ``sums`` maps a new column to the column it accumulates. ``cuts`` come from :func:`cut_points`;
    without them the rows are known to fit one task. If ``df`` is itself an aggregate, ``base`` gives the
    rows it was made from, with the same columns: bucket sums are then taken from them directly, which
    spares a second pass through the aggregate's shuffle.
    """
    def direction(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    if not cuts:
        along = Window.partitionBy(*within).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(along).alias(n) for n, c in sums.items()])
    keys = [*within, "__bucket"]
    split = with_bucket(df, order, cuts)
    rows = split if base is None else with_bucket(base, order, cuts)
    totals = rows.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.partitionBy(*within).orderBy(direction("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums])
    inside = Window.partitionBy(*keys).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = split.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    return (local.alias("a").join(offsets.alias("b"), _equal_on("a", "b", keys))
            .select(*[F.col(f"a.{c}").alias(c) for c in df.columns],
                    *[(F.col(f"a.{n}") + F.col(f"b.{n}")).alias(n) for n in sums]))


def ordered_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str],
                 rows_per_range: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add inclusive running sums along columns of any type, whose values together are distinct.

    A table that fits one task is summed there. A larger one is written in ranges of the order, and each range
    starts from the sums of those before it.
    """
    along = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ranges = -(-df.count() // rows_per_range)
    if ranges <= 1:
        return df.select("*", *[F.sum(c).over(along).alias(n) for n, c in sums.items()])
    split = settled(df.repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    totals = split.groupBy("__range").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__range", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__{n}") for n in sums])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = split.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    return local.join(offsets, "__range").select(*df.columns, *[(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums])


def next_values(df: DataFrame, order: str, columns: dict[str, str], within: Sequence[str] = (),
                cuts: Sequence[float] = (), descending: bool = False) -> DataFrame:
    """Add columns of the following row along ``order``; NULL on the last one.

    ``columns`` maps a new name to the column it is read from. The last row of a bucket takes the first
    row of the next bucket that has any.
    """
    def direction(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    if not cuts:
        along = Window.partitionBy(*within).orderBy(direction(order))
        return df.select("*", *[F.lead(c).over(along).alias(n) for n, c in columns.items()])
    keys = [*within, "__bucket"]
    split = with_bucket(df, order, cuts)
    head = F.max_by if descending else F.min_by
    firsts = split.groupBy(*keys).agg(*[head(c, order).alias(n) for n, c in columns.items()])
    onward = Window.partitionBy(*within).orderBy(direction("__bucket"))
    heads = firsts.select(*keys, *[F.lead(n).over(onward).alias(n) for n in columns])
    inside = Window.partitionBy(*keys).orderBy(direction(order))
    local = split.select("*", F.lead(F.lit(True), 1, False).over(inside).alias("__more"),
                         *[F.lead(c).over(inside).alias(n) for n, c in columns.items()])
    return (local.alias("a").join(heads.alias("b"), _equal_on("a", "b", keys))
            .select(*[F.col(f"a.{c}").alias(c) for c in df.columns],
                    *[F.when(F.col("a.__more"), F.col(f"a.{n}")).otherwise(F.col(f"b.{n}")).alias(n)
                      for n in columns]))


SORTED_ROWS = 200_000
SKETCH = 2_000


class _Fence(NamedTuple):
    """A value range around the wanted 0-based ranks ``first`` and ``last`` of a column."""

    first: int
    last: int
    weight: float
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0


def _confirmed(frame: DataFrame, fences: dict[tuple, _Fence], ends: dict[tuple, tuple]) -> dict[tuple, _Fence]:
    """Fences with the proposed ends, as far as exact counts show the wanted ranks to lie inside."""
    counts = []
    for c, i in ends:
        low, high = ends[(c, i)]
        counts += [F.count_if(F.col(c) < low), F.count_if(F.col(c).between(low, high))]
    found = frame.agg(*counts).first()
    closer = {}
    for n, t in enumerate(ends):
        below, inside, f = found[2 * n], found[2 * n + 1], fences[t]
        if below <= f.first and f.last < below + inside:
            closer[t] = f._replace(low=ends[t][0], high=ends[t][1], below=below, inside=inside)
    return closer


def _narrow(frame: DataFrame, fences: dict[tuple, _Fence]) -> dict[tuple, _Fence]:
    """Closer fences from sketches of the values inside the present ones."""
    sketches = []
    for (c, _), f in fences.items():
        span = [max(0.0, (f.first - f.below) / f.inside - 2 / SKETCH),
                min(1.0, (f.last - f.below) / f.inside + 2 / SKETCH)]
        sketches.append(F.percentile_approx(F.when(F.col(c).between(f.low, f.high), F.col(c)), span, SKETCH))
    seen = frame.agg(*sketches).first()
    return _confirmed(frame, fences, {t: tuple(q) for t, q in zip(fences, seen)})


def exact_quantiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float],
                    sort_rows: int = SORTED_ROWS) -> DataFrame:
    """Exact linear-interpolated quantiles of the present values: one row per column, ``q0 .. qn``.

    Sketches fence in the few values around each wanted rank and exact counts confirm them, so that only
    the rows inside the fences are grouped by value and ranked. A fence that stays wide, because very many
    distinct values lie close together, is ranked in buckets.
    """
    void = F.lit(None).cast("double")
    frame = df.select(*[F.nanvl(F.col(c).cast("double"), void).alias(c) for c in columns])
    spans = [x for q in fractions for x in (max(0.0, q - 3 / SKETCH), min(1.0, q + 3 / SKETCH))]
    seen = frame.agg(*[F.count(c) for c in columns], *[F.percentile_approx(c, spans, SKETCH) for c in columns]).first()
    sizes = dict(zip(columns, seen))
    fences, ends = {}, {}
    for c, sketch in zip(columns, seen[len(columns):]):
        for i, q in enumerate(fractions):
            at = (sizes[c] - 1) * q
            if sizes[c]:
                fences[(c, i)] = _Fence(math.floor(at), math.ceil(at), at - math.floor(at), inside=sizes[c])
            if sizes[c] > sort_rows:
                ends[(c, i)] = (sketch[2 * i], sketch[2 * i + 1])
    closer = _confirmed(frame, fences, ends) if ends else {}
    for _ in range(3):
        fences.update(closer)
        wide = {t: fences[t] for t in closer if fences[t].inside > sort_rows and fences[t].low < fences[t].high}
        if not wide:
            break
        closer = _narrow(frame, wide)
    fences.update(closer)

    # wanted ranks that share a fence share its rows
    shared = {k: n for n, k in enumerate(dict.fromkeys((c, f.low, f.high) for (c, _), f in fences.items()))}
    names = ", ".join(f"q{i} double" for i in range(len(fractions)))
    if not shared:
        return df.sparkSession.createDataFrame([], f"column string, n bigint, {names}")
    near = [F.when(F.col(c).between(low, high), F.struct(F.lit(c).alias("column"), F.lit(n).alias("fence"),
                                                         F.col(c).alias("value")))
            for (c, low, high), n in shared.items()]
    inside = frame.select(F.inline(F.array_compact(F.array(*near))))
    keys = ["column", "fence"]
    counts = inside.groupBy(*keys, "value").agg(F.count("*").alias("__n"))
    crowded = max(f.inside for f in fences.values()) > ROWS_PER_BUCKET
    ranked = running_totals(counts, "value", {"__upto": "__n"}, keys,
                            cut_points(inside, "value", ROWS_PER_BUCKET) if crowded else (),
                            base=inside.withColumn("__n", F.lit(1)))

    def known(values: dict) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for e in values.items() for x in e]), F.col("fence"))

    picks = []
    for i in range(len(fractions)):
        mine = {shared[(c, f.low, f.high)]: f for (c, slot), f in fences.items() if slot == i}
        for name, rank in (("low", {k: f.first - f.below for k, f in mine.items()}),
                           ("high", {k: f.last - f.below for k, f in mine.items()})):
            here = (F.col("__upto") - F.col("__n") <= known(rank)) & (known(rank) < F.col("__upto"))
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"{name}{i}"))
        picks.append(F.max(known({k: f.weight for k, f in mine.items()})).alias(f"weight{i}"))
    ends_found = ranked.groupBy("column").agg(*picks)
    counted = F.create_map(*[F.lit(x) for c in columns for x in (c, sizes[c])])
    return ends_found.select("column", F.element_at(counted, F.col("column")).alias("n"), *[
        (F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * F.col(f"weight{i}")).alias(f"q{i}")
        for i in range(len(fractions))])


def hash_cut_values(df: DataFrame, label: str, shuffle: Column, ranks: DataFrame, digits: int | None = None) -> DataFrame:
    """The hash text (label, slot, order) found at given 1-based ranks of each label's hash order.

    ``ranks`` has a row (label, slot, rank) for each wanted rank; ranks of 0 and below give none. NULL is a label
    like any other. Counts per leading digits find the part that holds a rank; only those few parts are read
    again and sorted.
    """
    wanted = ranks.where("rank > 0")
    digits = digits or leading_digits(wanted.agg(F.max("rank")).first()[0] or 1)
    keyed = df.select(F.col(label).alias("label"), shuffle.alias("order"))
    keyed = keyed.withColumn("part", F.substring("order", 1, digits))
    sizes = keyed.groupBy("label", "part").agg(F.count("*").alias("n"))
    along = Window.partitionBy("label").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    upto = sizes.withColumn("upto", F.sum("n").over(along))
    inside = (F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
    spots = settled(upto.alias("a").join(broadcast_table_if_small(wanted).alias("b"), _equal_on("a", "b", ["label"])).where(inside)
                    .select("a.label", "part", "slot", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")), "spots")
    parts = spots.groupBy("label", "part").agg(F.collect_list(F.struct("slot", "rank")).alias("ranks"))
    near = keyed.alias("a").join(broadcast_table_if_small(parts).alias("b"), _equal_on("a", "b", ["label", "part"])).select(
        "a.*", "b.ranks")
    numbered = near.withColumn("i", F.row_number().over(Window.partitionBy("label", "part").orderBy("order")))
    hits = numbered.select("label", "order", F.explode(F.filter("ranks", lambda r: r["rank"] == F.col("i"))).alias("r"))
    return settled(hits.select("label", "r.slot", "order"), "cuts")
