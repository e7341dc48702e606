"""Reproducible splits, folds, batches and bootstrap samples.

Order comes from a seeded hash of a unique key, so every result is a function of the data alone. Where
only a few cut positions matter, the hash values at those positions are found first and the rows are then
labelled by comparing texts: no row is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions.hashing import hashed_int, hashed_uniform, keyed_md5, leading_int, poisson_weight, shuffle_key
from wickline.operators.running import hash_cut_values, hash_ranked, leading_digits, ordered_sums
from wickline.session import settled
from wickline.small import broadcast_table_if_small

SEED = 1992
#: Bootstrap draws that a task makes or counts.
DRAWS_PER_TASK = 1_000_000


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows (label, n) of the classes, NULL among them, as a written table."""
    return settled(df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")), "class-sizes")


def apportion(sizes: DataFrame, size: str, total: int, name: str) -> DataFrame:
    """Share ``total`` among the classes by ``size``: floors first, then the largest remainders, equal ones in class order."""
    whole = sizes.agg(F.sum(size)).first()[0] or 0
    if whole == 0:
        return sizes.withColumn(name, F.lit(0).cast("bigint"))
    product = f"cast(`{size}` as decimal(19,0)) * cast({total} as decimal(19,0))"
    shares = sizes.withColumns({
        name: F.expr(f"cast({product} div cast({whole} as decimal(19,0)) as bigint)"),
        "__rest": F.expr(f"{product} % cast({whole} as decimal(19,0))"), "__one": F.lit(1)})
    left = total - shares.agg(F.sum(name)).first()[0]
    ranked = ordered_sums(shares, [F.col("__rest").desc(), F.col("label").asc_nulls_first()], {"__place": "__one"})
    return ranked.withColumn(name, F.col(name) + (F.col("__place") <= left).cast("bigint")).drop("__rest", "__one", "__place")


def label_by_cuts(df: DataFrame, label: str, shuffle: Column, ranks: DataFrame, values: Sequence[object],
                  name: str) -> DataFrame:
    """Give each row the value of the stretch of its class's hash order it lies in.

    ``ranks`` has a row (label, slot, rank) for the end rank of each stretch but the last, slots ascending from 0.
    """
    slots = len(values) - 1
    found = hash_cut_values(df, label, shuffle, ranks)
    table = found.groupBy(F.col("label").alias("__label")).agg(
        *[F.max(F.when(F.col("slot") == i, F.col("order"))).alias(f"__cut{i}") for i in range(slots)])
    order = F.col("__order")
    chosen = F.lit(values[-1])
    for i in reversed(range(slots)):
        chosen = F.when(order <= F.col(f"__cut{i}"), F.lit(values[i])).otherwise(chosen)
    joined = df.withColumn("__order", shuffle).join(
        broadcast_table_if_small(table), F.col(label).eqNullSafe(F.col("__label")), "left")
    return joined.select(*df.columns, chosen.alias(name))


def stratified_split(df: DataFrame, key: str, label: str, train: float = 0.7, val: float = 0.5,
                     seed: int = SEED, name: str = "split") -> DataFrame:
    """Add ``split``: train, then val and test from the rest, class shares exact to one row."""
    sizes = class_sizes(df, label)
    n = sizes.agg(F.sum("n")).first()[0] or 0
    n_train = int(n * train + 1e-9)
    first = apportion(sizes, "n", n_train, "first").withColumn("rest", F.col("n") - F.col("first"))
    both = apportion(first, "rest", int((n - n_train) * val + 1e-9), "second")
    ranks = settled(both.select("label", F.posexplode(F.array("first", F.col("first") + F.col("second"))).alias("slot", "rank")), "ranks")
    return label_by_cuts(df, label, shuffle_key(seed, F.col(key)), ranks, ["train", "val", "test"], name)


STRATEGIES: dict[str, Callable[..., DataFrame]] = {"train_test_split": stratified_split}


def split_summary(df: DataFrame, split: str = "split") -> DataFrame:
    """Size and share of each split."""
    total = F.lit(float(df.count()))
    sizes = df.groupBy(split).agg(F.count("*").alias("size"))
    return sizes.select(split, "size", F.format_string("%.2f%%", F.col("size") / total * 100).alias("percentage"))


def shuffle_batches(df: DataFrame, key: str, batch_size: int | None, seed: int = SEED,
                    name: str = "batch") -> DataFrame:
    """Batch number 0.. of a seeded shuffle; every batch but the last has ``batch_size`` rows."""
    if batch_size is None:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    ranked = hash_ranked(df, shuffle_key(seed, F.col(key)), name="__rank")
    return ranked.withColumn(name, F.floor((F.col("__rank") - 1) / F.lit(batch_size)).cast("bigint")).drop("__rank")


def bootstrap_sample(df: DataFrame, key: str, rounds: int, seed: int = 42) -> DataFrame:
    """n draws with replacement from n rows per round, as (round, key, draws).

    Draws are dealt out once, by row number, to as many tasks as their number calls for; there they are counted and meet the rows.
    """
    n = df.count()
    numbered = hash_ranked(df.select(key), shuffle_key(seed, F.col(key)), name="row")
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-n * rounds // DRAWS_PER_TASK))
    draws = spark.range(0, n * rounds, 1, tasks).select(
        F.floor(F.col("id") / F.lit(n)).cast("int").alias("round"), (F.col("id") % n).alias("draw"))
    digest = keyed_md5(seed, F.col("round"), F.col("draw"))
    picked = draws.select("round", (leading_int(digest, 15) % n + 1).alias("row")).repartition(tasks, "row")
    counted = picked.groupBy("round", "row").agg(F.count("*").alias("draws"))
    return counted.join(numbered, "row").select("round", key, "draws")


def poisson_bootstrap(df: DataFrame, key: str, round_no: int, seed: int = 42, name: str = "weight") -> DataFrame:
    """Bootstrap weight of each row in one round: independent Poisson(1) counts, a projection only."""
    return df.withColumn(name, poisson_weight(hashed_uniform(seed, F.lit(round_no), F.col(key))).cast("double"))


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = SEED,
                     name: str = "fold") -> DataFrame:
    """Fold 1..k with class sizes equal to one row."""
    ends = [F.expr(f"{i} * (n div {k}) + least({i}L, n % {k})") for i in range(1, k)]
    ranks = class_sizes(df, label).select("label", F.posexplode(F.array(*ends)).alias("slot", "rank"))
    return label_by_cuts(df, label, shuffle_key(seed, F.col(key)), ranks, list(range(1, k + 1)), name)


def group_folds(df: DataFrame, group: str, positive: Column, k: int = 6, seed: int = SEED,
                name: str = "fold") -> DataFrame:
    """Fold of every group: groups in order of positive share (in percent steps), dealt out in turn."""
    groups = settled(df.groupBy(group).agg(F.count("*").alias("rows"), F.count_if(positive).alias("positives")), "groups")
    step = 100 - F.floor(F.col("positives") * 100 / F.col("rows"))
    order = F.concat(F.lpad(step.cast("string"), 3, "0"), shuffle_key(seed, F.col(group)))
    ranked = hash_ranked(groups, order, digits=3 + leading_digits(groups.count()), name="__rank")  # the share step, then the hash
    return ranked.withColumn(name, ((F.col("__rank") - 1) % k + 1).cast("int")).drop("__rank")


def group_kfold(df: DataFrame, group: str, positive: Column, k: int = 6, seed: int = SEED,
                name: str = "fold") -> DataFrame:
    """Rows with the fold of their group; no group is in two folds; the rows without a group are one."""
    folds = group_folds(df, group, positive, k, seed, name).select(F.col(group).alias("__group"), name)
    return df.join(folds, F.col(group).eqNullSafe(F.col("__group"))).drop("__group").select(group, *[c for c in df.columns if c != group], name)


def assign_variant(df: DataFrame, unit: str, variants: Sequence[str] = ("A", "B"), seed: int | str = "ab",
                   name: str = "variant") -> DataFrame:
    """Stable hash assignment of a unit to one of the variants."""
    slot = (hashed_int(seed, F.col(unit)) % len(variants) + 1).cast("int")
    return df.withColumn(name, F.element_at(F.array(*[F.lit(v) for v in variants]), slot))
