"""Baselines, fits, searches and cross-validation on the candle table."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.catalog.preparation import parted_klines
from wickline.operators import features, grids, linear_block, metrics, models, ranking, resampling
from wickline.plans.training import TrainingSettings, run_training
from wickline.session import fresh_path, settled

def hit_rate():
    return F.avg((F.col("y") == F.col("y_pred")).cast("double"))


def prepared(spark, sf):
    """Split candles with their assembled features, written once: every fit reads them again."""
    df = parted_klines(spark, sf)
    chain = features.preprocess_chain(df.where("split = 'train'"), schemas.FEATURES)
    return settled(chain.transform(df).select("key", "split", "features", schemas.TARGET), "prepared")


def parts(spark, sf):
    df = prepared(spark, sf)
    return [df.where(F.col("split") == s) for s in ("train", "val", "test")]


def folded(spark, sf, k=5):
    return settled(resampling.stratified_kfold(settled(d.keyed_klines(spark, sf), "klines"), "key", schemas.TARGET, k), "folded")


def q_sample_trials(spark, sf):
    studies = d.table(spark, sf, "customer").select(F.col("c_custkey").alias("study"))
    return d.rounded(models.sample_trials(studies, "study"), 9)


def q_train_linear(spark, sf):
    train, val, _ = parts(spark, sf)
    return d.rounded(models.train_linear(train, val)[1])


def q_prior_baseline(spark, sf):
    df = d.table(spark, sf, "lineitem")
    before = F.lit("1998-01-01").cast("timestamp_ntz")
    out = models.prior_baseline(df.where(F.col("l_shipdate") < before), df.where(F.col("l_shipdate") >= before),
                                "l_returnflag", ["l_orderkey", "l_linenumber"])
    return d.rounded(metrics.log_loss(out, class_p={k: f"p_{k}" for k in "ANR"}).join(metrics.accuracy(out)))


def q_stratified_baseline(spark, sf):
    df = d.table(spark, sf, "events").select("event_id", "event_type")
    return models.stratified_baseline(df, df, "event_type", "event_id")


def q_spot_check(spark, sf):
    rows = settled(d.numbered_klines(spark, sf), "klines")
    df = settled(resampling.stratified_kfold(rows, "id", schemas.TARGET), "folded")
    return d.rounded(metrics.accuracy(models.spot_check(df, [1, 2, 3, 4, 5], key="id"), ["model"]))


def q_oof_predictions(spark, sf):
    df = folded(spark, sf)
    zoo = {"logistic": models.model_zoo()["logistic"]}
    out = models.oof_predictions(df, [1, 2, 3, 4, 5], zoo, keys=["key"])
    return out.groupBy("model", "fold").agg(F.count("*").alias("rows"), F.countDistinct("key").alias("keys"))


def q_cross_validation(spark, sf):
    df = folded(spark, sf)
    zoo = {k: v for k, v in models.model_zoo().items() if k in ("logistic", "tree")}
    scores = settled(models.cross_validation(df, [1, 2, 3, 4, 5], zoo, hit_rate(), keys=["key"]), "scores")
    return d.rounded(ranking.cv_table(scores, [1, 2, 3, 4, 5]).join(
        models.cv_difference(scores, "logistic", "tree").select("t_stat", "df")))


def q_tune(spark, sf):
    train, val, _ = parts(spark, sf)
    table, best = models.tune(train, val)
    return d.rounded(table.withColumns({"alpha": F.col("params")["alpha"] * 1e6,
                                        "is_best": F.col("params")["alpha"] == F.lit(best["alpha"])}).drop("params"))


def q_trials_table(spark, sf):
    """The stored form of the trials: number, parameter map, metrics."""
    train, val, _ = parts(spark, sf)
    path = fresh_path(spark, "trials")
    models.tune(train, val)[0].write.parquet(path)
    stored = spark.read.parquet(path)
    return d.rounded(stored.select("trial", "loss_rank", F.explode("params").alias("param", "setting"), "val_loss", "val_accuracy"), 9)


def q_retrain(spark, sf):
    train, val, test = parts(spark, sf)
    _, best = models.tune(train, val)
    model = models.retrain(train, best)
    return d.rounded(metrics.overall_metrics(models.scored(model, train), prefix="train").join(
        metrics.overall_metrics(models.scored(model, test), prefix="holdout")))


def q_grid_search(spark, sf):
    return d.rounded(ranking.rank_grid(grids.search_grid(folded(spark, sf), [1, 2, 3, 4, 5])[0]))


def q_training_run(spark, sf):
    """Query, clean, split, tune, fit, evaluate, register and decide promotion; the run's metric rows."""
    root = fresh_path(spark, "training")
    run_training(d.klines_stamped(spark, sf), root, TrainingSettings(), d.RUN_TS)
    return d.rounded(spark.read.parquet(f"{root}/metrics").select("name", "step", "value"))


def q_train_warm(spark, sf):
    """Metrics of the training and validation rows after each of five epochs that go on from the last, for three trials."""
    train, val, _ = parts(spark, sf)
    trials = models.sample_trials(spark.createDataFrame([("linear",)], "study string"), "study").orderBy("trial").collect()
    state = linear_block.warm_epochs(train, [t.alpha for t in trials], [t.power_t for t in trials], models.EPOCHS, "key", label=schemas.TARGET)
    rows = state.orderBy("epoch", "trial").collect()  # epochs x trials
    block, names = np.array([r.coefficients for r in rows]), F.array(*[F.struct(F.lit(r.epoch).alias("step"), F.lit(r.trial).alias("trial")) for r in rows])
    scored = [linear_block.predict_linear_block(df.withColumn("y", F.col(schemas.TARGET).cast("int")), block, ["y"]).select(
        F.lit(part).alias("part"), "y", F.posexplode("p").alias("at", "p")).select("part", F.get(names, "at").alias("of"), "y", "p")
        for part, df in (("train", train), ("val", val))]
    long = scored[0].unionByName(scored[1]).select("part", "of.*", "y", "p", (F.col("p") >= 0.5).cast("int").alias("y_pred"))
    return d.rounded(metrics.overall_metrics(long, ["trial", "step", "part"]))


def q_bootstrap_rates(spark, sf):
    """Two hundred bootstrap rounds of a logistic model on one indicator for each symbol, fitted in one block. Each round's
    probability of a symbol is its weighted share of rises, which is what the twin computes."""
    rows = settled(d.keyed_klines(spark, sf), "klines")
    names = [r.symbol for r in rows.select("symbol").distinct().orderBy("symbol").collect()]  # the indicator columns
    features = F.array(*[(F.col("symbol") == n).cast("double") for n in names])
    df = rows.withColumn("features", features)
    block = linear_block.fit_linear_block(df, [0.0] * 200, label=schemas.TARGET, weights=linear_block.bootstrap_weights(200, F.col("key")))
    one = linear_block.predict_linear_block(df.groupBy("symbol").agg(F.first("features").alias("features")), block, ["symbol"])
    return one.select("symbol", F.posexplode("p").alias("round", "p")).select("symbol", "round", F.round("p", 5).alias("p"))


QUERIES = {
    "train_warm": q_train_warm, "bootstrap_rates": q_bootstrap_rates,
    "sample_trials": q_sample_trials, "train_linear": q_train_linear, "prior_baseline": q_prior_baseline,
    "stratified_baseline": q_stratified_baseline, "spot_check": q_spot_check, "oof_predictions": q_oof_predictions,
    "cross_validation": q_cross_validation, "tune": q_tune, "trials_table": q_trials_table, "retrain": q_retrain, "grid_search": q_grid_search,
    "training_run": q_training_run,
}


def _draw(name: str) -> str:
    return f"('0x' || substr(md5('1992:{name}:' || c_custkey::varchar || ':' || t.i::varchar),1,8))::bigint / 4294967296e0"


_LOW, _SPAN = math.log(1e-4), math.log(2e-4) - math.log(1e-4)
_RUNGS = [sum(math.exp(-1.0) / math.factorial(i) for i in range(k + 1)) for k in range(12)]
ORACLES = {
    "bootstrap_rates": f"""with {d.KLINES_SQL}, u as (select symbol, price_increase as y, t.r::int as round,
  {d.md5_int("'42:' || t.r::varchar || ':' || key")} / 4294967296e0 as u from cleaned, range(200) t(r)),
w as (select *, {' + '.join(f'(u >= {r!r})::int' for r in _RUNGS)} as w from u)
select symbol, round, round(sum(w * y) / sum(w), 5) as p from w group by 1, 2""",
    "sample_trials": f"""select c_custkey as study, t.i::int as trial, round(exp({_LOW!r} + {_draw('alpha')} * {_SPAN!r}), 9) as alpha,
  round(0.1e0 + {_draw('power_t')} * 0.4e0, 9) as power_t from customer, range(3) t(i)""",
    "prior_baseline": """with tr as (select l_returnflag as c, count(*) as n from lineitem where l_shipdate < timestamp '1998-01-01' group by 1),
s as (select c, n / (select sum(n) from tr) as share, row_number() over (order by n desc, c) as i from tr),
te as (select l_returnflag as y from lineitem where l_shipdate >= timestamp '1998-01-01'),
top as (select c from s where i = 1),
r as (select y, avg((y = c)::int) as rec, count(*) as n from te, top group by 1)
select (select round(avg(-ln(share)), 6) from te join s on y = c) as log_loss,
  round(sum(rec * n) / sum(n), 6) as accuracy, round(avg(rec), 6) as balanced_accuracy from r""",
    "stratified_baseline": f"""with n as (select event_type as c, count(*) as n from events group by 1),
s as (select c, sum(n) over (order by c) / (select sum(n) from n)::double as upto from n),
u as (select event_id, event_type as y, {d.md5_int("'1992:' || event_id::varchar")} / 4294967296e0 as u from events)
select event_id, y, (select min(c) from s where u.u < s.upto) as y_pred from u""",
    "oof_predictions": f"""with {d.KLINES_SQL}, f as (select ntile(5) over (partition by price_increase
  order by md5('1992:' || key) || ':' || key)::int as fold from cleaned)
select 'logistic' as model, fold, count(*) as rows, count(*) as keys from f group by 2""",
}
