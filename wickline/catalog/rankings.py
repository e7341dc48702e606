"""Top rows, trial and grid rankings, cross-validation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline.catalog import derived as d
from wickline.operators import models, ranking
from wickline.operators.metrics import accuracy


def q_latest_n(spark, sf):
    df = d.table(spark, sf, "events").withColumnRenamed("ts", "utc_datetime")
    return ranking.latest_n(df, 3000, keys=["event_id"]).select("event_id", "utc_datetime", "event_type", "value")


def trials(spark, sf):
    """Five cut-offs tried on the events of every user."""
    rows = d.scored_events(spark, sf).select("user_id", "y", "p", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("trial"))
    cut = (F.col("trial") + 1) * F.lit(0.15)
    hit = ((F.col("p") >= cut).cast("int") == F.col("y")).cast("double")
    return rows.groupBy("user_id", "trial").agg(
        F.round(F.avg(F.pow(F.col("p") - F.col("y") * cut, F.lit(2.0))), 6).alias("loss"), F.avg(hit).alias("accuracy"))


def q_rank_trials(spark, sf):
    return d.rounded(ranking.rank_trials(trials(spark, sf), by=["user_id"]))


def fold_scores(spark, sf):
    """Accuracy of three cut-off models on five folds of the events."""
    rows = d.scored_events(spark, sf).select(
        "y", "p", (F.col("event_id") % 5 + 1).cast("int").alias("fold"),
        F.explode(F.array(F.struct(F.lit("low").alias("model"), F.lit(0.2).alias("cut")),
                          F.struct(F.lit("mid").alias("model"), F.lit(0.4).alias("cut")),
                          F.struct(F.lit("top").alias("model"), F.lit(0.7).alias("cut")))).alias("m")).select("*", "m.*")
    return rows.select("model", "fold", "y", (F.col("p") >= F.col("cut")).cast("int").alias("y_pred"))


def scores(spark, sf):
    hit = F.avg((F.col("y") == F.col("y_pred")).cast("double")).alias("score")
    return fold_scores(spark, sf).groupBy("model", "fold").agg(hit)


def grid(spark, sf):
    """Mean and deviation of the daily accuracy of four cut-offs per symbol."""
    rows = d.scored_events(spark, sf).select(
        F.col("event_type").alias("model"), F.to_date("ts").alias("day"), "y", "p",
        F.explode(F.array(*[F.lit(c) for c in (0.1, 0.3, 0.5, 0.7)])).alias("cut"))
    daily = rows.groupBy("model", "cut", "day").agg(
        F.avg(((F.col("p") >= F.col("cut")).cast("int") == F.col("y")).cast("double")).alias("s"))
    return daily.groupBy("model", F.concat(F.lit("clf__cut_"), F.col("cut").cast("string")).alias("param")).agg(
        F.round(F.avg("s"), 6).alias("mean_test_score"), F.round(F.stddev_pop("s"), 6).alias("std_test_score"))


def q_rank_grid(spark, sf):
    return ranking.rank_grid(grid(spark, sf)).withColumn("rank_test_score", F.col("rank_test_score").cast("bigint"))


def q_best_per_model(spark, sf):
    return ranking.best_per_model(grid(spark, sf))


def q_cv_table(spark, sf):
    return d.rounded(ranking.cv_table(scores(spark, sf), [1, 2, 3, 4, 5]))


def q_cv_summary(spark, sf):
    hit = F.avg((F.col("y") == F.col("y_pred")).cast("double"))
    summary = d.rounded(ranking.cv_summary(fold_scores(spark, sf), hit))
    return summary.withColumn("fold", F.coalesce(F.col("fold").cast("string"), F.lit("all")))


def q_concat_by_model(spark, sf):
    rows = d.scored_events(spark, sf)
    return d.rounded(ranking.concat_by_model({
        m: accuracy(rows.withColumn("y_pred", (F.col("p") >= F.lit(c)).cast("int")))
        for m, c in (("low", 0.2), ("top", 0.7))}))


def q_union_pages(spark, sf):
    df = d.klines_raw(spark, sf).select("symbol", "open_time", "close")
    halves = [df.where(F.col("open_time") < d.SECOND_LOAD_MS), df.where(F.col("open_time") >= d.SECOND_LOAD_MS), df]
    return ranking.union_pages(halves).groupBy("symbol", "open_time", "close").agg(F.count("*").alias("copies"))


def q_paired_t(spark, sf):
    """Low against top cut-off on the same daily blocks, per symbol."""
    rows = d.scored_events(spark, sf).withColumn("day", F.to_date("ts"))
    def score(cut):
        return F.avg(((F.col("p") >= F.lit(cut)).cast("int") == F.col("y")).cast("double"))

    pairs = rows.groupBy("event_type", "day").agg(score(0.2).alias("a"), score(0.7).alias("b"))
    return d.rounded(models.paired_t(pairs, "a", "b", ["event_type"]))


QUERIES = {
    "latest_n": q_latest_n, "rank_trials": q_rank_trials, "rank_grid": q_rank_grid, "best_per_model": q_best_per_model,
    "cv_table": q_cv_table, "cv_summary": q_cv_summary, "concat_by_model": q_concat_by_model,
    "union_pages": q_union_pages, "paired_t": q_paired_t,
}

_S = f"with {d.SCORED_SQL}"
_FOLDS = f"""{_S}, f as (select m.model, (event_id % 5 + 1)::int as fold, y, (p >= m.cut)::int as y_pred
  from scored, (values ('low', 0.2e0), ('mid', 0.4e0), ('top', 0.7e0)) m(model, cut)),
sc as (select model, fold, avg((y = y_pred)::int) as score from f group by 1, 2)"""
_GRID = f"""{_S}, g as (select event_type as model, 'cut_' || c.cut::varchar as param, ts::date as day,
  avg(((p >= c.cut)::int = y)::int) as s from scored, (values (0.1e0), (0.3e0), (0.5e0), (0.7e0)) c(cut) group by 1, 2, 3),
grid as (select model, param, round(avg(s),6) as mean_test_score, round(stddev_pop(s),6) as std_test_score from g group by 1, 2)"""
ORACLES = {
    "latest_n": """select event_id, ts as utc_datetime, event_type, value from events
order by ts desc, event_id limit 3000""",
    "rank_trials": f"""{_S}, t as (select user_id, (t.i)::int as trial,
  round(avg(pow(p - y * ((t.i + 1) * 0.15e0), 2)), 6) as loss, avg(((p >= (t.i + 1) * 0.15e0)::int = y)::int) as accuracy
  from scored, range(5) t(i) group by 1, 2)
select user_id, trial, loss, round(accuracy,6) as accuracy,
  row_number() over (partition by user_id order by loss, trial)::int as loss_rank,
  row_number() over (partition by user_id order by accuracy desc, trial) = 1 as is_best from t""",
    "rank_grid": f"""{_GRID} select *, rank() over (partition by model order by mean_test_score desc) as rank_test_score
from grid""",
    "best_per_model": f"""{_GRID} select model, 'clf__' || param as param, mean_test_score, std_test_score from (select *, row_number() over
  (partition by model order by mean_test_score desc, param) as i from grid) where i = 1""",
    "cv_table": f"""{_FOLDS} select model, """ + ", ".join(
        f"round(max(score) filter (fold = {k}),6) as fold_{k}" for k in range(1, 6)) + """,
  round(avg(score),6) as mean_cv, round(stddev_samp(score),6) as std_cv from sc group by 1""",
    "cv_summary": f"""{_FOLDS} select model, fold::varchar as fold, round(score,6) as score from sc
union all select model, 'all', round(avg((y = y_pred)::int),6) from f group by 1""",
    "concat_by_model": f"""{_S}, f as (select m.model, y, (p >= m.cut)::int as y_pred
  from scored, (values ('low', 0.2e0), ('top', 0.7e0)) m(model, cut)),
c as (select model, y, avg((y = y_pred)::int) as r, count(*) as n, sum((y = y_pred)::int) as h from f group by 1, 2)
select model, round(sum(h) / sum(n), 6) as accuracy, round(avg(r), 6) as balanced_accuracy from c group by 1""",
    "union_pages": f"with {d.KLINES_SQL} select symbol, open_time, close, 2::bigint as copies from klines",
    "paired_t": f"""{_S}, b as (select event_type, ts::date as day, avg(((p >= 0.2e0)::int = y)::int)
  - avg(((p >= 0.7e0)::int = y)::int) as x from scored group by 1, 2),
t as (select event_type, avg(x) as m, case when stddev_samp(x) = 0 then null else avg(x) * sqrt(count(*)) / stddev_samp(x) end as t,
  count(*) - 1 as df from b group by 1)
select event_type, round(m,6) + 0 as mean_diff, round(t,6) + 0 as t_stat, df,
  round(1 - 2 * abs(t) / 3000 * list_sum(list_transform(range(1001), lambda i: (case when i in (0, 1000) then 1 when i % 2 = 1 then 4 else 2 end)
    * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) * pow(1 + pow(t * i / 1000, 2) / df, -(df + 1) / 2))), 6) + 0 as p from t""",
}
