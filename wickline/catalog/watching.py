"""Segments, experiments, monitoring and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline.catalog import derived as d
from wickline.catalog.evaluation import _LOSS2
from wickline.operators import monitoring, resampling

COLUMNS = ["value", "quantity"]


def q_segment_metrics(spark, sf):
    return d.rounded(monitoring.segment_metrics(d.scored_events(spark, sf), ["event_type"]))


def q_segment_cube(spark, sf):
    df = d.scored_events(spark, sf).withColumn("week", F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd"))
    return d.rounded(monitoring.segment_cube(df, ["event_type", "week"]))


def q_segment_spread(spark, sf):
    return d.rounded(monitoring.segment_spread(d.scored_events(spark, sf), ["user_id"]))


def q_ab_assign(spark, sf):
    return resampling.assign_variant(d.table(spark, sf, "customer").select("c_custkey"), "c_custkey")


def q_ab_test(spark, sf):
    """Users of each variant who ever bought something big."""
    users = d.table(spark, sf, "events").groupBy("user_id").agg(
        F.max(((F.col("event_type") == "purchase") & (F.col("value") > 200)).cast("int")).alias("converted"))
    return d.rounded(monitoring.ab_test(resampling.assign_variant(users, "user_id"), "variant", "converted"))


def daily(spark, sf):
    return monitoring.monitor_windows(d.scored_events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp")))


def q_monitor_daily(spark, sf):
    out = daily(spark, sf)
    return d.rounded(out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}))


def q_monitor_sliding(spark, sf):
    df = d.scored_events(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    out = monitoring.monitor_windows(df, width="2 days", slide="1 day", by=["event_type"])
    return d.rounded(out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "rows",
                                "accuracy", "brier_score"))


def q_monitor_rolling(spark, sf):
    out = monitoring.monitor_rolling(daily(spark, sf))
    return d.rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


def _ticks(spark, sf):
    return d.table(spark, sf, "events").select(
        "ts", "value", F.get_json_object("props", "$.k").cast("double").alias("quantity"))


def _baseline(df):
    return df.where(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz"))


def _day():
    return F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")


def q_drift_windows(spark, sf):
    df = _ticks(spark, sf)
    return d.rounded(monitoring.drift_windows(df, _baseline(df), COLUMNS, _day(), 0.05))


def q_psi(spark, sf):
    df = _ticks(spark, sf)
    return d.rounded(monitoring.psi(df, _baseline(df), "value", _day()))


def q_retrain_trigger(spark, sf):
    df = _ticks(spark, sf)
    weekly = monitoring.psi(df, _baseline(df), "value", _day())
    performance = daily(spark, sf).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    return d.rounded(monitoring.retrain_trigger(performance, weekly, least=0.55, psi_limit=0.1))


QUERIES = {
    "segment_metrics": q_segment_metrics, "segment_cube": q_segment_cube, "segment_spread": q_segment_spread,
    "ab_assign": q_ab_assign, "ab_test": q_ab_test, "monitor_daily": q_monitor_daily,
    "monitor_sliding": q_monitor_sliding, "monitor_rolling": q_monitor_rolling, "drift_windows": q_drift_windows,
    "psi": q_psi, "retrain_trigger": q_retrain_trigger,
}

_S = f"with {d.SCORED_SQL}"
_M = (f"count(*) as rows, round(avg((y = y_pred)::int),6) as accuracy, round({_LOSS2},6) as log_loss, "
      "round(avg(pow(p - y, 2)),6) as brier_score")
_T = "t as (select ts, value, cast(regexp_extract(props,'([0-9]+)',1) as double) as quantity from events)"
_PSI = f"""{_T}, b as (select value from t where ts < timestamp '2024-01-11'),
q as (select {', '.join(f'quantile_cont(value, {i / 10}) as q{i}' for i in range(1, 10))} from b),
bb as (select {' + '.join(f'(value >= q{i})::int' for i in range(1, 10))} as bin from b, q),
e as (select s.i as bin, greatest((select count(*) from bb where bin = s.i) / (select count(*) from bb), 1e-4) as e from range(10) s(i)),
a as (select date_trunc('day', ts) as w, {' + '.join(f'(value >= q{i})::int' for i in range(1, 10))} as bin from t, q),
n as (select w, count(*) as rows from a group by 1),
c as (select n.w, n.rows, e.bin, e.e, greatest(count(a.bin) / n.rows, 1e-4) as a from n cross join e
  left join a on a.w = n.w and a.bin = e.bin group by 1, 2, 3, 4),
psi as (select w as window_start, rows, round(sum((a - e) * ln(a / e)),6) + 0 as psi from c group by 1, 2)"""
ORACLES = {
    "segment_metrics": f"""{_S}, o as (select avg((y = y_pred)::int) as oa from scored)
select event_type, {_M}, round(any_value(oa),6) as overall_accuracy, round(avg((y = y_pred)::int) - any_value(oa),6) + 0 as gap
from scored, o group by 1""",
    "segment_cube": f"""{_S}, w as (select *, strftime(date_trunc('week', ts), '%Y-%m-%d') as week from scored)
select event_type, week, {_M}, grouping(event_type, week)::int as level from w group by cube (event_type, week)""",
    "segment_spread": f"""{_S}, g as (select user_id, avg((y = y_pred)::int) as a, {_LOSS2} as l, avg(pow(p - y, 2)) as b from scored group by 1)
select round(max(a) - min(a),6) as accuracy_spread, round(max(l) - min(l),6) as log_loss_spread,
  round(max(b) - min(b),6) as brier_score_spread, count(*) as segments from g""",
    "ab_assign": f"""select c_custkey, case when {d.md5_int("'ab:' || c_custkey::varchar")} % 2 = 0 then 'A' else 'B' end as variant
from customer""",
    "ab_test": f"""with u as (select user_id, max((event_type = 'purchase' and value > 200)::int) as c,
  {d.md5_int("'ab:' || user_id::varchar")} % 2 as v from events group by 1, 3),
r as (select count(*) filter (v = 0) as n_a, coalesce(sum(c) filter (v = 0), 0)::bigint as x_a,
  count(*) filter (v = 1) as n_b, coalesce(sum(c) filter (v = 1), 0)::bigint as x_b from u),
t as (select *, case when x_a + x_b > 0 and x_a + x_b < n_a + n_b then (x_b / n_b - x_a / n_a)
  / sqrt((x_a + x_b) / (n_a + n_b) * (1 - (x_a + x_b) / (n_a + n_b)) * (1e0 / n_a + 1e0 / n_b)) end as raw from r)
select n_a, x_a, n_b, x_b, round(x_a / n_a,6) as rate_a, round(x_b / n_b,6) as rate_b, round(x_b / n_b - x_a / n_a,6) + 0 as lift,
  round(raw,6) + 0 as z,
  -- the density's integral to |z| by Simpson's rule
  round(1 - 2 * abs(raw) / 3000 * list_sum(list_transform(range(1001), lambda i: (case when i in (0, 1000) then 1 when i % 2 = 1 then 4 else 2 end)
    * exp(-pow(abs(raw) * i / 1000, 2) / 2) / sqrt(2 * pi()))), 6) + 0 as p from t""",
    "monitor_daily": f"""{_S} select date_trunc('day', ts) as window_start, date_trunc('day', ts) + interval 1 day as window_end, {_M}
from scored group by 1, 2""",
    "monitor_sliding": f"""{_S}, w as (select *, date_trunc('day', ts) as window_start from scored
union all select *, date_trunc('day', ts) - interval 1 day from scored)
select window_start, event_type, count(*) as rows, round(avg((y = y_pred)::int),6) as accuracy,
  round(avg(pow(p - y, 2)),6) as brier_score from w group by 1, 2""",
    "monitor_rolling": f"""{_S}, w as (select date_trunc('day', ts) as window_start, avg((y = y_pred)::int) as a from scored group by 1)
select window_start, round(a,6) as accuracy, round(avg(a) over (order by window_start rows 6 preceding),6) as rolling_mean,
  round(a - lag(a) over (order by window_start),6) + 0 as change from w""",
    "drift_windows": f"with {_T}, r as (" + " union all ".join(
        f"""select date_trunc('day', ts) as window_start, '{c}' as "column", avg({c}) as mean,
  (select avg({c}) from t where ts < timestamp '2024-01-11') as baseline, stddev_samp({c}) as s from t group by 1""" for c in COLUMNS)
    + """) select window_start, "column", round(mean,6) as mean, round(baseline,6) as baseline,
  round(case when s = 0 then null else abs(mean - baseline) / s end,6) as z, coalesce(case when s = 0 then null else abs(mean - baseline) / s end > 0.05e0, false) as drifted from r""",
    "psi": f"with {_PSI} select * from psi",
    "retrain_trigger": f"""{_S}, {_PSI}, p as (select date_trunc('day', ts) as window_start, avg((y = y_pred)::int) as a from scored group by 1)
select window_start, round(a,6) as accuracy, psi, a < 0.55e0 as weak, psi > 0.1e0 as drifted, (a < 0.55e0 or psi > 0.1e0) as retrain
from p join psi using (window_start)""",
}
