"""Exact metrics, curves, thresholds and bias-variance."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.catalog.training import parts
from wickline.functions.hashing import hashed_uniform
from wickline.operators import biasvariance, curves, metrics, models
from wickline.session import settled

THRESHOLDS = [0.01, 0.1, 0.2, 0.35, 0.5]


def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(d.scored_lines(spark, sf), ["A", "N", "R"])


def q_confusion_binary(spark, sf):
    return metrics.confusion_matrix(d.scored_events(spark, sf))


def q_per_class_report(spark, sf):
    return d.rounded(metrics.per_class_report(d.scored_lines(spark, sf), ["l_linestatus"]))


def q_weighted_prf(spark, sf):
    return d.rounded(metrics.weighted_prf(d.scored_lines(spark, sf)))


def q_classification_report(spark, sf):
    return d.rounded(metrics.classification_report(d.scored_lines(spark, sf)))


def q_accuracy(spark, sf):
    return d.rounded(metrics.accuracy(d.scored_lines(spark, sf), ["l_linestatus"]))


def q_log_loss(spark, sf):
    two = metrics.log_loss(d.scored_events(spark, sf)).select(F.lit("events").alias("frame"), "log_loss")
    three = metrics.log_loss(d.scored_lines(spark, sf), class_p=d.FLAGS).select(F.lit("lines").alias("frame"), "log_loss")
    return d.rounded(two.unionByName(three))


def q_brier_score(spark, sf):
    two = metrics.brier_score(d.scored_events(spark, sf)).select(F.lit("events").alias("frame"), "brier_score")
    three = metrics.brier_score(d.scored_lines(spark, sf), class_p=d.FLAGS).select(
        F.lit("lines").alias("frame"), "brier_score")
    return d.rounded(two.unionByName(three))


def q_roc_auc(spark, sf):
    return d.rounded(metrics.roc_auc(d.scored_events(spark, sf)))


def q_roc_auc_ovr(spark, sf):
    return d.rounded(metrics.roc_auc(d.scored_lines(spark, sf), class_p=d.FLAGS))


def q_average_precision(spark, sf):
    return d.rounded(metrics.average_precision(d.scored_events(spark, sf)))


def q_average_precision_ovr(spark, sf):
    return d.rounded(metrics.average_precision(d.scored_lines(spark, sf), class_p=d.FLAGS))


def q_overall_metrics(spark, sf):
    return d.rounded(metrics.overall_metrics(d.scored_events(spark, sf), prefix="holdout"))


def q_overall_by_day(spark, sf):
    df = d.scored_events(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return d.rounded(metrics.overall_metrics(df, ["day"]))


def q_overall_multiclass(spark, sf):
    return d.rounded(metrics.overall_metrics(d.scored_lines(spark, sf), class_p=d.FLAGS))


def q_evaluate_scored(spark, sf):
    return d.rounded(metrics.evaluate_scored(d.scored_events(spark, sf)))


def q_pr_curve(spark, sf):
    return d.rounded(curves.pr_curve(d.scored_events(spark, sf)))


def q_roc_curve(spark, sf):
    return d.rounded(curves.roc_curve(d.scored_events(spark, sf)))


def q_roc_curve_corners(spark, sf):
    return d.rounded(curves.roc_curve(d.scored_events(spark, sf), drop_collinear=True))


def q_threshold_table(spark, sf):
    return curves.threshold_table(d.scored_events(spark, sf), THRESHOLDS)


def q_benefit_structure(spark, sf):
    return curves.benefit_structure(d.scored_events(spark, sf), THRESHOLDS)


def q_best_threshold(spark, sf):
    return d.rounded(curves.best_threshold(d.scored_events(spark, sf)))


def q_holdout(spark, sf):
    train, _, test = parts(spark, sf)
    model = models.linear_estimator(iterations=50).fit(train)
    return d.rounded(metrics.as_metric_rows(metrics.overall_metrics(models.scored(model, test), prefix="holdout")))


ROUNDS = 200


def rounds_of_votes(spark, sf):
    """Noisy cut-off votes of two hundred rounds on every event."""
    rows = d.scored_events(spark, sf).select("event_id", "p", F.explode(F.sequence(F.lit(0), F.lit(ROUNDS - 1))).alias("round"))
    noise = hashed_uniform("vote", F.col("round"), F.col("event_id")) * F.lit(0.4)
    return rows.select("round", F.col("event_id").alias("test_id"), (F.col("p") + noise).alias("s"))


def _truth(spark, sf):
    return d.scored_events(spark, sf).select(F.col("event_id").alias("test_id"), "y")


def q_bias_variance_01(spark, sf):
    votes = rounds_of_votes(spark, sf).select("round", "test_id", (F.col("s") >= 0.6).cast("int").alias("pred"))
    return d.rounded(biasvariance.bias_variance_summary(votes, _truth(spark, sf)))


def q_bias_variance_mse(spark, sf):
    votes = rounds_of_votes(spark, sf).select("round", "test_id", F.col("s").alias("pred"))
    return d.rounded(biasvariance.bias_variance_summary(votes, _truth(spark, sf), "mse"))


def q_bias_variance_fit(spark, sf):
    train, _, test = parts(spark, sf)
    votes = settled(models.bias_variance_fit(train, test, "key", ROUNDS), "votes")
    truth = test.select(F.col("key").alias("test_id"), F.col(schemas.TARGET).alias("y"))
    return d.rounded(biasvariance.bias_variance_summary(votes, truth))


def q_bias_variance_fit_mse(spark, sf):
    """As ``bias_variance_fit``, with rounds fitted to squared errors."""
    train, _, test = parts(spark, sf)
    votes = settled(models.bias_variance_fit(train, test, "key", ROUNDS, loss="mse"), "votes")
    truth = test.select(F.col("key").alias("test_id"), F.col(schemas.TARGET).alias("y"))
    return d.rounded(biasvariance.bias_variance_summary(votes, truth, "mse"))


QUERIES = {
    "confusion_matrix": q_confusion_matrix, "confusion_binary": q_confusion_binary,
    "per_class_report": q_per_class_report, "weighted_prf": q_weighted_prf,
    "classification_report": q_classification_report, "accuracy": q_accuracy, "log_loss": q_log_loss,
    "brier_score": q_brier_score, "roc_auc": q_roc_auc, "roc_auc_ovr": q_roc_auc_ovr,
    "average_precision": q_average_precision, "average_precision_ovr": q_average_precision_ovr,
    "overall_metrics": q_overall_metrics, "overall_by_day": q_overall_by_day,
    "overall_multiclass": q_overall_multiclass, "evaluate_scored": q_evaluate_scored, "pr_curve": q_pr_curve,
    "roc_curve": q_roc_curve, "roc_curve_corners": q_roc_curve_corners, "threshold_table": q_threshold_table,
    "benefit_structure": q_benefit_structure, "best_threshold": q_best_threshold, "holdout": q_holdout,
    "bias_variance_01": q_bias_variance_01, "bias_variance_mse": q_bias_variance_mse,
    "bias_variance_fit": q_bias_variance_fit, "bias_variance_fit_mse": q_bias_variance_fit_mse,
}

_S, _L = f"with {d.SCORED_SQL}", f"with {d.LINES_SQL}"
_EPS = "2.220446049250313e-16"


def _clip(p: str) -> str:
    return f"least(greatest({p}, {_EPS}), 1e0 - {_EPS})"


def report_sql(source: str, by: str) -> str:
    """Per-class sums of a frame with one grouping column."""
    return f"""
cls as (select distinct {by} as g, y as class from {source} union select distinct {by}, y_pred from {source}),
rep as (select c.g, c.class, count(*) filter (l.y = c.class) as support, count(*) filter (l.y_pred = c.class) as predicted,
   count(*) filter (l.y = c.class and l.y_pred = c.class) as tp from cls c join {source} l on l.{by} = c.g group by 1, 2),
prf as (select g, class, case when predicted = 0 then 0 else tp / predicted end as precision,
   case when support = 0 then 0 else tp / support end as recall,
   case when support + predicted = 0 then 0 else 2 * tp / (support + predicted) end as f1, support, tp from rep),
lab as (select g, sum(support * precision) / sum(support) as precision, sum(support * recall) / sum(support) as recall,
   sum(support * f1) / sum(support) as f1, sum(tp) / sum(support) as accuracy, avg(recall) filter (support > 0) as balanced_accuracy,
   avg(precision) as mp, avg(recall) as mr, avg(f1) as mf, sum(support)::bigint as support from prf group by 1)"""


def ranks_sql(source: str, by: str) -> str:
    """Areas from counts per distinct score of a frame (g, y, p)."""
    return f"""
sc as (select {by} as g, p, sum(y)::bigint as pos, sum(1 - y)::bigint as neg from {source} group by 1, 2),
cu as (select *, sum(pos) over (partition by g order by p desc) as tp, sum(neg) over (partition by g order by p desc) as fp from sc),
rk as (select g, case when sum(pos) > 0 and sum(neg) > 0 then sum(neg::double * (tp - pos / 2e0)) / (sum(pos)::double * sum(neg)) end as roc_auc,
   case when sum(pos) > 0 then sum(pos::double * tp / (tp + fp)) / sum(pos) end as ap from cu group by 1)"""


_OVR = """ovr as (select 'A' as class, (y = 'A')::int as y, p_a as p from lines union all
  select 'N', (y = 'N')::int, p_n from lines union all select 'R', (y = 'R')::int, p_r from lines)"""
_LOSS3 = f"avg(-ln({_clip('case y when ' + chr(39) + 'A' + chr(39) + ' then p_a when ' + chr(39) + 'N' + chr(39) + ' then p_n else p_r end')}))"
_BRIER3 = "(avg(pow(p_a - (y='A')::int,2)) + avg(pow(p_n - (y='N')::int,2)) + avg(pow(p_r - (y='R')::int,2))) / 3e0"
_LOSS2 = f"avg(-ln({_clip('case when y = 1 then p else 1e0 - p end')}))"
_CURVE = f"""{_S}, sc as (select p, sum(y)::bigint as pos, sum(1 - y)::bigint as neg from scored group by 1),
cu as (select *, (sum(pos) over (order by p desc))::bigint as tp, (sum(neg) over (order by p desc))::bigint as fp from sc),
n as (select sum(y)::double as pp, sum(1 - y)::double as nn from scored)"""
_TH = f"""{_S}, th as (select t.v as threshold, count(*) filter (y = 1 and p >= t.v) as tp, count(*) filter (y = 0 and p >= t.v) as fp,
  count(*) filter (y = 1 and p < t.v) as fn, count(*) filter (y = 0 and p < t.v) as tn
  from scored, (values {', '.join(f'({t}e0)' for t in THRESHOLDS)}) t(v) group by 1)"""
_VOTES = f"""{_S}, votes as (select r.i as round, event_id, y, p + ('0x' || substr(md5('vote:' || r.i::varchar || ':' || event_id::varchar),1,8))::bigint
  / 4294967296e0 * 0.4e0 as s from scored, range({ROUNDS}) r(i))"""


def _overall(pre: str, by: str | None, loss: str, brier: str) -> str:
    head = f"l.g as {by}, " if by else ""
    return (f"select {head}round({loss}, 6) as {pre}loss, round(l.precision, 6) as {pre}precision, round(l.recall, 6) as {pre}recall, "
            f"round(l.f1, 6) as {pre}f1, round(l.accuracy, 6) as {pre}accuracy, round(l.balanced_accuracy, 6) as {pre}balanced_accuracy, "
            f"round(k.roc_auc, 6) as {pre}roc_auc, round(k.ap, 6) as {pre}precision_recall_auc, round({brier}, 6) as {pre}brier_score")


ORACLES = {
    "confusion_matrix": f"""{_L} select a.c as y, b.c as y_pred, count(l.y) as n from (values ('A'),('N'),('R')) a(c)
cross join (values ('A'),('N'),('R')) b(c) left join lines l on l.y = a.c and l.y_pred = b.c group by 1, 2""",
    "confusion_binary": f"""{_S} select a.c as y, b.c as y_pred, count(l.y) as n from (values (0),(1)) a(c)
cross join (values (0),(1)) b(c) left join scored l on l.y = a.c and l.y_pred = b.c group by 1, 2""",
    "per_class_report": f"""{_L}, {report_sql('lines', 'l_linestatus')} select g as l_linestatus, class, round(precision,6) as precision,
  round(recall,6) as recall, round(f1,6) as f1, support from prf""",
    "weighted_prf": f"""{_L}, one as (select 1 as k, * from lines), {report_sql('one', 'k')} select round(precision,6) as precision,
  round(recall,6) as recall, round(f1,6) as f1 from lab""",
    "classification_report": f"""{_L}, one as (select 1 as k, * from lines), {report_sql('one', 'k')}
select class as label, round(precision,6) as precision, round(recall,6) as recall, round(f1,6) as f1, support from prf
union all select 'accuracy', round(accuracy,6), round(accuracy,6), round(accuracy,6), support from lab
union all select 'macro avg', round(mp,6), round(mr,6), round(mf,6), support from lab
union all select 'weighted avg', round(precision,6), round(recall,6), round(f1,6), support from lab""",
    "accuracy": f"""{_L}, {report_sql('lines', 'l_linestatus')} select g as l_linestatus, round(accuracy,6) as accuracy,
  round(balanced_accuracy,6) as balanced_accuracy from lab""",
    "log_loss": f"""{_S}, {d.LINES_SQL} select 'events' as frame, round({_LOSS2},6) as log_loss from scored
union all select 'lines', round({_LOSS3},6) from lines""",
    "brier_score": f"""{_S}, {d.LINES_SQL} select 'events' as frame, round(avg(pow(p - y, 2)),6) as brier_score from scored
union all select 'lines', round({_BRIER3},6) from lines""",
    "roc_auc": f"{_S}, one as (select 1 as k, * from scored), {ranks_sql('one', 'k')} select round(roc_auc,6) as roc_auc from rk",
    "average_precision": f"{_S}, one as (select 1 as k, * from scored), {ranks_sql('one', 'k')} select round(ap,6) as average_precision from rk",
    "roc_auc_ovr": f"{_L}, {_OVR}, {ranks_sql('ovr', 'class')} select round(avg(roc_auc),6) as roc_auc from rk",
    "average_precision_ovr": f"{_L}, {_OVR}, {ranks_sql('ovr', 'class')} select round(avg(ap),6) as average_precision from rk",
    "overall_metrics": f"""{_S}, one as (select 1 as k, * from scored), {report_sql('one', 'k')}, {ranks_sql('one', 'k')}
{_overall('holdout_', None, f'(select {_LOSS2} from scored)', '(select avg(pow(p - y, 2)) from scored)')} from lab l join rk k using (g)""",
    "overall_by_day": f"""{_S}, one as (select strftime(ts, '%Y-%m-%d') as day, * from scored), {report_sql('one', 'day')}, {ranks_sql('one', 'day')},
pr as (select day as g, {_LOSS2} as loss, avg(pow(p - y, 2)) as brier from one group by 1)
{_overall('', 'day', 'pr.loss', 'pr.brier')} from lab l join rk k using (g) join pr using (g)""",
    "overall_multiclass": f"""{_L}, {_OVR}, one as (select 1 as k, * from lines), {report_sql('one', 'k')}, {ranks_sql('ovr', 'class')}
{_overall('', None, f'(select {_LOSS3} from lines)', f'(select {_BRIER3} from lines)')}
from lab l, (select avg(roc_auc) as roc_auc, avg(ap) as ap from rk) k""",
    "evaluate_scored": f"""{_S}, one as (select 1 as k, * from scored), {ranks_sql('one', 'k')}
select (select round(avg(pow(p - y, 2)),6) from scored) as brier, round(roc_auc,6) as roc from rk""",
    "pr_curve": f"""{_CURVE} select round(p,6) as threshold, round(tp / (tp + fp),6) as precision, round(tp / pp,6) as recall from cu, n
union all select null, 1, 0""",
    "roc_curve": f"""{_CURVE} select round(p,6) as threshold, round(fp / nn,6) as fpr, round(tp / pp,6) as tpr from cu, n
union all select 'inf'::double, 0, 0""",
    "roc_curve_corners": f"""{_CURVE}, k as (select *, row_number() over (order by p desc) as i, lead(pos) over (order by p desc) as np,
  lead(neg) over (order by p desc) as nq from cu)
select round(p,6) as threshold, round(fp / nn,6) as fpr, round(tp / pp,6) as tpr from k, n
where i = 1 or np is null or np <> pos or nq <> neg union all select 'inf'::double, 0, 0""",
    "threshold_table": f"{_TH} select * from th",
    "benefit_structure": f"""{_TH} select threshold, s.n as structure, tp, fp, fn, tn,
  s.g * (tp - fn) - 2 * fp - (tp + fp) as benefit from th, (values ('old_structure', 10), ('new_structure', 100)) s(n, g)""",
    "best_threshold": f"""{_CURVE}, v as (select p, tp / pp - fp / nn as j, 2e0 * tp / (2e0 * tp + fp + (pp - tp)) as f from cu, n)
(select 'youden' as criterion, round(p,6) as threshold, round(j,6) as value from v order by j desc, p desc limit 1)
union all (select 'f1', round(p,6), round(f,6) from v order by f desc, p desc limit 1)""",
    "bias_variance_01": f"""{_VOTES}, c as (select event_id, y, (s >= 0.6e0)::int as pred, count(*) as n from votes group by 1, 2, 3),
m as (select *, row_number() over (partition by event_id order by n desc, pred) as i, sum(n) over (partition by event_id) as t,
  sum(case when pred <> y then n else 0 end) over (partition by event_id) as bad from c)
select round(avg(bad / t),6) as expected_loss, round(avg((pred <> y)::int),6) as bias, round(avg(1 - n / t),6) as variance
from m where i = 1""",
    "bias_variance_mse": f"""{_VOTES}, m as (select event_id, any_value(y) as y, avg(s) as main, var_pop(s) as v, avg(pow(s - y, 2)) as l
  from votes group by 1) select round(avg(l),6) as expected_loss, round(avg(pow(main - y, 2)),6) as bias, round(avg(v),6) as variance from m""",
}
