"""Registry, promotion and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.catalog.preparation import parted_klines
from wickline.catalog.samples import split_sql
from wickline.operators import features, metrics, models, quality, registry, scoring
from wickline.plans.serving import serve
from wickline.plans.training import TrainingSettings, run_training
from wickline.session import fresh_path, settled

WEIGHTS = {"l_quantity": 0.02, "l_discount": 8.0, "l_tax": -10.0}
BIAS = -0.5


def run_metrics(spark, sf):
    """Metrics of runs: every order is a run, its lines log one of three metrics at a step."""
    name = F.element_at(F.create_map(*[F.lit(x) for x in ("A", "accuracy", "N", "loss", "R", "f1")]), F.col("l_returnflag"))
    return d.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), name.alias("name"), F.col("l_linenumber").alias("step"),
        F.col("l_discount").alias("value"))


def registry_rows(spark, sf):
    """Registry history: every order is a stage change of one of three versions of its customer's model."""
    stage = F.element_at(F.create_map(*[F.lit(x) for x in ("O", "Staging", "F", "Production", "P", "Archived")]),
                         F.col("o_orderstatus"))
    return d.table(spark, sf, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey")).alias("name"), (F.col("o_orderkey") % 3 + 1).cast("int").alias("version"),
        F.col("o_orderkey").alias("run_id"), stage.alias("stage"), F.col("o_orderdate").alias("changed_at"))


def q_latest_metrics(spark, sf):
    return registry.latest_metrics(run_metrics(spark, sf))


def q_log_params(spark, sf):
    """What a run is fitted on, as its parameters."""
    facts = d.table(spark, sf, "orders").agg(
        F.count("*").alias("rows"), F.countDistinct("o_custkey").alias("groups"), F.max("o_orderkey").alias("last_key"),
        F.min("o_orderstatus").alias("first_class"), F.max(F.when(F.col("o_orderkey") < 0, "x")).alias("unset"))
    return registry.log_params("run-1", facts)


def q_next_version(spark, sf):
    names = d.table(spark, sf, "customer").select(
        F.concat(F.lit("model_"), F.col("c_custkey")).alias("name"), F.col("c_custkey").alias("run_id"))
    return registry.next_version(registry_rows(spark, sf), names)


def q_current_stage(spark, sf):
    return registry.current_stage(registry_rows(spark, sf))


def q_transition_stage(spark, sf):
    """Every model in production is archived at a later time."""
    rows = registry_rows(spark, sf)
    live = registry.current_stage(rows).where(F.col("stage") == registry.PRODUCTION)
    later = live.select("name", "version", "run_id", F.lit(registry.ARCHIVED).alias("stage"),
                        (F.col("changed_at") + F.expr("interval 1 day")).alias("changed_at"))
    return registry.current_stage(registry.transition_stage(rows, later)).groupBy("stage").agg(F.count("*").alias("models"))


def q_latest_production_model(spark, sf):
    return registry.latest_production_model(registry_rows(spark, sf))


def q_promotion_decision(spark, sf):
    rows = registry_rows(spark, sf)
    scores = registry.latest_metrics(run_metrics(spark, sf)).where("name = 'accuracy'").select("run_id", "value")
    candidates = registry.latest_in_stage(rows, registry.STAGING).join(scores, "run_id")
    out = registry.promotion_decision(candidates, registry.latest_production_model(rows).join(scores, "run_id", "left"))
    return out.withColumn("live_version", F.coalesce("live_version", F.lit(0)))


def q_compare_metrics(spark, sf):
    """Metrics of the first half of each month against the second."""
    half = (F.col("ts") >= F.lit(d.SECOND_LOAD).cast("timestamp_ntz")).cast("int")
    both = metrics.overall_metrics(d.scored_events(spark, sf).withColumn("half", half), ["half"])
    rows = metrics.as_metric_rows(settled(both, "halves"), ["half"])
    return d.rounded(registry.compare_metrics(rows.where("half = 0"), rows.where("half = 1")))


def linear_scores(spark, sf):
    return scoring.linear_score(d.table(spark, sf, "lineitem"), WEIGHTS, BIAS)


def q_linear_score(spark, sf):
    return d.rounded(linear_scores(spark, sf).select("l_orderkey", "l_linenumber", "l_shipdate", "p"))


def q_score_checks(spark, sf):
    df = linear_scores(spark, sf).select(
        F.col("p").alias("p1"), (F.lit(1.0) - F.col("p")).alias("p0"),
        F.when(F.col("l_returnflag") != "N", (F.col("p") >= 0.5).cast("int")).alias("prediction"))
    return scoring.score_checks(df, ["p0", "p1"])


def q_score_checks_lines(spark, sf):
    df = d.scored_lines(spark, sf).withColumnRenamed("y_pred", "prediction").drop("p_r")
    return scoring.score_checks(df, ["p_a", "p_n", "p_r"])


def _fitted(spark, sf):
    df = settled(parted_klines(spark, sf), "parted")
    train = df.where("split = 'train'")
    chain = features.preprocess_chain(train, schemas.FEATURES)
    return df, models.full_chain(chain, models.linear_estimator(iterations=50).fit(chain.transform(train)))


def q_batch_score(spark, sf):
    df, model = _fitted(spark, sf)
    out = scoring.batch_score(model, df, ["key", "split"])
    total = F.col("probability")[0] + F.col("probability")[1]
    agrees = F.col("prediction") == (F.col("probability")[1] > F.col("probability")[0]).cast("int")
    return out.groupBy("split").agg(F.count("*").alias("rows"), F.round(F.min(total), 6).alias("least_total"),
                                    F.round(F.max(total), 6).alias("greatest_total"), F.min(agrees).alias("consistent"))


def q_model_roundtrip(spark, sf):
    """Predictions of a model before and after it is stored; no row may differ."""
    df, model = _fitted(spark, sf)
    path = fresh_path(spark, "model")
    registry.save_model(model, path, registry.signature_of(df.select(*schemas.FEATURES), df.select("key")))
    again = registry.load_model(path)
    return quality.compare_cases({"stored model predicts the same": (
        scoring.batch_score(model, df, ["key"]), scoring.batch_score(again, df, ["key"], registry.load_signature(path)))})


def q_serve_production(spark, sf):
    """A training run promotes its first model; the whole candle table is then scored with it."""
    root, settings = fresh_path(spark, "serving"), TrainingSettings()
    run_training(d.klines_stamped(spark, sf), root, settings, d.RUN_TS)
    out = serve(d.keyed_klines(spark, sf), root, settings.name, ["symbol"])
    return out.groupBy("symbol").agg(F.count("*").alias("rows"))


QUERIES = {
    "latest_metrics": q_latest_metrics, "log_params": q_log_params, "next_version": q_next_version, "current_stage": q_current_stage,
    "transition_stage": q_transition_stage, "latest_production_model": q_latest_production_model,
    "promotion_decision": q_promotion_decision, "compare_metrics": q_compare_metrics,
    "linear_score": q_linear_score, "score_checks": q_score_checks, "score_checks_lines": q_score_checks_lines,
    "batch_score": q_batch_score, "model_roundtrip": q_model_roundtrip, "serve_production": q_serve_production,
}

_M = """m as (select l_orderkey as run_id, case l_returnflag when 'A' then 'accuracy' when 'N' then 'loss' else 'f1' end as name,
  l_linenumber as step, l_discount as value from lineitem),
lm as (select run_id, name, step, value from (select *, row_number() over (partition by run_id, name order by step desc, value desc) as i
  from m) where i = 1)"""
_R = """r as (select 'model_' || o_custkey::varchar as name, (o_orderkey % 3 + 1)::int as version, o_orderkey as run_id,
  case o_orderstatus when 'O' then 'Staging' when 'F' then 'Production' else 'Archived' end as stage, o_orderdate as changed_at from orders),
cs as (select name, version, stage, run_id, changed_at from (select *, row_number() over (partition by name, version
  order by changed_at desc, run_id desc) as i from r) where i = 1)"""


def _latest(stage: str) -> str:
    return (f"(select name, version, run_id from (select *, row_number() over (partition by name order by version desc) as j "
            f"from cs where stage = '{stage}') where j = 1)")


_P = "1e0 / (1e0 + exp(-(((-0.5e0 + 0.02e0 * l_quantity) + 8e0 * l_discount) + -10e0 * l_tax)))"


def _compare_sql() -> str:
    from wickline.catalog.evaluation import _LOSS2, ranks_sql, report_sql

    names = {"loss": "pr.loss", "precision": "l.precision", "recall": "l.recall", "f1": "l.f1", "accuracy": "l.accuracy",
             "balanced_accuracy": "l.balanced_accuracy", "roc_auc": "k.roc_auc", "precision_recall_auc": "k.ap",
             "brier_score": "pr.brier"}
    rows = " union all ".join(f"select g, '{n}' as name, {e} as v from lab l join rk k using (g) join pr using (g)"
                              for n, e in names.items())
    return f"""with {d.SCORED_SQL}, one as (select (ts >= timestamp '{d.SECOND_LOAD}')::int as half, * from scored),
{report_sql('one', 'half')}, {ranks_sql('one', 'half')},
pr as (select half as g, {_LOSS2} as loss, avg(pow(p - y, 2)) as brier from one group by 1), ms as ({rows}),
ab as (select name, max(v) filter (g = 0) as a, max(v) filter (g = 1) as b from ms group by 1)
select name, round(a,6) as a, round(b,6) as b, round(a - b,6) + 0 as delta, round(a / b,6) as ratio,
  case when a = b then 'tie' when (a > b) = (name not in ('loss','brier_score')) then 'a' else 'b' end as winner from ab"""


ORACLES = {
    "latest_metrics": f"with {_M} select * from lm",
    "log_params": """with f as (select count(*) as n, count(distinct o_custkey) as g, max(o_orderkey) as k, min(o_orderstatus) as c from orders)
        select 'run-1' as run_id, 'rows' as name, cast(n as varchar) as value from f
        union all select 'run-1', 'groups', cast(g as varchar) from f union all select 'run-1', 'last_key', cast(k as varchar) from f
        union all select 'run-1', 'first_class', c from f union all select 'run-1', 'unset', null from f""",
    "next_version": f"""with {_R}, v as (select name, max(version) as top from r group by 1)
select 'model_' || c_custkey::varchar as name, c_custkey as run_id, coalesce(top, 0) + 1 as version
from customer left join v on v.name = 'model_' || c_custkey::varchar""",
    "current_stage": f"with {_R} select * from cs",
    "transition_stage": f"""with {_R} select case stage when 'Production' then 'Archived' else stage end as stage, count(*) as models
from cs group by 1""",
    "latest_production_model": f"with {_R} select * from {_latest('Production')}",
    "promotion_decision": f"""with {_R}, {_M}, s as (select run_id, value from lm where name = 'accuracy'),
c as (select l.name, l.version, s.value from {_latest('Staging')} l join s using (run_id)),
p as (select l.name, l.version, s.value from {_latest('Production')} l left join s using (run_id))
select c.name, c.version, c.value, coalesce(p.version, 0) as live_version, p.value as live_value,
  coalesce(p.version is null or c.value > p.value, false) as promote from c left join p using (name)""",
    "compare_metrics": _compare_sql(),
    "linear_score": f"select l_orderkey, l_linenumber, l_shipdate, round({_P}, 6) as p from lineitem",
    "score_checks": """select 'missing_columns' as rule, 0::bigint as failures, true as passed
union all select 'null_output', count(*), count(*) = 0 from lineitem where l_returnflag = 'N'
union all select 'probability_range', 0, true union all select 'probability_sum', 0, true""",
    "score_checks_lines": f"""with {d.LINES_SQL} select 'missing_columns' as rule, 1::bigint as failures, false as passed
union all select 'null_output', count(*) filter (p_a is null), true from lines
union all select 'probability_range', count(*) filter (p_a > 1), true from lines
union all select 'probability_sum', count(*) filter (abs(p_a + p_n - 1) > 1e-9), false from lines""",
    "batch_score": f"""with {d.KLINES_SQL}, {split_sql('cleaned', 'key', 'price_increase')}
select split, count(*) as rows, 1e0 as least_total, 1e0 as greatest_total, true as consistent from parted group by 1""",
    "model_roundtrip": "select 'stored model predicts the same' as description, 0::bigint as differences, true as agrees",
    "serve_production": f"with {d.KLINES_SQL} select symbol, count(*) as rows from cleaned group by 1",
}
