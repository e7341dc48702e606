"""Imputing, scaling, encoding and feature reduction."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.operators import features, neighbours, resampling
from wickline.catalog.samples import split_sql
from wickline.session import settled

NEAR = ["open", "high", "low", "volume"]
GAP = "taker_buy_base_asset_volume"


def gapped(spark, sf):
    """Candles of which every seventeenth by its key lacks the taker volume."""
    return d.numbered_klines(spark, sf).withColumn(GAP, F.when(F.col("id") % 17 != 0, F.col(GAP)))


def parted_klines(spark, sf):
    """Split candles. The candles are written once: the split reads its input several times."""
    return resampling.stratified_split(settled(d.keyed_klines(spark, sf), "klines"), "key", "price_increase")


def q_knn_impute(spark, sf):
    df = settled(gapped(spark, sf), "klines")
    filled = neighbours.knn_impute(df, df, "id", [*NEAR, GAP], GAP, 5)
    return d.rounded(filled.select("id", GAP))


def q_knn_classify(spark, sf):
    df = settled(d.numbered_klines(spark, sf), "klines")
    late = df.where(F.col("open_time") >= d.SECOND_LOAD_MS)
    early = df.where(F.col("open_time") < d.SECOND_LOAD_MS)
    return neighbours.knn_classify(late, early, "id", [*NEAR, "number_of_trades"], "price_increase", 8)


def q_mean_impute(spark, sf):
    df = gapped(spark, sf)
    mean = features.mean_impute(df, df, [GAP]).select("id", F.col(GAP).alias("by_mean"))
    median = features.mean_impute(df, df, [GAP], "median").select("id", F.col(GAP).alias("by_median"))
    return d.rounded(mean.join(median, "id"))


def q_standard_scale(spark, sf):
    df = parted_klines(spark, sf)
    scaled = features.standard_scale(df, df.where("split = 'train'"), schemas.FEATURES)
    return d.rounded(scaled.select("key", "split", *schemas.FEATURES))


def q_one_hot(spark, sf):
    """Languages known from English, French and German documents; Spanish ones are new."""
    docs = d.table(spark, sf, "documents").select("doc_id", "lang")
    return features.one_hot(docs, docs.where(F.col("lang") != "es"), "lang")


def q_one_hot_stage(spark, sf):
    """The same encoding from the ml stages of the preprocessing chain, as 0/1 sums."""
    docs = d.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    chain = features.preprocess_chain(docs.where(F.col("lang") != "es"), ["n_chars"], ["lang"])
    hot = F.slice(vector_to_array("features"), 2, 3)
    return chain.transform(docs).select("doc_id", *[hot[i].cast("int").alias(n) for i, n in enumerate(
        ["lang_de", "lang_en", "lang_fr"])])


def q_label_encode(spark, sf):
    return features.label_encode(d.table(spark, sf, "events").select("event_id", "event_type"), "event_type")


def q_preprocess_chain(spark, sf):
    df = parted_klines(spark, sf)
    chain = features.preprocess_chain(df.where("split = 'train'"), schemas.FEATURES, ["symbol"])
    width = F.size(vector_to_array("features"))
    return chain.transform(df).groupBy("split").agg(F.count("*").alias("rows"), F.max(width).alias("width"))


def q_reduce_vif(spark, sf):
    columns = ["open", "high", "low", "close", "volume", "quote_asset_volume", "number_of_trades",
               "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume"]
    return d.rounded(features.reduce_vif(d.klines_cleaned(spark, sf), columns), 4)


QUERIES = {
    "knn_impute": q_knn_impute, "knn_classify": q_knn_classify, "mean_impute": q_mean_impute,
    "standard_scale": q_standard_scale, "one_hot": q_one_hot, "one_hot_stage": q_one_hot_stage,
    "label_encode": q_label_encode, "preprocess_chain": q_preprocess_chain, "reduce_vif": q_reduce_vif,
}

_K = f"with {d.KLINES_SQL}"


def _distance(columns: list[str], size: int) -> tuple[str, str]:
    terms = " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in columns)
    return terms, f"{size}e0 / {len(columns)}e0"


_TERMS, _SCALE = _distance(NEAR, 5)
_TERMS5 = " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in [*NEAR, "number_of_trades"])
_HOT = "select doc_id, lang, " + ", ".join(f"(lang = '{v}')::int as lang_{v}" for v in ("de", "en", "fr")) + " from documents"
ORACLES = {
    "knn_impute": f"""{_K}, g as (select id, {', '.join(NEAR)}, case when id % 17 <> 0 then {GAP} end as v from cleaned),
d as (select q.id, t.v, row_number() over (partition by q.id order by ({_TERMS}) * ({_SCALE}), t.id) as i
  from g q join g t on q.v is null and t.v is not null),
f as (select id, avg(v) as v from d where i <= 5 group by 1)
select id, round(coalesce(g.v, f.v), 6) as {GAP} from g left join f using (id)""",
    "knn_classify": f"""{_K}, d as (select q.id, t.price_increase as c, row_number() over (partition by q.id
    order by {_TERMS5}, t.id) as i from cleaned q join cleaned t on q.open_time >= {d.SECOND_LOAD_MS} and t.open_time < {d.SECOND_LOAD_MS}),
v as (select id, c, count(*) as n from d where i <= 8 group by 1, 2)
select id, c as y_pred, n as votes from (select *, row_number() over (partition by id order by n desc, c) as i from v) where i = 1""",
    "mean_impute": f"""{_K}, g as (select id, case when id % 17 <> 0 then {GAP} end as v from cleaned),
m as (select avg(v) as a, quantile_cont(v, 0.5) as b from g)
select id, round(coalesce(v, a), 6) as by_mean, round(coalesce(v, b), 6) as by_median from g, m""",
    "standard_scale": f"""{_K}, {split_sql('cleaned', 'key', 'price_increase')},
m as (select {', '.join(f'avg({c}) as m_{c}, stddev_pop({c}) as s_{c}' for c in schemas.FEATURES)} from parted where split = 'train')
select key, split, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) + 0 as {c}' for c in schemas.FEATURES)} from parted, m""",
    "one_hot": _HOT,
    "one_hot_stage": f"select * exclude (lang) from ({_HOT})",
    "label_encode": """select event_id, event_type, (dense_rank() over (order by event_type) - 1)::int as label from events""",
    "preprocess_chain": f"""{_K}, {split_sql('cleaned', 'key', 'price_increase')}
select split, count(*) as rows, {len(schemas.FEATURES)} + 5 as width from parted group by 1""",
}
