"""Splits, folds, batches and bootstrap samples."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from wickline.catalog import derived as d
from wickline.operators import resampling


def q_stratified_split(spark, sf):
    return resampling.stratified_split(d.table(spark, sf, "labels"), "doc_id", "quality")


def q_stratified_split_events(spark, sf):
    df = d.table(spark, sf, "events").select("event_id", "event_type")
    return resampling.stratified_split(df, "event_id", "event_type")


def q_split_summary(spark, sf):
    df = d.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_returnflag").alias("flag"))
    return resampling.split_summary(resampling.stratified_split(df, "l_orderkey", "flag"))


def q_shuffle_batches(spark, sf):
    return resampling.shuffle_batches(d.table(spark, sf, "events").select("event_id"), "event_id", 256)


def q_bootstrap_sample(spark, sf):
    return resampling.bootstrap_sample(d.table(spark, sf, "customer"), "c_custkey", 200)


def q_poisson_bootstrap(spark, sf):
    df = d.table(spark, sf, "orders").select("o_orderkey")
    return resampling.poisson_bootstrap(df, "o_orderkey", 1)


def q_stratified_kfold(spark, sf):
    df = d.table(spark, sf, "events").select("event_id", "event_type")
    return resampling.stratified_kfold(df, "event_id", "event_type", 5)


def q_group_kfold(spark, sf):
    df = d.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return resampling.group_kfold(df, "user_id", F.col("event_type") == "purchase", 6)


QUERIES = {
    "stratified_split": q_stratified_split, "stratified_split_events": q_stratified_split_events,
    "split_summary": q_split_summary, "shuffle_batches": q_shuffle_batches, "bootstrap_sample": q_bootstrap_sample,
    "poisson_bootstrap": q_poisson_bootstrap, "stratified_kfold": q_stratified_kfold, "group_kfold": q_group_kfold,
}


def split_sql(source: str, key: str, label: str, seed: int = 1992, columns: str = "*") -> str:
    """Quota by largest remainder, then rank in hash order."""
    return f"""
n as (select {label} as c, count(*) as n from {source} group by 1),
t as (select sum(n)::bigint as t, floor(sum(n) * 0.7e0 + 1e-9)::bigint as want from n),
q as (select c, n, n * want // t + (row_number() over (order by n * want % t desc, c)
        <= want - sum(n * want // t) over ())::bigint as a from n, t),
t2 as (select sum(n - a)::bigint as t, floor(sum(n - a) * 0.5e0 + 1e-9)::bigint as want from q),
q2 as (select c, a, (n - a) * want // greatest(t,1) + (row_number() over (order by (n - a) * want % greatest(t,1) desc, c)
        <= want - sum((n - a) * want // greatest(t,1)) over ())::bigint as b from q, t2),
r as (select *, row_number() over (partition by {label} order by md5('{seed}:' || {key}::varchar) || ':' || {key}::varchar)
        as rk from {source}),
parted as (select r.* exclude (rk), case when rk <= a then 'train' when rk <= a + b then 'val' else 'test' end as split
  from r join q2 on r.{label} = q2.c)"""


def _shuffled(key: str, seed: int = 1992) -> str:
    return f"md5('{seed}:' || {key}::varchar) || ':' || {key}::varchar"


_RUNGS = []
_total = 0.0
for _k in range(12):
    _total += math.exp(-1.0) / math.factorial(_k)
    _RUNGS.append(_total)

ORACLES = {
    "stratified_split": f"with {split_sql('labels', 'doc_id', 'quality')} select * from parted",
    "stratified_split_events": "with ev as (select event_id, event_type from events),"
                               f"{split_sql('ev', 'event_id', 'event_type')} select * from parted",
    "split_summary": "with o as (select l_orderkey, max(l_returnflag) as flag from lineitem group by 1),"
                     f"""{split_sql('o', 'l_orderkey', 'flag')} select split, count(*) as size,
  format('{{:.2f}}%', count(*) * 100e0 / (select count(*) from o)) as percentage from parted group by 1""",
    "shuffle_batches": f"""select event_id, (row_number() over (order by {_shuffled('event_id')}) - 1) // 256 as batch
from events""",
    "bootstrap_sample": f"""with n as (select count(*) as n from customer),
d as (select (i.i // n)::int as round, ('0x' || substr(md5('42:' || (i.i // n)::varchar || ':' || (i.i % n)::varchar),1,15))::bigint % n + 1
        as row from n, range((select n * 200 from n)) i(i)),
r as (select c_custkey, row_number() over (order by {_shuffled('c_custkey', 42)}) as row from customer)
select round, c_custkey, count(*) as draws from d join r using (row) group by 1, 2""",
    "poisson_bootstrap": "with u as (select o_orderkey, ('0x' || substr(md5('42:1:' || o_orderkey::varchar),1,8))::bigint"
                         " / 4294967296e0 as u from orders) select o_orderkey, ("
                         + " + ".join(f"(u >= {r!r}::double)::int" for r in _RUNGS) + ")::double as weight from u",
    "stratified_kfold": f"""select event_id, event_type, ntile(5) over (partition by event_type order by
  {_shuffled('event_id')})::int as fold from events""",
    "group_kfold": f"""with g as (select user_id, count(*) as n, count(*) filter (event_type = 'purchase') as k from events group by 1),
f as (select user_id, ((row_number() over (order by k * 100 // n desc, {_shuffled('user_id')}) - 1) % 6 + 1)::int as fold from g)
select event_id, user_id, event_type, fold from events join f using (user_id)""",
}
