"""Sources, sinks and catalog tables."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.functions.intervals import interval_to_millis
from wickline.operators.casting import stamp_lineage
from wickline.operators.quality import quality_gate
from wickline.session import fresh_path
from wickline.sources import snapshots, tables
from wickline.sources.kline_pages import plan_pages, read_kline_pages, write_kline_pages

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def q_interval_to_millis(spark, sf):
    unit = F.element_at(F.create_map(*[F.lit(x) for x in ("A", "m", "R", "h", "N", "d")]), F.col("l_returnflag"))
    text = F.concat(F.col("l_quantity").cast("int").cast("string"), unit)
    df = d.table(spark, sf, "lineitem").select(text.alias("interval"))
    return df.select("interval", interval_to_millis(F.col("interval")).alias("millis")).groupBy(
        "interval", "millis").agg(F.count("*").alias("rows"))


def q_plan_pages(spark, sf):
    ms = F.unix_millis(F.date_trunc("minute", F.col("ts")).cast("timestamp"))
    users = d.table(spark, sf, "events").groupBy(F.col("user_id").alias("symbol")).agg(
        F.min(ms).alias("start_time"), F.max(ms).alias("end_time"))
    return plan_pages(users, "1m", 1000)


def _land(spark, sf):
    path = fresh_path(spark, "pages")
    write_kline_pages(d.klines_raw(spark, sf), path, "1h")
    return path


def q_read_kline_pages(spark, sf):
    df = read_kline_pages(spark, _land(spark, sf))
    return df.select("symbol", *schemas.PAGE_COLUMNS)


def q_stamp_lineage(spark, sf):
    return stamp_lineage(d.klines_raw(spark, sf), d.RUN_TS)


QUERY = """select symbol, count(*) as candles, max(open_time) as last_open_time
from {klines} where number_of_trades >= 2 group by symbol"""


def q_query_table(spark, sf):
    return tables.query_table(spark, QUERY, klines=d.klines_raw(spark, sf))


def _summary(df):
    return df.groupBy("symbol").agg(F.count("*").alias("rows"), F.min("open_time").alias("first_open"),
                                    F.max("open_time").alias("last_open"))


SUMMARY_SQL = "select symbol, count(*) as rows, min(open_time) as first_open, max(open_time) as last_open"


def _table_name(stem):
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def q_append_table(spark, sf):
    """Empty load, append and a refused second empty load; then what the table holds."""
    name, df = _table_name("raw_klines"), d.klines_raw(spark, sf)
    early = df.where(F.col("open_time") < d.SECOND_LOAD_MS)
    late = df.where(F.col("open_time") >= d.SECOND_LOAD_MS)
    tables.append_table(early, name, tables.WRITE_EMPTY, location=fresh_path(spark, name))
    tables.append_table(late, name, tables.WRITE_APPEND)
    return _summary(spark.table(name))


def q_truncate_table(spark, sf):
    name, df = _table_name("raw_klines"), d.klines_raw(spark, sf)
    tables.append_table(df, name, location=fresh_path(spark, name))
    tables.append_table(df.where(F.col("open_time") >= d.SECOND_LOAD_MS), name, tables.WRITE_TRUNCATE)
    return _summary(spark.table(name))


def q_snapshot_csv(spark, sf):
    path = snapshots.snapshot_csv(d.klines_stamped(spark, sf), fresh_path(spark, "snap"), "market", "raw", d.RUN_TS)
    return _summary(spark.read.option("header", True).csv(path).withColumn("open_time", F.col("open_time").cast("bigint")))


def q_read_csv_snapshot(spark, sf):
    df = d.klines_stamped(spark, sf)
    path = snapshots.snapshot_csv(df, fresh_path(spark, "snap"), "market", "raw", d.RUN_TS)
    return snapshots.read_csv_snapshot(spark, path, df.schema)


def q_save_extract(spark, sf):
    df = d.klines_cleaned(spark, sf)
    path = snapshots.save_extract(df, fresh_path(spark, "extract"), "processed_klines", "processed")
    return _summary(snapshots.read_csv_snapshot(spark, path, df.schema))


def q_first_run(spark, sf):
    """The first-run answer before and after the table of the loaded candles exists."""
    dataset, name = _table_name("market"), "raw_klines"
    before = tables.is_first_run(spark, dataset, name)
    tables.create_dataset(spark, dataset, fresh_path(spark, dataset))
    between = tables.is_first_run(spark, dataset, name)
    tables.append_table(d.klines_raw(spark, sf), f"{dataset}.{name}", location=fresh_path(spark, dataset))
    after = tables.is_first_run(spark, dataset, name)
    return spark.table(f"{dataset}.{name}").agg(F.count("*").alias("rows")).select(
        "rows", F.lit(before).alias("before"), F.lit(between).alias("between"), F.lit(after).alias("after"))


def q_dataset_profile(spark, sf):
    parts = [snapshots.dataset_profile(d.table(spark, sf, t), t) for t in TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dataset_files(spark, sf):
    return snapshots.dataset_profile(d.table(spark, sf, "lineitem"), "lineitem", files=True)


def q_dataset_fingerprint(spark, sf):
    raw = snapshots.fingerprint(d.klines_raw(spark, sf)).select(F.lit("klines").alias("source"), "*")
    docs = snapshots.fingerprint(d.table(spark, sf, "documents")).select(F.lit("documents").alias("source"), "*")
    return raw.unionByName(docs)


def q_read_version(spark, sf):
    root, df = fresh_path(spark, "versions"), d.klines_raw(spark, sf)
    first = snapshots.save_version(df.where(F.col("open_time") < d.SECOND_LOAD_MS), root, "klines", d.RUN_TS)
    snapshots.save_version(df, root, "klines", d.RUN_TS + timedelta(hours=1))
    return _summary(snapshots.read_version(spark, root, "klines", first))


def q_promote_table(spark, sf):
    name, df = _table_name("production_klines"), d.klines_typed(spark, sf)
    gate = quality_gate(df, {"high_is_highest": F.col("high") >= F.col("low")}, schemas.KEY)
    tables.promote_table(df, name, gate, location=fresh_path(spark, name))
    return spark.table(name).groupBy("symbol").agg(F.count("*").alias("rows"), F.max("utc_datetime").alias("last"))


def q_candles(spark, sf):
    return d.klines_raw(spark, sf)


def q_rise_rate(spark, sf):
    """The flagship: how often each symbol's hourly candle rose."""
    return d.klines_cleaned(spark, sf).groupBy("symbol").agg(
        F.count("*").alias("candles"), F.sum("price_increase").alias("rises"),
        F.round(F.avg("price_increase"), 6).alias("rise_rate"), F.sum("number_of_trades").alias("trades"))


QUERIES = {
    "candles": q_candles, "rise_rate": q_rise_rate, "interval_to_millis": q_interval_to_millis, "plan_pages": q_plan_pages, "read_kline_pages": q_read_kline_pages,
    "stamp_lineage": q_stamp_lineage, "query_table": q_query_table, "append_table": q_append_table,
    "truncate_table": q_truncate_table, "snapshot_csv": q_snapshot_csv, "read_csv_snapshot": q_read_csv_snapshot,
    "save_extract": q_save_extract, "first_run": q_first_run, "dataset_profile": q_dataset_profile,
    "dataset_files": q_dataset_files, "dataset_fingerprint": q_dataset_fingerprint, "read_version": q_read_version,
    "promote_table": q_promote_table,
}

_COLUMNS = {
    "region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6,
    "documents": 5, "embeddings": 3, "pages": 3, "benchmark": 2, "labels": 3, "conversations": 4,
}
_FEED = ", ".join(schemas.PAGE_COLUMNS)
def _row_text(columns) -> str:
    return "concat(" + ", ".join(f"coalesce(length({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in columns) + ")"


def _mark(columns) -> str:
    parts = [f"sum(('0x' || substr(md5({_row_text(columns)}),{at},15))::bigint)::varchar" for at in (1, 16)]
    return " || '-' || ".join(parts)


ORACLES = {
    "candles": f"with {d.KLINES_SQL} select symbol, {_FEED} from klines",
    "rise_rate": f"""with {d.KLINES_SQL} select symbol, count(*) as candles, sum(price_increase)::bigint as rises,
  round(avg(price_increase),6) as rise_rate, sum(number_of_trades)::bigint as trades from cleaned group by 1""",
    "interval_to_millis": """
with t as (select l_quantity::int as n, case l_returnflag when 'A' then 'm' when 'R' then 'h' else 'd' end as u from lineitem)
select n::varchar || u as "interval",
       n::bigint * case u when 'm' then 60000 when 'h' then 3600000 else 86400000 end as millis, count(*) as rows
from t group by all""",
    "plan_pages": """
with u as (select user_id as symbol, min(epoch_ms(date_trunc('minute', ts))) as s, max(epoch_ms(date_trunc('minute', ts))) as e
           from events group by 1),
p as (select *, unnest(range(greatest(1, ceil((e - s) / 60000000.0)::bigint))) as page from u)
select symbol, '1m' as "interval", page, s + page * 60000000 as start_time,
       least(s + (page + 1) * 60000000, e) as end_time, 1000 as "limit" from p""",
    "read_kline_pages": f"with {d.KLINES_SQL} select symbol, {_FEED} from klines",
    "stamp_lineage": f"with {d.KLINES_SQL} select * from stamped",
    "query_table": f"with {d.KLINES_SQL} " + QUERY.replace("{klines}", "klines"),
    "append_table": f"with {d.KLINES_SQL} {SUMMARY_SQL} from klines group by symbol",
    "truncate_table": f"with {d.KLINES_SQL} {SUMMARY_SQL} from klines where open_time >= {d.SECOND_LOAD_MS} group by symbol",
    "snapshot_csv": f"with {d.KLINES_SQL} {SUMMARY_SQL} from klines group by symbol",
    "read_csv_snapshot": f"with {d.KLINES_SQL} select * from stamped",
    "save_extract": f"with {d.KLINES_SQL} {SUMMARY_SQL} from klines group by symbol",
    "first_run": f"with {d.KLINES_SQL} select count(*) as rows, true as before, true as between, false as after from klines"
    .replace("as between", 'as "between"').replace("as before", 'as "before"').replace("as after", 'as "after"'),
    "dataset_profile": " union all ".join(
        f"select '{t}' as source, {n} as cols, count(*) as rows from {t}" for t, n in _COLUMNS.items()),
    "dataset_fingerprint": f"""with {d.KLINES_SQL}
select 'klines' as source, count(*) as rows, {_mark(['symbol', *schemas.PAGE_COLUMNS])} as fingerprint from klines
union all select 'documents', count(*), {_mark(['doc_id', 'text', 'lang', 'source', 'n_chars'])} from documents""",
    "read_version": f"with {d.KLINES_SQL} {SUMMARY_SQL} from klines where open_time < {d.SECOND_LOAD_MS} group by symbol",
    "promote_table": f"with {d.KLINES_SQL} select symbol, count(*) as rows, max(utc_datetime) as last from stamped group by symbol",
}
