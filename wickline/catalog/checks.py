"""Validation, statistics, gaps and comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from wickline import schemas
from wickline.catalog import derived as d
from wickline.operators import quality, running

RAW = {k: v for k, v in schemas.RAW.items()}
TYPED = {"symbol": "str", "open": "float", "close": "float", "number_of_trades": "int", "utc_datetime": "datetime",
         "absent": "float"}


def damaged(spark, sf):
    """Candles of a single trade have an unreadable open; those without taker volume miss it."""
    return d.klines_stamped(spark, sf).withColumns({
        "open": F.when(F.col("number_of_trades") == 1, "n/a").otherwise(F.col("open")),
        "taker_buy_base_asset_volume": F.nullif("taker_buy_base_asset_volume", F.lit("0"))})


def q_validate_schema(spark, sf):
    return quality.validate_schema(damaged(spark, sf), TYPED).unionByName(
        quality.validate_schema(damaged(spark, sf), RAW).withColumn("column", F.concat(F.lit("raw."), "column")))


def q_violations(spark, sf):
    declared = {"open": "float", "taker_buy_base_asset_volume": "float", "close": "int"}
    return quality.violations(damaged(spark, sf), declared, schemas.KEY)


def q_validate_non_null(spark, sf):
    return quality.validate_non_null(damaged(spark, sf), list(RAW))


def q_validate_frame(spark, sf):
    return quality.validate_frame(damaged(spark, sf), TYPED)


def q_drift_zscore(spark, sf):
    df = d.table(spark, sf, "lineitem")
    before = df.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    base = before.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    base["l_tax"] = 1.0  # a baseline the table has left far behind
    return d.rounded(quality.drift_zscore(df, base))


def q_expect_mean_between(spark, sf):
    df = d.table(spark, sf, "lineitem")
    return d.rounded(quality.expect_mean_between(df, {"l_quantity": (20.0, 30.0), "l_discount": (0.5, 1.0)}))


def q_quality_gate(spark, sf):
    rules = {"quantity_positive": F.col("l_quantity") > 0, "discount_small": F.col("l_discount") <= 0.05,
             "flag_known": F.col("l_returnflag").isin("A", "N", "R")}
    return quality.quality_gate(d.table(spark, sf, "lineitem"), rules, ["l_orderkey", "l_linenumber"])


def q_column_stats(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    df = d.table(spark, sf, "lineitem")
    quartiles = running.exact_quantiles(df, columns, [0.25, 0.5, 0.75]).drop("n")
    return d.rounded(quality.column_moments(df, columns).join(quartiles, "column"), 4)


def q_histogram(spark, sf):
    return quality.histogram(d.table(spark, sf, "events"), "value", 0.0, 500.0, 20, ["event_type"])


def q_correlation_pairs(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return d.rounded(quality.correlation_pairs(d.table(spark, sf, "lineitem"), columns))


def q_find_gaps(spark, sf):
    return quality.find_gaps(d.klines_raw(spark, sf), d.HOUR_MS, slots=24)


def q_frame_diff(spark, sf):
    """Order lines against their deduplicated form."""
    lines = d.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return quality.frame_diff(lines, lines.distinct())


def q_compare_cases(spark, sf):
    raw, lines = d.klines_raw(spark, sf), d.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return quality.compare_cases({
        "candles equal themselves": (raw, d.klines_raw(spark, sf)),
        "line numbers are unique": (lines, lines.distinct())})


QUERIES = {
    "validate_schema": q_validate_schema, "violations": q_violations, "validate_non_null": q_validate_non_null,
    "validate_frame": q_validate_frame, "drift_zscore": q_drift_zscore, "expect_mean_between": q_expect_mean_between,
    "quality_gate": q_quality_gate, "column_stats": q_column_stats, "histogram": q_histogram,
    "correlation_pairs": q_correlation_pairs, "find_gaps": q_find_gaps, "frame_diff": q_frame_diff,
    "compare_cases": q_compare_cases,
}

_D = f"""with {d.KLINES_SQL}, damaged as (select * replace (
  case when number_of_trades = 1 then 'n/a' else open end as open,
  nullif(taker_buy_base_asset_volume, '0') as taker_buy_base_asset_volume) from stamped)"""
_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _rows(entries: list[str]) -> str:
    return " union all ".join(entries)


_TYPED_SQL = _rows([
    "select 'symbol' as \"column\", 'str' as declared, true as present, count(*) filter (symbol is null) as failures from damaged",
    "select 'open', 'float', true, count(*) filter (open is null or try_cast(open as double) is null) from damaged",
    "select 'close', 'float', true, count(*) filter (close is null or try_cast(close as double) is null) from damaged",
    "select 'number_of_trades', 'int', true, count(*) filter (number_of_trades is null) from damaged",
    "select 'utc_datetime', 'datetime', true, count(*) filter (utc_datetime is null) from damaged",
    "select 'absent', 'float', false, count(*) from damaged"])
_RAW_SQL = _rows([f"select 'raw.{c}' as \"column\", '{k}' as declared, true as present, "
                  f"count(*) filter ({c} is null) as failures from damaged" for c, k in RAW.items()])
ORACLES = {
    "validate_schema": f"{_D} {_TYPED_SQL} union all {_RAW_SQL}",
    "violations": f"""{_D}
select symbol, open_time, 'open' as "column", 'not float' as rule, open as value from damaged where open = 'n/a'
union all select symbol, open_time, 'taker_buy_base_asset_volume', 'null', null from damaged where taker_buy_base_asset_volume is null
union all select symbol, open_time, 'close', 'not int', close from damaged where not regexp_full_match(close, '[0-9]+')""",
    "validate_non_null": _D + _rows([f" select '{c}' as \"column\", count(*) filter ({c} is null) as failures from damaged"
                                     for c in RAW]),
    "validate_frame": _D + _rows(
        [f" select 'column' as \"check\", '{c}' as \"column\", {int(c == 'absent')}::bigint as failures" for c in
         ["symbol", "open", "close", "number_of_trades", "utc_datetime", "absent"]]
        + [" select 'type', 'open', count(*) filter (try_cast(open as double) is null) from damaged"]
        + [f" select 'type', '{c}', 0" for c in ["symbol", "close", "number_of_trades", "utc_datetime"]]
        + [f" select 'missing', '{c}', count(*) filter ({c} is null) from damaged" for c in
           ["symbol", "open", "close", "number_of_trades", "utc_datetime"]]),
    "drift_zscore": "with b as (select " + ", ".join(f"avg({c}) as {c}" for c in _NUM[:3]) + """, 1e0 as l_tax from lineitem
  where l_shipdate < timestamp '1998-01-01'), r as (""" + _rows([
        f"select '{c}' as \"column\", avg(l.{c}) as mean, any_value(b.{c}) as baseline, "
        f"abs(avg(l.{c}) - any_value(b.{c})) / stddev_samp(l.{c}) as z from lineitem l, b" for c in _NUM]) + """)
select "column", round(mean,6) as mean, round(baseline,6) as baseline, round(z,6) as z, z > 3 as drifted from r""",
    "expect_mean_between": """select 'l_quantity' as "column", round(avg(l_quantity),6) as mean,
  avg(l_quantity) between 20 and 30 as passed from lineitem
union all select 'l_discount', round(avg(l_discount),6), avg(l_discount) between 0.5 and 1 from lineitem""",
    "quality_gate": """with r as (
select 'quantity_positive' as rule, count(*) filter (not l_quantity > 0) as failures from lineitem
union all select 'discount_small', count(*) filter (not l_discount <= 0.05e0) from lineitem
union all select 'flag_known', count(*) filter (l_returnflag not in ('A','N','R')) from lineitem
union all select 'duplicate_key', (count(*) - count(distinct (l_orderkey, l_linenumber))) from lineitem)
select rule, failures, failures = 0 as passed from r""",
    "column_stats": _rows([f"""select '{c}' as "column", count({c}) as n, round(avg({c}),4) as mean,
  round(stddev_samp({c}),4) as std, min({c}) as low, max({c}) as high, round(quantile_cont({c},0.25),4) as q0,
  round(quantile_cont({c},0.5),4) as q1, round(quantile_cont({c},0.75),4) as q2 from lineitem""" for c in _NUM]),
    "histogram": """select event_type, case when value < 0 then 0 when value >= 500 then 21
  else floor(value / 25e0)::bigint + 1 end as bin, count(*) as rows from events group by 1, 2""",
    "correlation_pairs": _rows([f"select '{a}' as \"left\", '{b}' as \"right\", round(corr({a},{b}),6) + 0 as corr from lineitem"
                                for i, a in enumerate(_NUM) for b in _NUM[i + 1:]]),
    "find_gaps": f"""with {d.KLINES_SQL}, s as (select symbol, open_time, lag(open_time) over
  (partition by symbol order by open_time) as prev from klines)
select symbol, prev as after_time, open_time as next_time, (open_time - prev - 1) // 3600000 as missing
from s where open_time - prev > 3600000""",
    "frame_diff": """select l_orderkey, l_linenumber, l_returnflag, count(*) as in_actual, 1::bigint as in_expected
from lineitem group by 1, 2, 3 having count(*) > 1""",
    "compare_cases": """select 'candles equal themselves' as description, 0::bigint as differences, true as agrees
union all select 'line numbers are unique', count(*), count(*) = 0 from
  (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1)""",
}
