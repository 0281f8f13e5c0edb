"""Views that make the clean test tables dirty, by one recipe for both dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DIRTY_ORDERS = """
WITH b AS (
SELECT o_orderkey AS order_id,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS customer_id,
 CASE o_orderkey % 4 WHEN 0 THEN concat('  ', o_orderpriority, ' ')
                     WHEN 1 THEN replace(o_orderpriority, '-', '  -  ')
                     WHEN 2 THEN lower(o_orderpriority) ELSE o_orderpriority END AS priority,
 CASE o_orderkey % 13 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN '1,234.50' WHEN 3 THEN NULL
                      ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS <TEXT>) END AS amount,
 CASE o_orderkey % 4 WHEN 0 THEN <FMT yyyy-MM-dd> WHEN 1 THEN <FMT MM/dd/yyyy>
                     WHEN 2 THEN <FMT yyyyMMdd> ELSE 'unknown' END AS order_date,
 CASE o_orderkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN ' TRUE '
                     WHEN 3 THEN 'f' WHEN 4 THEN 'maybe' ELSE '0' END AS is_active
FROM <orders>)
SELECT * FROM b UNION ALL SELECT * FROM b WHERE order_id % 17 = 0
"""

_ORDERS_TEXT = """
SELECT CAST(o_orderkey AS <TEXT>) AS id_txt,
 CASE WHEN o_orderkey % 50 = 0 THEN 'abc'
      ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS <TEXT>) END AS price_txt,
 CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '0' END AS flag_txt,
 CASE WHEN o_orderkey % 30 = 0 THEN 'unknown' ELSE <FMT yyyy/MM/dd> END AS date_txt,
 CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE <FMT yyyy-MM-dd HH:mm:ss> END AS ts_txt,
 <FMT yyyyMMdd> AS compact_txt, o_orderpriority AS text_txt
FROM <orders>
"""

_DIRTY_EVENTS = """
SELECT event_id, user_id,
 CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN CAST('NaN' AS DOUBLE)
      WHEN event_id % 97 = 0 THEN value * 1000 ELSE value END AS value,
 CASE WHEN event_id % 9 = 0 THEN NULL ELSE event_type END AS event_type,
 CASE WHEN event_id % 8 = 0 THEN NULL ELSE event_id % 2 = 0 END AS ok,
 CASE WHEN event_id % 12 = 0 THEN NULL ELSE ts END AS ts
FROM <events>
"""

RECIPES = {"dirty_orders": _DIRTY_ORDERS, "orders_text": _ORDERS_TEXT, "dirty_events": _DIRTY_EVENTS}
BASE = {"dirty_orders": "orders", "orders_text": "orders", "dirty_events": "events"}

# The date formats of the recipes and of the queries, in both dialects.
STRFTIME = {
    "yyyy-MM-dd": "%Y-%m-%d", "MM/dd/yyyy": "%m/%d/%Y", "yyyyMMdd": "%Y%m%d",
    "yyyy/MM/dd": "%Y/%m/%d", "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, or one of the dirty views over a test table."""
    if name not in RECIPES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    base = BASE[name]
    text = RECIPES[name].replace("<TEXT>", "STRING").replace(f"<{base}>", "{" + base + "}")
    for fmt in STRFTIME:
        text = text.replace(f"<FMT {fmt}>", f"date_format(o_orderdate, '{fmt}')")
    return spark.sql(text, **{base: table(spark, sf_dir, base)})


def oracle_view(name: str) -> str:
    """The same view as a subquery for DuckDB."""
    text = RECIPES[name].replace("<TEXT>", "VARCHAR").replace(f"<{BASE[name]}>", BASE[name])
    for fmt, other in STRFTIME.items():
        text = text.replace(f"<FMT {fmt}>", f"strftime(o_orderdate, '{other}')")
    return f"({text.strip()})"
