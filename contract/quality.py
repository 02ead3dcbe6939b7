"""Row rules, keys, rejects and upserts over order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract import standins as s
from contract.registry import query
from contract.standins import rounded
from strata.functions.types import align_to
from strata.operators import compare, keys, rules
from strata.operators.upsert import rows_to_insert
from strata.sources.scratch import stage

# Order date before ship date, price within limits, dates within a window; customers stand in for a nullable column.
RULES = [
    {"rule": "not_null", "columns": ["l_orderkey", "l_shipdate", "priority"]},
    {"rule": "timestamp_order", "before": "o_orderdate", "after": "l_shipdate"},
    {"rule": "timestamp_range", "column": "o_orderdate", "min": "1995-06-01", "max": "2001-01-01"},
    {"rule": "numeric_range", "column": "l_extendedprice", "min": 1000, "max": 90000},
    {"rule": "primary_key", "columns": ["l_orderkey", "l_linenumber"]},
]
COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
    "o_orderdate", "priority",
)
KEY = ["l_orderkey", "l_linenumber"]

LINES_CTE = """WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, o_orderdate,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
flagged AS (
  SELECT *, concat_ws(',',
    CASE WHEN l_orderkey IS NULL THEN 'null:l_orderkey' END,
    CASE WHEN l_shipdate IS NULL THEN 'null:l_shipdate' END,
    CASE WHEN priority IS NULL THEN 'null:priority' END,
    CASE WHEN o_orderdate > l_shipdate THEN 'ts_order:o_orderdate>l_shipdate' END,
    CASE WHEN o_orderdate < TIMESTAMP '1995-06-01' OR o_orderdate >= TIMESTAMP '2001-01-01' THEN 'ts_range:o_orderdate' END,
    CASE WHEN l_extendedprice < 1000 OR l_extendedprice > 90000 THEN 'range:l_extendedprice' END) AS reason
  FROM lines),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, o_orderdate, priority) AS rn
  FROM flagged WHERE reason = '')
"""


def order_lines(spark, sf):
    lines = s.table(spark, sf, "lineitem").join(
        s.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return lines.withColumn("priority", priority).select(*COLUMNS)


def _staged_lines(spark, sf):
    """The order lines joined once and written, for queries whose outcome reads them several times."""
    return stage(order_lines(spark, sf), "order-lines")


def _only(kind: str):
    return [r for r in RULES if r["rule"] == kind]


def _reasons(spark, sf, kind: str):
    flagged = rules.flag_rows(order_lines(spark, sf), _only(kind))
    return flagged.groupBy(F.col("_reject_reason").alias("reason")).agg(F.count("*").alias("records"))


@query("not_null_rule", LINES_CTE + """
SELECT CASE WHEN priority IS NULL THEN 'null:priority' ELSE '' END AS reason, COUNT(*) AS records FROM lines GROUP BY 1""")
def not_null_rule(spark, sf):
    return _reasons(spark, sf, "not_null")


@query("numeric_range_rule", LINES_CTE + """
SELECT CASE WHEN l_extendedprice < 1000 OR l_extendedprice > 90000 THEN 'range:l_extendedprice' ELSE '' END AS reason,
       COUNT(*) AS records FROM lines GROUP BY 1""")
def numeric_range_rule(spark, sf):
    return _reasons(spark, sf, "numeric_range")


@query("timestamp_range_rule", LINES_CTE + """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1995-06-01' OR o_orderdate >= TIMESTAMP '2001-01-01' THEN 'ts_range:o_orderdate' ELSE '' END AS reason,
       COUNT(*) AS records FROM lines GROUP BY 1""")
def timestamp_range_rule(spark, sf):
    return _reasons(spark, sf, "timestamp_range")


@query("timestamp_order_rule", LINES_CTE + """
SELECT CASE WHEN o_orderdate > l_shipdate THEN 'ts_order:o_orderdate>l_shipdate' ELSE '' END AS reason,
       COUNT(*) AS records FROM lines GROUP BY 1""")
def timestamp_order_rule(spark, sf):
    return _reasons(spark, sf, "timestamp_order")


@query("reject_reasons", LINES_CTE + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, reason AS reject_reason FROM flagged WHERE reason <> ''
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'duplicate_pk' FROM ranked WHERE rn > 1""")
def reject_reasons(spark, sf):
    rejects = rules.run_row_checks(_staged_lines(spark, sf), RULES).rejects_df
    return rejects.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("_reject_reason").alias("reject_reason")
    )


@query("validated_rows", LINES_CTE + f"SELECT {', '.join(COLUMNS)} FROM ranked WHERE rn = 1")
def validated_rows(spark, sf):
    return rules.run_row_checks(order_lines(spark, sf), RULES).good_df


@query("reject_counts", LINES_CTE + """
SELECT reason, COUNT(*) AS records FROM (
  SELECT reason FROM flagged WHERE reason <> '' UNION ALL SELECT 'duplicate_pk' FROM ranked WHERE rn > 1) GROUP BY 1""")
def reject_counts(spark, sf):
    return rules.reject_counts(rules.run_row_checks(_staged_lines(spark, sf), RULES))


@query("validation_summary", LINES_CTE + f"""
SELECT 'order_lines' AS dataset, (SELECT COUNT(*) FROM ranked WHERE rn = 1) AS kept,
       (SELECT COUNT(*) FROM lines) - (SELECT COUNT(*) FROM ranked WHERE rn = 1) AS rejected,
       {rounded('100.0 * ((SELECT COUNT(*) FROM lines) - (SELECT COUNT(*) FROM ranked WHERE rn = 1)) / (SELECT COUNT(*) FROM lines)')} AS rejection_rate_pct""")
def validation_summary(spark, sf):
    return rules.validation_summary(rules.run_row_checks(_staged_lines(spark, sf), RULES), "order_lines")


@query("validation_summary_all", LINES_CTE + f""", outcomes AS (
  SELECT 'order_lines' AS dataset, (SELECT COUNT(*) FROM ranked WHERE rn = 1) AS kept, (SELECT COUNT(*) FROM lines) AS total
  UNION ALL SELECT 'first_lines', (SELECT COUNT(*) FROM ranked WHERE rn = 1 AND l_linenumber = 1), (SELECT COUNT(*) FROM lines WHERE l_linenumber = 1)
), counted AS (SELECT * FROM outcomes UNION ALL SELECT 'total', SUM(kept), SUM(total) FROM outcomes)
SELECT dataset, CAST(kept AS BIGINT) AS kept, CAST(total - kept AS BIGINT) AS rejected, {rounded('100.0 * (total - kept) / total')} AS rejection_rate_pct FROM counted""")
def validation_summary_all(spark, sf):
    lines = _staged_lines(spark, sf)
    frames = {"order_lines": lines, "first_lines": lines.filter("l_linenumber = 1")}
    return rules.validation_summaries({name: rules.run_row_checks(frame, RULES) for name, frame in frames.items()})


FIRST_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem) WHERE rn {}"""


def _keyed(spark, sf):
    return s.table(spark, sf, "lineitem").select(*KEY, "l_partkey", "l_suppkey", "l_quantity")


@query("first_row_per_key", FIRST_SQL.format("= 1"))
def first_row_per_key(spark, sf):
    return keys.first_per_key(_keyed(spark, sf), KEY)


@query("repeated_rows_per_key", FIRST_SQL.format("> 1"))
def repeated_rows_per_key(spark, sf):
    return keys.repeats_per_key(_keyed(spark, sf), KEY)


@query("repeated_rows_per_hot_key", """
SELECT event_type, event_id FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events) WHERE rn > 1""")
def repeated_rows_per_hot_key(spark, sf):
    """Five keys hold all rows: the salted ranking has to agree with a plain one."""
    return keys.repeats_per_key(s.events(spark, sf).select("event_type", "event_id"), ["event_type"])


@query("distinct_by_key", """
SELECT l_orderkey, MIN(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1""")
def distinct_by_key(spark, sf):
    return keys.first_per_key(s.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"])


# Early shipments stand for the existing table, later ones for the update.
UPSERT_CTE = """WITH target AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'),
source AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01') WHERE rn = 1)
SELECT s.* FROM source s WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)"""


def _shipped(spark, sf, condition: str):
    return s.table(spark, sf, "lineitem").filter(condition).select(*KEY, "l_partkey", "l_suppkey", "l_quantity")


@query("insert_only_upsert", UPSERT_CTE)
def insert_only_upsert(spark, sf):
    target = _shipped(spark, sf, "l_shipdate < TIMESTAMP_NTZ '1999-01-01'")
    source = _shipped(spark, sf, "l_shipdate >= TIMESTAMP_NTZ '1998-01-01'")
    return rows_to_insert(source, target, KEY)


@query("customers_without_pending_orders", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')""")
def customers_without_pending_orders(spark, sf):
    source = s.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    orders = s.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    target = orders.select(F.col("o_custkey").alias("key"))
    return rows_to_insert(source, target, ["key"]).withColumnRenamed("key", "c_custkey")


@query("align_to_existing", """
SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(p_retailprice AS VARCHAR) AS new_price FROM part""")
def align_to_existing(spark, sf):
    part = s.table(spark, sf, "part")
    update = part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_retailprice").cast("string").alias("new_price"),
    )
    existing = part.select("p_partkey", F.col("p_size").cast("double").alias("p_size")).schema
    return align_to(update, existing)


# --- equality with evidence -----------------------------------------------------------------------------------------

VERSIONS_CTE = """WITH original AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month, l_quantity
  FROM lineitem),
corrected AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, ship_month,
         CASE WHEN l_orderkey % 1000 = 7 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity
  FROM original WHERE NOT (l_orderkey % 1500 = 11 AND l_linenumber = 1)),
differing AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, ship_month, l_quantity, CAST(sum(n) AS BIGINT) AS surplus
  FROM (SELECT *, 1 AS n FROM original UNION ALL SELECT *, -1 AS n FROM corrected)
  GROUP BY l_orderkey, l_linenumber, l_returnflag, ship_month, l_quantity HAVING sum(n) <> 0)
"""


def _versions(spark, sf):
    """Order lines, and a version of them with some quantities changed and some lines gone."""
    lines = s.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.trunc("l_shipdate", "MM").alias("ship_month"), "l_quantity"
    )
    changed = F.when(F.col("l_orderkey") % 1000 == 7, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    kept = lines.filter(~((F.col("l_orderkey") % 1500 == 11) & (F.col("l_linenumber") == 1)))
    return lines, kept.withColumn("l_quantity", changed)


@query(
    "differing_partitions_of_two_versions",
    VERSIONS_CTE
    + """SELECT m.ship_month, (SELECT count(*) FROM original o WHERE o.ship_month = m.ship_month) AS left_rows,
       (SELECT count(*) FROM corrected c WHERE c.ship_month = m.ship_month) AS right_rows
FROM (SELECT DISTINCT ship_month FROM differing) m""",
)
def differing_partitions_of_two_versions(spark, sf):
    return compare.differing_partitions(*_versions(spark, sf), ["ship_month"])


@query("rows_that_differ_in_two_versions", VERSIONS_CTE + "SELECT * FROM differing")
def rows_that_differ_in_two_versions(spark, sf):
    found = compare.differences_by_partition(*_versions(spark, sf), ["ship_month"])
    return found.withColumnRenamed("_surplus", "surplus").withColumn("surplus", F.col("surplus").cast("long"))
