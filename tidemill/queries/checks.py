"""Data-quality rules, quarantine and replay over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..quality import (
    Check,
    NotNull,
    Range,
    Unique,
    evaluate_rules,
    quarantine,
    read_quarantine,
    replay,
    scorecard,
    split_by_rules,
)
from ..session import shared_path
from .registry import query, rounded, table


def _customers(spark, sf):
    """Customers with nulls put in: the given tables have none."""
    return table(spark, sf, "customer").withColumns(
        {
            "segment": F.nullif("c_mktsegment", F.lit("BUILDING")),
            "balance": F.when(F.col("c_nationkey") == 7, F.lit("NaN").cast("double")).when(
                F.col("c_nationkey") != 3, F.col("c_acctbal")
            ),
        }
    )


@query(
    "dq_not_null",
    """
    WITH n AS (SELECT count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS a, count(*) FILTER (WHERE c_nationkey IN (3, 7)) AS b
               FROM customer)
    SELECT 'filled' AS rule, a + b = 0 AS passed, a + b AS violations,
           'Null values detected: {''segment'': ' || a || ', ''balance'': ' || b || '}' AS message FROM n
    UNION ALL SELECT 'named', true, 0, ''
    """,
)
def dq_not_null(spark, sf):
    rules = [NotNull("filled", ["segment", "balance"]), NotNull("named", ["c_custkey", "c_name"])]
    return evaluate_rules(_customers(spark, sf), rules)


@query(
    "dq_unique",
    """
    WITH l AS (SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n FROM lineitem)
    SELECT 'line' AS rule, n = 0 AS passed, n AS violations,
           CASE WHEN n = 0 THEN '' ELSE 'Duplicate rows detected: ' || n END AS message FROM l
    """,
)
def dq_unique(spark, sf):
    return evaluate_rules(table(spark, sf, "lineitem"), [Unique("line", ["l_orderkey", "l_linenumber"])])


@query(
    "dq_range",
    """
    WITH n AS (SELECT count(*) FILTER (WHERE c_acctbal < 0) + count(*) FILTER (WHERE c_acctbal > 9000) AS v
               FROM customer WHERE c_nationkey NOT IN (3, 7))
    SELECT 'balance' AS rule, v = 0 AS passed, v AS violations, 'Range violations detected: ' || v || ' rows' AS message FROM n
    """,
)
def dq_range(spark, sf):
    return evaluate_rules(_customers(spark, sf), [Range("balance", "balance", 0, 9000)])


@query(
    "dq_custom_expr",
    """
    WITH n AS (SELECT count(*) FILTER (WHERE NOT (l_extendedprice >= l_quantity * 900)) AS v FROM lineitem)
    SELECT 'price' AS rule, v = 0 AS passed, v AS violations,
           CASE WHEN v = 0 THEN '' ELSE 'Condition violations detected: ' || v || ' rows' END AS message FROM n
    """,
)
def dq_custom_expr(spark, sf):
    return evaluate_rules(table(spark, sf, "lineitem"), [Check("price", "l_extendedprice >= l_quantity * 900")])


@query(
    "dq_engine",
    """
    WITH d AS (SELECT *, nullif(lang, 'fr') AS language FROM documents),
         v AS (SELECT 'language' AS rule, count(*) FILTER (WHERE language IS NULL) AS violations FROM d
               UNION ALL SELECT 'text_once', count(*) - count(DISTINCT text) - max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) FROM d
               UNION ALL SELECT 'size', count(*) FILTER (WHERE n_chars < 20) + count(*) FILTER (WHERE n_chars > 20000) FROM d
               UNION ALL SELECT 'language_once', count(*) - count(DISTINCT coalesce(language, '?') || '/' || coalesce(source, '?')) FROM d
               UNION ALL SELECT 'counted', count(*) FILTER (WHERE n_chars <> length(text)) FROM d)
    SELECT rule, violations = 0 AS passed, violations FROM v
    """,
)
def dq_engine(spark, sf):
    documents = table(spark, sf, "documents").withColumn("language", F.nullif("lang", F.lit("fr")))
    rules = [
        NotNull("language", ["language"]),
        Unique("text_once", ["text"]),
        Range("size", "n_chars", 20, 20000),
        Unique("language_once", ["language", "source"]),
        Check("counted", "n_chars = length(text)"),
    ]
    return evaluate_rules(documents, rules).drop("message")


@query(
    "quarantine_dataset",
    """
    SELECT event_id, user_id, event_type, value, 'late feed' AS reason, 'run-7' AS run_id, true AS stamped FROM events
    """,
)
def quarantine_dataset(spark, sf):
    path = shared_path(spark, "quarantine")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    quarantine(events, path, "late feed", "run-7")
    back = read_quarantine(spark, path, events.schema, "run-7")
    return back.select("event_id", "user_id", "event_type", "value", "reason", "run_id", F.col("quarantined_at").isNotNull().alias("stamped"))


_ORDER_RULES = [
    Range("price", "o_totalprice", 1000, 400000),
    Check("known_status", "o_orderstatus IN ('F', 'O')"),
    NotNull("priority", ["o_orderpriority"]),
]
_BROKEN = """(coalesce(o_totalprice < 1000 OR o_totalprice > 400000, false) OR coalesce(o_orderstatus = 'P', false)
              OR o_orderpriority = '5-LOW' OR o_orderpriority IS NULL)"""


def _rule_orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )


@query(
    "dq_split_valid",
    f"SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE NOT {_BROKEN}",
)
def dq_split_valid(spark, sf):
    return split_by_rules(_rule_orders(spark, sf), _ORDER_RULES)[0]


@query(
    "dq_split_reject",
    f"""
    SELECT o_orderkey, o_totalprice, o_orderstatus,
           concat_ws(',', CASE WHEN o_totalprice < 1000 OR o_totalprice > 400000 THEN 'price' END,
                     CASE WHEN o_orderstatus = 'P' THEN 'known_status' END,
                     CASE WHEN o_orderpriority = '5-LOW' OR o_orderpriority IS NULL THEN 'priority' END) AS failed_rules
    FROM orders WHERE {_BROKEN}
    """,
)
def dq_split_reject(spark, sf):
    return split_by_rules(_rule_orders(spark, sf), _ORDER_RULES)[1].drop("o_orderpriority")


@query(
    "quarantine_replay",
    """
    SELECT DISTINCT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus FROM orders
    WHERE coalesce(o_totalprice BETWEEN 1000 AND 400000, true)
    """,
)
def quarantine_replay(spark, sf):
    rules = _ORDER_RULES[:2]
    orders = _rule_orders(spark, sf).drop("o_orderpriority")
    valid, rejected = split_by_rules(orders, rules)
    path = shared_path(spark, "replay")
    quarantine(rejected, path, "record_rules", "run-1", "failed_rules")
    held = read_quarantine(spark, path, orders.schema, "run-1")

    def correct(df):
        status = F.col("o_orderstatus")
        return df.withColumn("o_orderstatus", F.when(status == "P", "O").otherwise(status))

    merged, _ = replay(held, correct, rules, valid, "o_orderkey")
    return merged


@query(
    "dq_scorecard",
    """
    WITH s AS (SELECT o_orderstatus, count(*) AS rows,
                      count(*) FILTER (WHERE o_totalprice < 1000 OR o_totalprice > 400000) AS p,
                      count(*) FILTER (WHERE o_orderpriority = '5-LOW' OR o_orderpriority IS NULL) AS q FROM orders GROUP BY 1)
    SELECT o_orderstatus, 'price' AS rule, rows, p AS violations, round(1 - p / rows, 6) AS pass_rate FROM s
    UNION ALL SELECT o_orderstatus, 'priority', rows, q, round(1 - q / rows, 6) FROM s
    """,
)
def dq_scorecard(spark, sf):
    out = scorecard(_rule_orders(spark, sf), [_ORDER_RULES[0], _ORDER_RULES[2]], "o_orderstatus")
    return rounded(out, "pass_rate", digits=6)
