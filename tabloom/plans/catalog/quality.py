"""Contracts and cleaning."""

from pyspark.sql import functions as F

from ...operators import quality as q
from ..registry import Tables, md5_sql, query, uniform_sql

LINE_CONTRACT = q.Contract(
    rules=[
        q.Rule("l_quantity", 1, 49),
        q.Rule("l_discount", 0.0, 0.1),
        q.Rule("l_tax", 0.0, 0.08),
        q.Rule("l_returnflag", allowed=["A", "N"]),
    ],
    types={"l_quantity": "double", "l_linenumber": "int"},
    unique=["l_orderkey", "l_linenumber"],
)

LINE_SQL = """
SELECT 'not_null(' || c || ')' AS "check", CAST(0 AS BIGINT) AS violations
  FROM (VALUES ('l_quantity'), ('l_discount'), ('l_tax'), ('l_returnflag')) AS v(c)
UNION ALL SELECT 'in_range(l_quantity, 1, 49)', count(*) FROM lineitem WHERE l_quantity < 1 OR l_quantity > 49
UNION ALL SELECT 'in_range(l_discount, 0.0, 0.1)', count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.1
UNION ALL SELECT 'in_range(l_tax, 0.0, 0.08)', count(*) FROM lineitem WHERE l_tax < 0 OR l_tax > 0.08
UNION ALL SELECT 'isin(l_returnflag)', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL SELECT 'unique(l_orderkey, l_linenumber)', sum(n)::BIGINT FROM
  (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1"""


@query(
    "q1_receipt_check",
    """SELECT count(*) AS rows, CAST(0 AS BIGINT) AS nulls, count(DISTINCT n_nationkey) AS distinct_values FROM nation""",
)
def q1(t: Tables):
    return q.receipt_check(t.nation, rows=25, columns=3, nulls=0, distinct=("n_nationkey", 25))


@query("q2_contract_report", LINE_SQL)
def q2(t: Tables):
    return q.contract_report(t.lineitem, LINE_CONTRACT)


@query(
    "q3_quarantine",
    """WITH k AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem),
       b AS (SELECT (l_quantity > 49)::INTEGER AS a, (l_returnflag NOT IN ('A', 'N'))::INTEGER AS b, (n > 1)::INTEGER AS c FROM k)
       SELECT a + b + c AS reasons, count(*) AS n FROM b GROUP BY reasons""",
)
def q3(t: Tables):
    valid, rejected = q.quarantine(t.lineitem, LINE_CONTRACT)
    kinds = rejected.select(F.size("reasons").alias("reasons")).unionByName(valid.select(F.lit(0).alias("reasons")))
    return kinds.groupBy("reasons").agg(F.count("*").alias("n"))


@query(
    "q2b_contract_coercion",
    """WITH c AS (SELECT TRY_CAST(replace(c_name, 'Customer#', '') AS INTEGER) AS a, CASE WHEN c_custkey % 7 = 0 THEN 'n/a'
              ELSE CAST(c_acctbal AS VARCHAR) END AS b FROM customer)
       SELECT 'code' AS column_name, count(*) FILTER (WHERE a IS NULL) AS misfits FROM c
       UNION ALL SELECT 'balance', count(*) FILTER (WHERE TRY_CAST(b AS DOUBLE) IS NULL) FROM c""",
)
def q2b(t: Tables):
    texts = t.customer.select(
        F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("code"),
        F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
    )
    return q.coerce(texts, q.Contract([], types={"code": "int", "balance": "double"}))[1]


@query(
    "q3b_fail_fast_contract",
    """SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus""",
)
def q3b(t: Tables):
    contract = q.Contract([q.Rule("o_totalprice", 0.0), q.Rule("o_orderstatus", allowed=["F", "O", "P"])], unique=["o_orderkey"])
    return q.enforce(t.orders, contract).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def dirty(t: Tables):
    return q.inject_defects(t.customer, "c_custkey", "c_acctbal", "c_mktsegment", ("MACHINERY", "MACHNERY"))


DIRTY_SQL = f"""s AS (SELECT * REPLACE (CASE WHEN {uniform_sql('42-gap', 'c_custkey')} >= 0.02 THEN c_acctbal END
                      AS c_acctbal), {md5_sql('42', 'c_custkey')} AS h FROM customer),
     r AS (SELECT *, CASE WHEN c_acctbal IS NOT NULL THEN row_number() OVER (PARTITION BY c_acctbal IS NULL ORDER BY h) END AS k FROM s),
     m AS (SELECT *, CASE WHEN k > 80 AND c_mktsegment = 'MACHINERY' THEN
           row_number() OVER (PARTITION BY k > 80, c_mktsegment ORDER BY h) END AS j FROM r),
     dirty AS (SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN k <= 30 THEN replace(CAST(c_acctbal AS VARCHAR), '.', ',') WHEN k <= 45 THEN '-1.0'
                WHEN k <= 55 THEN '9999.0' ELSE CAST(c_acctbal AS VARCHAR) END AS c_acctbal,
           CASE WHEN j <= 20 THEN 'MACHNERY' ELSE c_mktsegment END AS c_mktsegment,
           unnest(CASE WHEN k > 55 AND k <= 80 THEN [0, 1] ELSE [0] END) AS copy FROM m),
     typed AS (SELECT * REPLACE (TRY_CAST(replace(c_acctbal, ',', '.') AS DOUBLE) AS c_acctbal) FROM dirty),
     cleaned AS (SELECT * REPLACE (CASE c_mktsegment WHEN 'MACHNERY' THEN 'MACHINERY' ELSE c_mktsegment END
           AS c_mktsegment) FROM typed WHERE copy = 0 AND (c_acctbal IS NULL OR
           (c_acctbal BETWEEN 0 AND 10000 AND c_acctbal <> 9999)))"""

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CUSTOMER_CONTRACT = q.Contract(
    [q.Rule("c_acctbal", 0.0, 9998.0, nullable=True), q.Rule("c_mktsegment", allowed=SEGMENTS)],
    unique=["c_custkey"],
)


def cleaned(t: Tables):
    typed = q.repair_numbers(dirty(t), "c_acctbal")
    return q.clean(
        typed, ["c_custkey"], ["copy"], {"c_mktsegment": {"MACHNERY": "MACHINERY"}}, "c_acctbal", 0.0, 10000.0, 9999.0
    )


@query(
    "q4_type_repair_report",
    f"""WITH {DIRTY_SQL} SELECT count(*) AS rows, sum(CASE WHEN c_acctbal IS NOT NULL AND
        TRY_CAST(c_acctbal AS DOUBLE) IS NULL THEN 1 ELSE 0 END)::BIGINT AS non_numeric,
        (SELECT count(*) FROM typed WHERE c_acctbal IS NULL) AS missing_after FROM dirty""",
)
def q4(t: Tables):
    return q.type_repair_report(dirty(t), "c_acctbal")


@query("q5_clean", f"WITH {DIRTY_SQL} SELECT c_custkey, c_acctbal, c_mktsegment FROM cleaned")
def q5(t: Tables):
    return cleaned(t).select("c_custkey", "c_acctbal", "c_mktsegment")


STEPS_SQL = f"""WITH {DIRTY_SQL},
        steps AS (SELECT 0 AS step_no, 'typed' AS step, * FROM typed UNION ALL SELECT 1, 'cleaned', * FROM cleaned),
        keys AS (SELECT step_no, sum(n)::BIGINT AS dup FROM (SELECT step_no, count(*) AS n FROM steps
                 GROUP BY step_no, c_custkey) WHERE n > 1 GROUP BY step_no)
        SELECT s.step_no, step, count(*) AS rows, count(*) - count(c_acctbal) AS missing,
          (sum(CASE WHEN c_acctbal < 0 OR c_acctbal > 9998 THEN 1 ELSE 0 END) + sum(CASE WHEN c_mktsegment NOT IN
          ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN 1 ELSE 0 END)
          + coalesce(max(dup), 0))::BIGINT AS violations
        FROM steps s LEFT JOIN keys k ON s.step_no = k.step_no GROUP BY s.step_no, step"""


@query("q6_step_report", STEPS_SQL)
def q6(t: Tables):
    typed = q.repair_numbers(dirty(t), "c_acctbal")
    return q.step_report({"typed": typed, "cleaned": cleaned(t)}, CUSTOMER_CONTRACT, "c_acctbal")


@query("q6b_observed_steps", STEPS_SQL)
def q6b(t: Tables):
    """The same report from one scan, observed while the cleaned table is written."""
    typed = q.repair_numbers(dirty(t), "c_acctbal")
    _, report = q.observed_clean(
        typed, ["c_custkey"], ["copy"], {"c_mktsegment": {"MACHNERY": "MACHINERY"}}, "c_acctbal", 0.0, 10000.0, 9999.0, CUSTOMER_CONTRACT
    )
    return report


@query("q7_defect_injection", f"WITH {DIRTY_SQL} SELECT c_custkey, c_acctbal, c_mktsegment, copy FROM dirty")
def q7(t: Tables):
    return dirty(t).select("c_custkey", "c_acctbal", "c_mktsegment", "copy")


@query(
    "q8_enriched_group_means",
    f"""WITH {DIRTY_SQL} SELECT band, is_high, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM
        (SELECT CASE WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 'low' WHEN c_acctbal > 2500 AND c_acctbal <= 5000
         THEN 'middle' WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 'high' END AS band, c_nationkey >= 12 AS is_high,
         c_acctbal FROM cleaned) GROUP BY band, is_high""",
)
def q8(t: Tables):
    rich = q.enrich(cleaned(t), "c_acctbal", [0, 2500, 5000, 10000], ["low", "middle", "high"], "c_nationkey", 12)
    return rich.groupBy("band", "is_high").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"))


@query(
    "x5_table_functions",
    f"""WITH {DIRTY_SQL} SELECT c_mktsegment, count(*) AS n, count(c_acctbal) AS known FROM cleaned GROUP BY c_mktsegment""",
)
def x5(t: Tables):
    return (
        dirty(t)
        .transform(q.repair_numbers, "c_acctbal")
        .transform(q.clean, ["c_custkey"], ["copy"], {"c_mktsegment": {"MACHNERY": "MACHINERY"}}, "c_acctbal", 0.0, 10000.0, 9999.0)
        .groupBy("c_mktsegment")
        .agg(F.count("*").alias("n"), F.count("c_acctbal").alias("known"))
    )
