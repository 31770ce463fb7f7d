"""Reading, writing and looking at plans."""

from pyspark.sql import functions as F

from ...functions.scalars import repair_mojibake
from ...operators.quality import inject_defects
from ...operators.relational import word_counts
from ...session import scratch_path, written
from ...sources import tables as src
from ...sources import text
from ...sources.sql import sql_over
from ..registry import Tables, query
from ..report import plan_report

PART_SCHEMA = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
)


@query("s1_parquet_scan", "SELECT * FROM part")
def s1(t: Tables):
    return src.scan(t.spark, t.path("part"), schema=PART_SCHEMA)


@query(
    "s2_pruned_scan",
    """SELECT l_returnflag, count(*) AS n, round(avg(l_tax), 6) AS mean_tax
       FROM lineitem GROUP BY l_returnflag""",
)
def s2(t: Tables):
    df = src.scan(t.spark, t.path("lineitem"), columns=["l_returnflag", "l_tax"])
    return df.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("l_tax"), 6).alias("mean_tax"))


@query(
    "s3_glob_scan",
    """SELECT l_linenumber, round(avg(l_quantity), 6) AS mean_quantity, count(*) AS n
       FROM lineitem GROUP BY l_linenumber""",
)
def s3(t: Tables):
    base = scratch_path(t.spark, "parts")  # the same rows in several datasets, read by one glob
    for part in range(3):
        t.lineitem.where(F.pmod(F.col("l_orderkey"), F.lit(3)) == part).write.parquet(f"{base}/part-{part}")
    df = src.scan(t.spark, f"{base}/part-*")
    return df.groupBy("l_linenumber").agg(
        F.round(F.avg("l_quantity"), 6).alias("mean_quantity"), F.count("*").alias("n")
    )


def _drifting(t: Tables) -> tuple[str, str]:
    """Orders in two datasets: odd years with the date in nanoseconds, as such files hold it, and no
    priority; even years as they are, in microseconds."""
    base = scratch_path(t.spark, "drift")
    dated = t.orders.withColumn("tag", F.year("o_orderdate"))
    nanos = F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000 + 999
    odd = dated.where("tag % 2 = 1").withColumn("o_orderdate", nanos)
    src.write_partitioned(odd.drop("o_orderpriority"), f"{base}/odd", "tag")
    src.write_partitioned(dated.where("tag % 2 = 0"), f"{base}/even", "tag")
    return f"{base}/odd", f"{base}/even"


@query(
    "s4_schema_drift_union",
    """SELECT year(o_orderdate) AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total,
              sum(CASE WHEN year(o_orderdate) % 2 = 1 THEN 1 ELSE 0 END)::BIGINT AS no_priority
       FROM orders GROUP BY y""",
)
def s4(t: Tables):
    whole = src.scan_with_drift(t.spark, _drifting(t), {"o_orderdate": "timestamp_ntz"})
    return whole.groupBy(F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.count_if(F.col("o_orderpriority").isNull()).alias("no_priority"),
    )


@query(
    "s5_tag_from_file_path",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) AS tag, count(*) AS n
       FROM orders GROUP BY tag""",
)
def s5(t: Tables):
    path = scratch_path(t.spark, "years")
    src.write_partitioned(t.orders.withColumn("tag", F.year("o_orderdate")), path, "tag")
    tagged = src.scan_tagged(t.spark, path, "tag", r"tag=(\d+)")
    return tagged.groupBy("tag").agg(F.count("*").alias("n"))


CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("s6_csv_write", "SELECT * FROM customer")
def s6(t: Tables):
    path = scratch_path(t.spark, "csv")
    text.write_csv(t.customer, path)
    return text.read_csv(t.spark, path, CUSTOMER_SCHEMA)


@query(
    "s7_csv_typed_read",
    """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total,
              CAST(min(o_orderdate) AS DATE) AS first_day
       FROM orders GROUP BY o_orderstatus""",
)
def s7(t: Tables):
    path = scratch_path(t.spark, "csv")
    text.write_csv(t.orders, path)
    schema = (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    )
    back = text.read_csv(t.spark, path, schema)
    return back.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").cast("date").alias("first_day"),
    )


@query("s8_european_csv", "SELECT p_name, p_size, p_retailprice FROM part")
def s8(t: Tables):
    path = scratch_path(t.spark, "csv")
    text.write_european(t.part.select("p_name", "p_size", "p_retailprice"), path)
    return text.read_european(t.spark, path, {"p_name": "text", "p_size": "int", "p_retailprice": "decimal"})


@query(
    "s9_dirty_csv_round_trip",
    """SELECT count(*) + 25 AS n_rows, CAST(0 AS BIGINT) AS changed, sum(CASE WHEN
         (CAST('0x' || substr(md5(concat_ws('-', CAST(c_custkey AS VARCHAR), '42-gap')), 1, 8) AS BIGINT)
          / CAST(4294967296 AS DOUBLE)) < 0.02 THEN 1 ELSE 0 END)::BIGINT AS missing
       FROM customer""",
)
def s9(t: Tables):
    dirty = inject_defects(t.customer, "c_custkey", "c_acctbal", "c_mktsegment", ("MACHINERY", "MACHNERY"))
    path = scratch_path(t.spark, "csv")
    text.write_csv(dirty, path, sep=";")
    back = text.read_csv(t.spark, path, dirty.schema, sep=";")
    changed = dirty.exceptAll(back).agg(F.count("*")).scalar()
    return back.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("c_acctbal").isNull()).alias("missing")
    ).withColumn("changed", changed)


SPLIT_SQL = (
    r"regexp_split_to_array(text, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+')"
)


@query(
    "s10_encoding_and_mojibake",
    f"""WITH w AS (SELECT word, count(*) AS n FROM (SELECT unnest({SPLIT_SQL}) AS word FROM documents)
                   WHERE word <> '' GROUP BY word)
        SELECT count(*) AS words, sum(CASE WHEN strlen(word) > length(word) THEN 1 ELSE 0 END)::BIGINT
               AS mojibake, count(*) AS repaired, count(*) AS latin1_ok FROM w""",
)
def s10(t: Tables):
    words = written(word_counts(t.documents, "text"), "words")  # read five times below, counted once
    utf8, latin = scratch_path(t.spark, "utf8"), scratch_path(t.spark, "latin1")
    text.write_csv(words, utf8)
    # only words that the one-byte code can hold survive in it
    fits = F.col("word").rlike(r"^[\x{00}-\x{FF}]*$")
    text.write_csv(words.where(fits), latin, encoding="ISO-8859-1")
    wrong = text.read_csv(t.spark, utf8, "word string, n bigint", encoding="ISO-8859-1")
    right = text.read_csv(t.spark, latin, "word string, n bigint", encoding="ISO-8859-1")
    fixed = wrong.withColumn("word", repair_mojibake("word"))
    report = text.mojibake_report(wrong, "word").select(
        F.col("rows").alias("words"), F.col("mojibake_rows").alias("mojibake")
    )
    same = words.join(fixed, ["word", "n"], "left_semi").agg(F.count("*")).scalar()
    latin_same = words.where(fits).join(right, ["word", "n"], "left_semi").agg(F.count("*")).scalar()
    odd = words.where(~fits).agg(F.count("*")).scalar()
    return report.withColumn("repaired", same).withColumn("latin1_ok", latin_same + odd)


@query(
    "s11_json_round_trip",
    """SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS k_sum,
              count(*) AS kept
       FROM events GROUP BY event_type""",
)
def s11(t: Tables):
    schema = "struct<k: bigint>"
    parsed = t.events.withColumn("p", text.json_value(F.col("props"), schema))
    again = parsed.withColumn("q", text.json_value(text.json_text(F.col("p")), schema))
    return again.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.sum("p.k").alias("k_sum"),
        F.count_if(F.col("p").eqNullSafe(F.col("q"))).alias("kept"),
    )


@query(
    "s12_sql_with_bound_values",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'F'",
)
def s12(t: Tables):
    return sql_over(
        t.spark,
        """SELECT o_orderkey, o_totalprice FROM {orders}
           WHERE o_totalprice > :least AND o_orderstatus = :status ORDER BY o_totalprice DESC""",
        {"orders": t.orders},
        {"least": 400000.0, "status": "F"},
    )


@query(
    "s13_sql_joining_a_frame",
    """SELECT r_name, count(*) AS n, round(avg(c_acctbal), 3) AS mean_balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY r_name""",
)
def s13(t: Tables):
    homes = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return sql_over(
        t.spark,
        """SELECT h.r_name, count(*) AS n, round(avg(c.c_acctbal), 3) AS mean_balance
           FROM {customer} AS c JOIN {homes} AS h ON c.c_nationkey = h.n_nationkey
           GROUP BY h.r_name ORDER BY mean_balance DESC""",
        {"customer": t.customer, "homes": homes},
    )


@query("s14_csv_parquet_size_ratio")
def s14(t: Tables):
    return src.csv_parquet_ratio(t.lineitem)


@query(
    "s15_filter_and_sink",
    "SELECT count(*) AS n_rows, true AS has_bytes FROM lineitem WHERE l_returnflag = 'R'",
)
def s15(t: Tables):
    out = src.write_filtered(t.lineitem, F.col("l_returnflag") == "R", scratch_path(t.spark, "sink"))
    return out.select(F.col("rows").alias("n_rows"), (F.col("bytes") > 0).alias("has_bytes"))


def _by_flag(t: Tables) -> str:
    path = scratch_path(t.spark, "by-flag")
    src.write_partitioned(t.lineitem, path, "l_returnflag")
    return path


@query(
    "s16_partitioned_write",
    "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY l_returnflag",
)
def s16(t: Tables):
    back = src.scan(t.spark, _by_flag(t))
    return back.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query(
    "s17_partition_pruned_read",
    """SELECT count(*) AS n, round(avg(l_extendedprice), 4) AS mean_price, true AS pruned
       FROM lineitem WHERE l_returnflag = 'N'""",
)
def s17(t: Tables):
    one = src.scan(t.spark, _by_flag(t)).where(F.col("l_returnflag") == "N")
    pruned = any("l_returnflag" in f for f in plan_report(one)["partition_filters"])
    return one.agg(
        F.count("*").alias("n"),
        F.round(F.avg("l_extendedprice"), 4).alias("mean_price"),
        F.lit(pruned).alias("pruned"),
    )


@query(
    "s18_generate_once",
    """SELECT CAST(o_orderdate AS DATE) AS bucket, count(*) AS n FROM orders GROUP BY bucket""",
)
def s18(t: Tables):
    from ...operators.relational import daily_series

    path = scratch_path(t.spark, "once")

    def make():
        return daily_series(t.orders, "o_orderdate", n=F.count("*"))

    src.generate_once(t.spark, path, make)
    return src.generate_once(t.spark, path, make)  # the second call only reads


@query(
    "s19_plan_report",
    """SELECT count(*) AS n, true AS filter_pushed, true AS columns_pruned
       FROM part WHERE p_type = 'ECONOMY'""",
)
def s19(t: Tables):
    df = t.part.where(F.col("p_type") == "ECONOMY").select("p_type", "p_size")
    report = plan_report(df)
    pushed = any("EqualTo(p_type,ECONOMY)" in f for f in report["pushed_filters"])
    pruned = report["read_schema"] == ["struct<p_type:string,p_size:int>"]
    return df.agg(F.count("*").alias("n"), F.lit(pushed).alias("filter_pushed"), F.lit(pruned).alias("columns_pruned"))


@query(
    "s20_small_table_to_arrow",
    "SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type",
)
def s20(t: Tables):
    small = t.events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value")
    )
    return t.spark.createDataFrame(src.small_to_arrow(small))


@query(
    "s21_physical_types",
    """SELECT * FROM (VALUES ('c_custkey', 'bigint', 'int64'), ('c_name', 'string', 'string'),
         ('c_nationkey', 'int', 'int32'), ('c_acctbal', 'double', 'double'),
         ('c_mktsegment', 'string', 'string')) AS v(column_name, spark_type, arrow_type),
       (SELECT count(*) AS non_null FROM customer)""",
)
def s21(t: Tables):
    df = t.customer
    rows = [F.struct(*[F.lit(x).alias(n) for x, n in zip(r, ("column_name", "spark_type", "arrow_type"))],
                     F.count(r[0]).alias("non_null")) for r in src.arrow_schema(df)]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
