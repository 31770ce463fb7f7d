"""Filters, expressions and scalar functions."""

from pyspark.sql import functions as F

from ...functions import arrays
from ...functions import scalars as sc
from ...operators.ordered import exact_quantiles
from ...operators.relational import fill_from_lookup, keep_values, scale_unit
from ..registry import Tables, query


@query("p1_in_list_filter", "SELECT event_id FROM events WHERE event_type IN ('click', 'view', 'error')")
def p1(t: Tables):
    return keep_values(t.events, "event_type", ["click", "view", "error"]).select("event_id")


@query("p2_equality_filter", "SELECT p_partkey, p_name FROM part WHERE p_type = 'SMALL'")
def p2(t: Tables):
    return t.part.where(F.col("p_type") == "SMALL").select("p_partkey", "p_name")


@query(
    "p3_range_keeps_missing",
    """SELECT count(*) AS n, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing FROM
       (SELECT nullif(l_quantity, 50) AS v FROM lineitem) WHERE v IS NULL OR (v BETWEEN 5 AND 45 AND v <> 17)""",
)
def p3(t: Tables):
    df = t.lineitem.select(F.nullif("l_quantity", F.lit(50.0)).alias("v"))
    kept = df.where(sc.missing_or("v", F.col("v").between(5, 45) & (F.col("v") != 17)))
    return kept.agg(F.count("*").alias("n"), F.count_if(F.col("v").isNull()).alias("missing"))


@query("p4_drop_failed_readings", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def p4(t: Tables):
    return t.customer.where("c_acctbal > 0").select("c_custkey", "c_acctbal")


@query(
    "p5_two_populations_in_one_pass",
    """SELECT count(*) FILTER (WHERE value > 10) AS n_high, count(*) FILTER (WHERE NOT value > 10) AS n_low,
              round(avg(value) FILTER (WHERE value > 10), 6) AS mean_high,
              round(avg(value) FILTER (WHERE NOT value > 10), 6) AS mean_low FROM events""",
)
def p5(t: Tables):
    high = F.col("value") > 10
    return t.events.agg(
        F.count_if(high).alias("n_high"),
        F.count_if(~high).alias("n_low"),
        F.round(F.avg(F.when(high, F.col("value"))), 6).alias("mean_high"),
        F.round(F.avg(F.when(~high, F.col("value"))), 6).alias("mean_low"),
    )


@query(
    "p6_sentinel_to_missing",
    """SELECT l_linenumber, count(nullif(l_discount, 0.0)) AS known, round(avg(nullif(l_discount, 0.0)), 6) AS mean
       FROM lineitem GROUP BY l_linenumber""",
)
def p6(t: Tables):
    v = sc.sentinel_to_null("l_discount", 0.0)
    return t.lineitem.groupBy("l_linenumber").agg(F.count(v).alias("known"), F.round(F.avg(v), 6).alias("mean"))


@query(
    "p7_recode_values",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'urgent'
              ELSE o_orderpriority END AS priority, count(*) AS n FROM orders GROUP BY priority""",
)
def p7(t: Tables):
    p = sc.recode("o_orderpriority", {"1-URGENT": "urgent", "2-HIGH": "urgent"})
    return t.orders.groupBy(p.alias("priority")).agg(F.count("*").alias("n"))


@query("p8_derived_flag", "SELECT p_partkey, p_size >= 25 AS is_large FROM part")
def p8(t: Tables):
    return t.part.select("p_partkey", (F.col("p_size") >= 25).alias("is_large"))


@query(
    "p9_right_closed_bands",
    """SELECT p_partkey, CASE WHEN p_size > 5 AND p_size <= 10 THEN 'small' WHEN p_size > 10 AND p_size <= 30
       THEN 'middle' WHEN p_size > 30 AND p_size <= 45 THEN 'large' END AS band FROM part""",
)
def p9(t: Tables):
    return t.part.select("p_partkey", sc.band("p_size", [5, 10, 30, 45], ["small", "middle", "large"]).alias("band"))


@query("p10_fixed_width_bins", "SELECT p_partkey, CAST(floor(p_size / 10.0) * 10 AS BIGINT) AS decade FROM part")
def p10(t: Tables):
    return t.part.select("p_partkey", sc.floor_bin("p_size", 10).alias("decade"))


@query(
    "p11_generalise_and_drop",
    """SELECT c_nationkey, c_mktsegment, CAST(floor(c_acctbal / 2000.0) * 2000 AS BIGINT) AS c_acctbal FROM customer""",
)
def p11(t: Tables):
    from ...operators.privacy import generalise

    return generalise(t.customer, {"c_acctbal": 2000}, ["c_custkey", "c_name"])


@query(
    "p12_point_classes",
    """SELECT CASE WHEN x IS NULL THEN 'no es un par de coordenadas' WHEN x = 0 AND y = 0 THEN 'origen'
              WHEN x = 0 THEN 'eje Y en ' || y WHEN y = 0 THEN 'eje X en ' || x
              ELSE 'punto (' || x || ', ' || y || ')' END AS what, count(*) AS n
       FROM (SELECT nullif(l_linenumber - 1, 6) AS x, CAST(round(l_tax * 100) AS INTEGER) AS y FROM lineitem)
       GROUP BY what""",
)
def p12(t: Tables):
    x = F.nullif(F.col("l_linenumber") - 1, F.lit(6))
    y = F.round(F.col("l_tax") * 100).cast("int")
    return t.lineitem.groupBy(sc.describe_point(x, y).alias("what")).agg(F.count("*").alias("n"))


@query("p13_vector_arithmetic", "SELECT o_orderkey, round(sqrt(o_totalprice) * 2 + 1, 6) AS z FROM orders")
def p13(t: Tables):
    return t.orders.select("o_orderkey", F.round(F.sqrt("o_totalprice") * 2 + 1, 6).alias("z"))


@query("p14_flag_as_number", "SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS is_building FROM customer")
def p14(t: Tables):
    return t.customer.select("c_custkey", sc.flag(F.col("c_mktsegment") == "BUILDING").alias("is_building"))


@query(
    "p15_clip_and_truncate",
    "SELECT c_custkey, CAST(trunc(least(greatest(c_acctbal, 0.0), 5000.0)) AS INTEGER) AS clipped FROM customer",
)
def p15(t: Tables):
    return t.customer.select("c_custkey", sc.clip_int("c_acctbal", 0.0, 5000.0).alias("clipped"))


@query(
    "p16_chained_steps",
    """SELECT segment, count(*) AS n, round(avg(c_acctbal), 4) AS mean FROM
       (SELECT lower(c_mktsegment) AS segment, c_acctbal FROM customer WHERE c_acctbal BETWEEN 0 AND 8000)
       GROUP BY segment""",
)
def p16(t: Tables):
    def lowered(df):
        return df.withColumn("segment", F.lower("c_mktsegment"))

    def plausible(df):
        return df.where(F.col("c_acctbal").between(0, 8000))

    def grouped(df):
        return df.groupBy("segment").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"))

    return t.customer.transform(lowered).transform(plausible).transform(grouped)


@query(
    "p17_fill_after_lookup",
    """WITH m AS (SELECT c_nationkey, avg(c_acctbal) AS m FROM customer WHERE c_nationkey < 15 GROUP BY c_nationkey)
       SELECT s_suppkey, round(coalesce(m, (SELECT avg(c_acctbal) FROM customer)), 6) AS m
       FROM supplier LEFT JOIN m ON s_nationkey = c_nationkey""",
)
def p17(t: Tables):
    means = t.customer.where("c_nationkey < 15").groupBy(F.col("c_nationkey").alias("s_nationkey"))
    whole = t.customer.agg(F.avg("c_acctbal")).scalar()
    out = fill_from_lookup(t.supplier, means.agg(F.avg("c_acctbal").alias("m")), ["s_nationkey"], "m", whole)
    return out.select("s_suppkey", F.round("m", 6).alias("m"))


# ---- scalar functions -----------------------------------------------------------------------------


@query(
    "f1_safe_int_parse",
    """SELECT role, count(*) AS n, count(v) AS parsed, coalesce(sum(v), 0)::BIGINT AS total FROM
       (SELECT role, TRY_CAST(CASE WHEN regexp_matches(w, '^\\s*[+-]?[0-9]+\\s*$') THEN w END AS INTEGER) AS v FROM
         (SELECT role, CASE WHEN turn % 2 = 0 THEN ' ' || CAST(turn AS VARCHAR) || ' ' ELSE text END AS w
          FROM conversations)) GROUP BY role""",
)
def f1(t: Tables):
    w = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" "), F.col("turn").cast("string"), F.lit(" "))).otherwise(F.col("text"))
    v = sc.parse_int(w)
    return t.conversations.groupBy("role").agg(
        F.count("*").alias("n"), F.count(v).alias("parsed"), F.coalesce(F.sum(v), F.lit(0)).alias("total")
    )


def _odd_numbers(t: Tables):
    """Balances as text: some with a decimal comma, some 'nan', some empty."""
    text = F.col("c_acctbal").cast("string")
    k = F.col("c_custkey") % 10
    odd = F.when(k == 0, F.translate(text, ".", ",")).when(k == 1, "nan").when(k == 2, "").otherwise(text)
    return t.customer.select("c_custkey", odd.alias("shown"))


ODD_SQL = """o AS (SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN replace(CAST(c_acctbal AS VARCHAR), '.', ',')
             WHEN 1 THEN 'nan' WHEN 2 THEN '' ELSE CAST(c_acctbal AS VARCHAR) END AS shown FROM customer)"""


@query(
    "f2_coerce_to_number",
    f"""WITH {ODD_SQL}, n AS (SELECT shown, CASE WHEN shown <> 'nan' THEN TRY_CAST(shown AS DOUBLE) END AS v FROM o)
        SELECT count(*) AS n, count(v) AS numeric_n, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END)::BIGINT AS non_numeric,
               round(sum(v), 2) AS total FROM n""",
)
def f2(t: Tables):
    v = sc.parse_number("shown")
    return _odd_numbers(t).agg(
        F.count("*").alias("n"),
        F.count(v).alias("numeric_n"),
        F.count_if(v.isNull() & F.col("shown").isNotNull()).alias("non_numeric"),
        F.round(F.sum(v), 2).alias("total"),
    )


@query(
    "f3_decimal_comma",
    f"""WITH {ODD_SQL} SELECT c_custkey, CASE WHEN shown <> 'nan' THEN TRY_CAST(replace(shown, ',', '.') AS DOUBLE)
        END AS v FROM o""",
)
def f3(t: Tables):
    return _odd_numbers(t).select("c_custkey", sc.decimal_comma("shown").alias("v"))


@query(
    "f4_tolerant_equality",
    """SELECT sum(CASE WHEN abs(a - b) <= 1e-9 * greatest(abs(a), abs(b)) THEN 1 ELSE 0 END)::BIGINT AS close_n,
              count(*) AS n FROM (SELECT l_extendedprice * (1 - l_discount) AS a,
              l_extendedprice - l_extendedprice * l_discount + CASE WHEN l_linenumber = 1 THEN 0.001 ELSE 0 END AS b
              FROM lineitem)""",
)
def f4(t: Tables):
    a = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    b = F.col("l_extendedprice") - F.col("l_extendedprice") * F.col("l_discount")
    b = b + F.when(F.col("l_linenumber") == 1, 0.001).otherwise(0.0)
    return t.lineitem.agg(F.count_if(sc.close_to(a, b)).alias("close_n"), F.count("*").alias("n"))


@query("f5_characters_and_bytes", "SELECT doc_id, length(text) AS chars, strlen(text) AS bytes FROM documents")
def f5(t: Tables):
    return t.documents.select("doc_id", F.char_length("text").alias("chars"), F.octet_length("text").alias("bytes"))


@query("f6_first_listed_item", "SELECT p_partkey, trim(split_part(p_name, ' ', 1)) AS first_word FROM part")
def f6(t: Tables):
    return t.part.select("p_partkey", sc.first_item("p_name", " ").alias("first_word"))


@query(
    "f7_rounding",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_quantity / 4, 1) AS half_even,
              round(l_quantity / 4, 1) AS half_up FROM lineitem""",
)
def f7(t: Tables):
    q = F.col("l_quantity") / 4
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        sc.round_even(q, 1).alias("half_even"), F.round(q, 1).alias("half_up"),
    )


@query(
    "f8_set_fingerprint",
    """SELECT o_custkey, substr(sha256(string_agg(status, '|' ORDER BY status)), 1, 16) AS fingerprint FROM
       (SELECT DISTINCT o_custkey, o_orderpriority AS status FROM orders) GROUP BY o_custkey""",
)
def f8(t: Tables):
    sets = t.orders.groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("items"))
    return sets.select("o_custkey", sc.set_fingerprint("items").alias("fingerprint"))


@query("f9_date_minus_days", "SELECT p_partkey, CAST(DATE '2026-01-01' - CAST(p_size * 365 AS INTEGER) AS DATE) AS born FROM part")
def f9(t: Tables):
    return t.part.select("p_partkey", sc.birth_date("2026-01-01", F.col("p_size") * 365).alias("born"))


@query(
    "f10_logistic_score",
    """SELECT event_id, round(1 / (1 + exp(-(-2.75 + 0.95 * (value - 9) / 6))), 6) AS score FROM events""",
)
def f10(t: Tables):
    z = F.lit(-2.75) + 0.95 * (F.col("value") - 9) / 6
    return t.events.select("event_id", F.round(sc.logistic(z), 6).alias("score"))


@query(
    "f11_array_algebra",
    """SELECT vec_id, len(embedding) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS first_item,
              round(CAST(embedding[len(embedding)] AS DOUBLE), 6) AS last_item,
              round(list_sum(CAST(embedding AS DOUBLE[])) * 3, 5) AS tripled, true AS same
       FROM embeddings""",
)
def f11(t: Tables):
    e = F.transform("embedding", lambda x: x.cast("double"))
    tripled = arrays.add(e, arrays.scale(e, 2.0))
    return t.embeddings.select(
        "vec_id",
        F.size("embedding").alias("n"),
        F.round(arrays.item(e, 0), 6).alias("first_item"),
        F.round(arrays.item(e, -1), 6).alias("last_item"),
        F.round(arrays.total(tripled), 5).alias("tripled"),
        arrays.equal(F.slice(e, 1, 3), F.slice(e, 1, 3)).alias("same"),
    )


@query(
    "f12_mojibake_repair",
    """SELECT lang, count(*) AS n, sum(CASE WHEN strlen(text) > length(text) THEN 1 ELSE 0 END)::BIGINT AS broken,
              count(*) AS restored FROM documents GROUP BY lang""",
)
def f12(t: Tables):
    # whole texts, read wrongly on purpose: UTF-8 bytes taken as one-byte characters
    wrong = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return t.documents.groupBy("lang").agg(
        F.count("*").alias("n"),
        F.count_if(sc.is_mojibake(wrong)).alias("broken"),
        F.count_if(sc.repair_mojibake(wrong) == F.col("text")).alias("restored"),
    )


@query(
    "f13_unit_scale",
    """SELECT p_partkey, round((p_retailprice - lo) / (hi - lo), 6) AS p_retailprice FROM part,
       (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)""",
)
def f13(t: Tables):
    out = scale_unit(t.part.select("p_partkey", "p_retailprice"), "p_retailprice")
    return out.withColumn("p_retailprice", F.round("p_retailprice", 6))


@query(
    "f13b_unit_scale_per_group",
    """SELECT event_id, round(CASE WHEN hi = lo THEN 0.0 ELSE (value - lo) / (hi - lo) END, 6) AS value FROM events
       JOIN (SELECT user_id, min(value) AS lo, max(value) AS hi FROM events GROUP BY user_id) USING (user_id)""",
)
def f13b(t: Tables):
    df = t.events.select("event_id", "user_id", "value")
    out = scale_unit(df, "value", by=["user_id"])
    return out.select("event_id", F.round("value", 6).alias("value"))


@query("f14_bits_to_single_out", "SELECT event_type, round(log2(count(*)), 6) AS bits FROM events GROUP BY event_type")
def f14(t: Tables):
    return t.events.groupBy("event_type").agg(F.round(sc.bits(F.count("*")), 6).alias("bits"))


@query(
    "x4_column_functions",
    """SELECT lang, round(avg(w), 6) AS mean_words, round(quantile_cont(w, 0.9), 6) AS p90 FROM
       (SELECT lang, length(text) - length(replace(text, ' ', '')) + 1 AS w FROM documents) GROUP BY lang""",
)
def x4(t: Tables):
    def words(c):
        return F.char_length(c) - F.char_length(F.replace(c, F.lit(" "), F.lit(""))) + 1

    df = t.documents.select("lang", words(F.col("text")).alias("w"))
    q = exact_quantiles(df, "w", {"p90": 0.9}, ["lang"])
    means = df.groupBy("lang").agg(F.round(F.avg("w"), 6).alias("mean_words"))
    return means.join(q, "lang").select("lang", "mean_words", F.round("p90", 6).alias("p90"))
