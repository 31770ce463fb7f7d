"""URL filters: a sort-merge range join between urls and (host, path) rules.

Keys are `reversed host labels + "/" + path`, so that a rule covers one interval of keys: those
that start with its own key. A url has one key for each domain above its host, because a rule
fits its host and all subdomains. Keys and rules are sorted together, bucket by bucket; a sweep
over the order carries the stack of nested rules opened last, and those that still cover a key
are its active ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]  # host, path, verdict


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): between the first `://` and `/`, `?`, `#` or the end, then up to `?`, `#` or the end.

    A-Z of the host is lower-cased. A missing url, or one without `://`, has both empty.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark, rules: Sequence[Rule]) -> DataFrame:
    """(host, path, verdict); of rules with one host and path, a block comes before an allow."""
    table = spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")
    return table.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _rule_stacks(rules: DataFrame) -> DataFrame:
    """(key, stack): each rule with the rules around its interval and itself, by key.

    The rules around it are those whose keys are prefixes of its own, found by an equi-join
    with its prefixes of the lengths that occur.
    """
    keyed = rules.select(
        F.concat(F.array_join(_labels(F.col("host")), "."), F.lit("/"), "path").alias("key"),
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("rule"),
    )
    # one array, with as many lengths as the longest key has characters at most
    lengths = keyed.agg(F.coalesce(F.collect_set(F.length("key")), F.array().cast("array<int>")).alias("ls")).scalar()
    shorter = F.filter("ls", lambda n: n <= F.length("key"))
    prefixes = keyed.select("key", lengths.alias("ls")).select("key", F.explode(shorter).alias("l"))
    prefixes = prefixes.select("key", F.expr("substring(key, 1, l)").alias("prefix"))
    around = keyed.select(F.col("key").alias("prefix"), F.struct("key", "rule").alias("entry"))
    return prefixes.join(around, "prefix").groupBy("key").agg(F.array_sort(F.collect_list("entry")).alias("stack"))


def _cuts(keys: DataFrame, buckets: int, key_chars: int = 200, per_bucket: int = 20) -> list[str]:
    """Bucket borders from the keys with the smallest hashes: they steer balance, not results."""
    sample = keys.orderBy(F.xxhash64("key")).limit(per_bucket * buckets).select(F.substring("key", 1, key_chars))
    found = sorted(r[0] for r in sample.collect())  # at most per_bucket * buckets short strings
    return sorted({found[i * len(found) // buckets] for i in range(1, buckets)}) if found else []


def _bucket(key: Column, cuts: list[str]) -> Column:
    """Number of cuts at or below the key: found among every 64th cut, then among the 64 after it."""
    if not cuts:
        return F.lit(0)
    step = 64
    coarse = F.array(*[F.lit(c) for c in cuts[::step]])
    fine = F.array(*[F.array(*[F.lit(c) for c in cuts[i : i + step]]) for i in range(0, len(cuts), step)])
    block = F.size(F.filter(coarse, lambda c: c <= key))
    inside = F.size(F.filter(F.element_at(fine, block), lambda c: c <= key))
    return F.when(block == 0, 0).otherwise((block - 1) * step + inside)


def sweep(keys: DataFrame, rules: DataFrame, buckets: int) -> DataFrame:
    """Each key of (key, ...) with the array of rules active there, outermost first.

    A bucket holds the keys between two borders, the rules that open between them, and the stack
    that was open at its lower border.
    """
    cuts = _cuts(keys, buckets)
    stacks = _rule_stacks(rules).withColumn("bucket", _bucket(F.col("key"), cuts))
    # one row per bucket that opens a rule: the last stack of each, carried to the buckets after it
    last = stacks.groupBy("bucket").agg(F.max_by("stack", "key").alias("stack"))
    every = keys.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("int").alias("bucket"))
    carried = F.last("stack", True).over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    opening = every.join(last, "bucket", "left").select("bucket", F.lit("").alias("key"), carried.alias("stack"))
    starts = stacks.select("bucket", "key", "stack").unionByName(opening).withColumn("kind", F.lit(0))
    points = keys.withColumn("bucket", _bucket(F.col("key"), cuts)).withColumn("kind", F.lit(1))
    order = Window.partitionBy("bucket").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    merged = starts.unionByName(points, allowMissingColumns=True).withColumn("stack", F.last("stack", True).over(order))
    covering = F.filter("stack", lambda r: F.startswith(F.col("key"), r["key"]))
    found = merged.where("kind = 1").withColumn("active", F.transform(covering, lambda r: r["rule"]))
    return found.drop("stack", "kind", "bucket")


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow", buckets: int | None = None) -> DataFrame:
    """Every row of `urls` with host, path, rule and verdict; other columns than `url` are kept.

    The longest rule (host and path together, then the longer host) decides; without one, rule is
    NULL and the verdict is `default`. Host and path of a row are empty where the url is missing
    or has no `://`. Input columns called host, path, rule or verdict are replaced. Repeated rows
    are judged alike; an empty table gives an empty table; without rules all get the default.
    A url's key keeps as many host labels and path characters as the longest rule has: more can't
    change which rules fit, and the sweep then runs over few distinct keys of bounded length.
    """
    spark = urls.sparkSession
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & ~F.contains("host", F.lit("/")))
    longest = rules.agg(F.max(F.size(_labels(F.col("host")))), F.max(F.length("path"))).first()
    host, path = url_parts(F.col("url"))
    rows = urls.drop("host", "path", "rule", "verdict").select("*", host.alias("host"), path.alias("path"))
    if longest[0] is None:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    names = {"__labels": F.slice(_labels(F.col("host")), 1, longest[0]), "__start": F.substring("path", 1, longest[1])}
    points = urls.select(host.alias("host"), path.alias("path")).withColumns(names).select(*names).distinct()
    each = F.explode(F.sequence(F.lit(1), F.size("__labels"))).alias("level")
    keys = points.select("*", each).select(
        *names, F.concat(F.array_join(F.slice("__labels", 1, F.col("level")), "."), F.lit("/"), "__start").alias("key")
    )
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    swept = sweep(keys, rules, buckets).select(*names, F.array_max("active").alias("best"))
    best = swept.groupBy(*names).agg(F.max("best").alias("__best")).where("__best is not null")
    # written, so that Spark knows its size when it chooses between broadcast and shuffle
    found = written(best.select(*names, F.col("__best.rule").alias("rule"), F.col("__best.verdict").alias("verdict")))
    joined = rows.withColumns(names).join(found, list(names), "left").drop(*names)
    return joined.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
