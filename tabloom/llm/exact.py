"""Exact dedup by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered,
so a block's name is an integer that only equal blocks share. Then neighbouring names are paired,
the distinct pairs are sorted and numbered in turn, and so on until each document has one name.
No step takes a hash for the content: a 64-bit sort key finds the name of a block, and contents
that share a key with others are looked up as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .names import fresh

BLOCK_BYTES = 4096
ROW = ["doc_id", "sha"]  # what tells documents apart: rows that repeat both are one document
APART = 1 << 62  # names at or above this belong to contents that share a sort key


def _body() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def _sha() -> Column:
    return F.unhex(F.sha2(_body(), 256))


def _blocks(body: Column, size: int) -> Column:
    """The text's blocks; an empty text is one empty block."""
    last = F.greatest(F.ceil(F.octet_length(body) / size) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(body, i * size + 1, F.lit(size)))


def _numbered(keyed: DataFrame, content: list[str]) -> DataFrame:
    """Number the distinct contents in sorted order; a task that runs again gives the same numbers."""
    ordered = keyed.select("key", *content).distinct().sortWithinPartitions("key", *content)
    return ordered.withColumn("name", F.monotonically_increasing_id())


def _name(keyed: DataFrame, content: list[str]) -> DataFrame:
    """Replace `key` and the content columns by `name`."""
    names = written(_numbered(keyed, content).select("key", "name"), "names")
    shared = names.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    if shared.isEmpty():
        return keyed.drop(*content).join(names, "key").drop("key")
    shared = written(shared, "keys")
    apart = _numbered(keyed.join(shared, "key", "left_semi"), content)
    apart = written(apart.withColumn("name", F.col("name") + F.lit(APART)), "apart")
    own = names.join(shared, "key", "left_anti").withColumnRenamed("name", "own")
    found = keyed.join(own, "key", "left").join(apart, ["key", *content], "left")
    return found.withColumn("name", F.coalesce("own", "name")).drop("key", "own", *content)


def name_documents(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, sort_key: Callable[..., Column] = F.xxhash64
) -> DataFrame:
    """(doc_id, sha, copies, blocks, name): equal texts have equal (blocks, name), others don't.

    `copies` counts the rows that repeat both id and text. A missing text is empty. The number of
    rounds is the logarithm of the longest text's number of blocks.
    """
    cut = docs.select("doc_id", _sha().alias("sha"), _blocks(_body(), block_bytes).alias("b"))
    cut = cut.select(*ROW, F.size("b").alias("blocks"), F.posexplode("b").alias("pos", "block"))
    named = _name(cut.withColumn("key", sort_key("block")), ["block"])
    named = named.groupBy(*ROW, "blocks", "pos", "name").agg(F.count(F.lit(1)).alias("copies"))
    level = written(named.withColumn("left", F.col("blocks")), "level")
    done = level.where("left = 1")
    longest = level.agg(F.max("blocks")).first()[0] or 1
    while longest > 1:
        longest = (longest + 1) // 2
        open_ = level.where("left > 1").select(
            *ROW, "copies", "blocks", F.expr("(left + 1) div 2").cast("int").alias("left"), "pos", "name"
        )
        pairs = open_.groupBy(*ROW, "copies", "blocks", "left", F.expr("pos div 2").cast("int").alias("half")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = pairs.withColumnRenamed("half", "pos").withColumn("key", sort_key("a", "b"))
        level = written(_name(pairs, ["a", "b"]), "level")
        done = done.unionByName(level.where("left = 1"))
    return done.select(*ROW, "copies", "blocks", "name")


def decide(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, sha, copies, keep_id, group_size): one row per (id, text).

    Of equal texts the row with the largest doc_id stays; rows without an id come last, and of
    rows that repeat both id and text one stays.
    """
    named = name_documents(docs, **settings)
    groups = named.groupBy("blocks", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    several = written(groups.where("group_size > 1"), "groups")
    found = named.join(several, ["blocks", "name"], "left")
    alone = F.col("group_size").isNull()
    return found.select(
        *ROW,
        "copies",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(alone, 1).otherwise(F.col("group_size")).cast("long").alias("group_size"),
    )


def dedup(docs: DataFrame, **settings) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`.

    A missing text is empty, so it equals other empty texts. A very long text is many blocks, whose
    names are paired in as many rounds as their number has binary digits. Rows that repeat id and
    text are one document with copies, of which one stays. Extra columns aren't looked at; an empty
    table gives an empty one.
    """
    step = 4096
    rows = decide(docs, **settings)
    many = F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {step}"))).alias("block")
    rest = F.explode(F.sequence(F.lit(1), F.least(F.lit(step), F.col("copies") - F.col("block") * step))).alias("c")
    rows = rows.select("*", many).select("*", rest)
    first = (F.col("block") == 0) & (F.col("c") == 1)
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that stay: one for each distinct text."""
    rows = written(decide(docs, **settings), "decisions")
    gone = written(rows.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*ROW), "gone")
    repeated = written(rows.where(F.col("copies") > 1).select(*ROW), "repeated")

    sha = fresh(docs, "__sha")

    def known(table: DataFrame) -> Column:
        return F.col("doc_id").eqNullSafe(table["__id"]) & (F.col(sha) == table["__s"])

    def renamed(table: DataFrame) -> DataFrame:
        return table.select(F.col("doc_id").alias("__id"), F.col("sha").alias("__s"))

    gone, repeated = renamed(gone), renamed(repeated)
    stay = docs.withColumn(sha, _sha()).join(gone, known(gone), "left_anti")
    if repeated.isEmpty():
        return stay.select(*docs.columns)
    once = stay.join(repeated, known(repeated), "left_anti").select(*docs.columns)
    row = F.struct(*docs.columns)
    some = stay.join(repeated, known(repeated), "left_semi").groupBy("doc_id", sha)
    picked = some.agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("__row")).select("__row.*")
    return once.unionByName(picked)
