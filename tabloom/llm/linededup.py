"""Incremental line dedup: sharded cuckoo filters in front of exact reference-count tables.

An index keeps, for every line key, how many document rows hold it and the smallest id among them.
Keys are dealt to shards by hash; each shard has a cuckoo filter of the keys whose count isn't
zero. Documents that come in ask the filters first: a key that no filter knows is new, and its
count is simply appended; only the others are looked up in the table. A key enters its filter when
its count leaves zero and is removed when it gets back there, which the exact counts decide, so
inserting documents and deleting them again leaves the index as it was.

What is kept in the folder, each a Parquet table that is only added to:
`postings`  (doc_id, tag, k1, k2): the keys of each row, one table for each insertion;
`counts`    (shard, k1, k2, refs, first): the changed counts after each step; the latest holds;
`filters`   (shard, buckets, blob): the filters after each step; `gone`: the ids of each deletion.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ship_package, written
from .cuckoo import CuckooFilter
from .textbytes import slices

WHITE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
SHARDS, KEYS_PER_SHARD = 64, 250_000
SLICE = 4 << 20  # bytes of texts that a task holds as lines at a time
KEY = ["k1", "k2"]
POSTINGS = "doc_id long, tag long, k1 long, k2 long"


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased."""
    return line.strip(WHITE).lower()


def is_counted(key: bytes, min_chars: int = MIN_CHARS) -> bool:
    """Has the key at least so many code points?"""
    if len(key) < min_chars or len(key) >= 4 * min_chars or key.isascii():
        return len(key) >= min_chars
    return sum((b & 0xC0) != 0x80 for b in key) >= min_chars


def key_digest(key: bytes) -> bytes:
    """128 bits of SHA-256, which stand for the key."""
    return hashlib.sha256(key).digest()[:16]


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    values = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(values, b"").to_pylist()


def _tag() -> Column:
    """Tells the texts of one id apart; which lines go depends on id and key only, so it needn't be unique."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, tag, k1, k2): each row's distinct keys of at least `min_chars` code points."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), _tag().alias("tag"), F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                counts, found = [], []
                for text in _texts(batch, "text"):
                    keys = {k for line in text.split(b"\n") if is_counted(k := line_key(line), min_chars)}
                    counts.append(len(keys))
                    found.extend(map(key_digest, keys))
                both = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
                row = pa.array(np.repeat(np.arange(len(counts)), counts))
                names = ["doc_id", "tag", "k1", "k2"]
                held = [batch.column(0).take(row), batch.column(1).take(row), pa.array(both[:, 0]), pa.array(both[:, 1])]
                yield pa.RecordBatch.from_arrays(held, names)

    return texts.mapInArrow(run, POSTINGS)


def _opened(group: pa.Table) -> tuple[CuckooFilter, np.ndarray, pa.Table]:
    """The filter of a shard, or one made for the keys in its group; those keys' first halves; their rows."""
    rows, held = group.filter(pc.is_null(group["buckets"])), group.filter(pc.is_valid(group["buckets"]))
    keys = rows["k1"].to_numpy().view(np.uint64)
    if len(held):
        return CuckooFilter.from_bytes(held["blob"][0].as_py(), held["buckets"][0].as_py()), keys, rows
    return CuckooFilter.for_keys(len(keys)), keys, rows


FILTERS = "shard int, buckets int, blob binary"


class LineIndex:
    """An index in a folder of the shared store. `save` names a version, `load` opens one again."""

    def __init__(self, spark: SparkSession, path: str, min_chars: int = MIN_CHARS, shards: int | None = None):
        self.spark, self.path, self.min_chars, self.shards = spark, path, min_chars, shards
        self.steps = 0
        self.inserted: list[int] = []
        self.deleted: list[int] = []

    # ---- versions ------------------------------------------------------------------
    def save(self) -> int:
        """Write the state's description as a version of its own; its tables are never changed."""
        row = [(self.min_chars, self.shards, self.steps, self.inserted, self.deleted)]
        schema = "min_chars int, shards int, steps int, inserted array<int>, deleted array<int>"
        path = self._at("version", self.steps)
        self.spark.createDataFrame(row, schema).coalesce(1).write.mode("overwrite").parquet(path)
        return self.steps

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int) -> LineIndex:
        r = spark.read.parquet(f"{path}/version-{version}").first()
        index = cls(spark, path, r["min_chars"], r["shards"])
        index.steps, index.inserted, index.deleted = r["steps"], list(r["inserted"]), list(r["deleted"])
        return index

    def _at(self, table: str, step: int) -> str:
        return f"{self.path}/{table}-{step}"

    def _store(self, df: DataFrame, table: str) -> DataFrame:
        """Write a table of the step that is being made; one that failed half way is done again."""
        path = self._at(table, self.steps + 1)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---- tables --------------------------------------------------------------------
    def filters(self) -> DataFrame:
        """(shard, buckets, blob) after the last step."""
        if not self.steps:
            return self.spark.createDataFrame([], FILTERS)
        return self.spark.read.parquet(self._at("filters", self.steps))

    def counts(self, keys: DataFrame | None = None) -> DataFrame:
        """(k1, k2, refs, first) of all keys, or of some: the latest row of each, zero counts included."""
        if not self.steps:
            return self.spark.createDataFrame([], "k1 long, k2 long, refs long, first long")
        columns = [*KEY, "refs", "first"]
        parts = [
            self.spark.read.parquet(self._at("counts", k)).select(*columns, F.lit(k).alias("step"))
            for k in range(1, self.steps + 1)
        ]
        rows = reduce(DataFrame.unionByName, parts)
        if keys is not None:
            rows = rows.join(keys.select(*KEY), KEY, "left_semi")
        elif self.steps == 1:
            return rows.select(*columns)
        last = F.max(F.struct("step", "refs", "first")).alias("last")
        return rows.groupBy(*KEY).agg(last).select(*KEY, "last.refs", "last.first")

    def live_postings(self) -> DataFrame:
        """Postings of the rows that weren't deleted after they came."""
        parts = []
        for k in self.inserted:
            rows = self.spark.read.parquet(self._at("postings", k))
            for d in (d for d in self.deleted if d > k):
                rows = rows.join(self.spark.read.parquet(self._at("gone", d)), "doc_id", "left_anti")
            parts.append(rows)
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], POSTINGS)

    def _shard(self) -> Column:
        return F.pmod("k1", F.lit(self.shards)).cast("int").alias("shard")

    def _beside_filters(self, rows: DataFrame) -> GroupedData:
        """The rows of each shard and its filter, if it has one, as one group."""
        return rows.unionByName(self.filters(), allowMissingColumns=True).groupBy("shard")

    # ---- steps ---------------------------------------------------------------------
    def insert(self, docs: DataFrame) -> None:
        """Count the lines of further documents. Rows that come twice are counted twice."""
        rows = self._store(postings(docs, self.min_chars), "postings")
        if self.shards is None:  # for good, from what comes first
            self.shards = max(SHARDS, -(-rows.count() // KEYS_PER_SHARD))
        more = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("refs"), F.min("doc_id").alias("first"))
        asked = self._ask(more.select(self._shard(), *KEY, "refs", "first"))
        known = self.counts(asked.where("maybe")).withColumnsRenamed({"refs": "had", "first": "was"})
        looked_up = asked.where("maybe").join(known, KEY, "left")
        fresh = asked.where("not maybe").withColumns({c: F.lit(None).cast("long") for c in ("had", "was")})
        had = F.coalesce("had", F.lit(0))
        changed = looked_up.unionByName(fresh).select(
            "shard", *KEY, (F.col("refs") + had).alias("refs"),
            F.when(had > 0, F.least("first", "was")).otherwise(F.col("first")).alias("first"), (had == 0).alias("born"),
        )
        changed = self._store(changed, "counts")
        self._change_filters(changed.where("born").select("shard", "k1"), born=True)
        self.steps += 1
        self.inserted.append(self.steps)

    def _ask(self, more: DataFrame) -> DataFrame:
        """The rows with `maybe`: does the filter of the shard know the key? Nothing is known at first."""
        if not self.steps:
            return self._store(more.withColumn("maybe", F.lit(False)), "asked")
        names = more.columns

        def ask(group: pa.Table) -> pa.Table:
            known, keys, rows = _opened(group)
            return rows.select(names).append_column("maybe", pa.array(known.contains(keys)))

        schema = StructType([*more.schema.fields]).add("maybe", "boolean")
        return self._store(self._beside_filters(more).applyInArrow(ask, schema), "asked")

    def _change_filters(self, keys: DataFrame, born: bool) -> None:
        """Write the filters after keys got their first reference, or lost their last."""

        def change(group: pa.Table) -> pa.Table:
            known, keys, _ = _opened(group)
            if born:
                known.insert(keys)
            elif missed := known.remove(keys):
                raise ValueError(f"{missed} keys of the table aren't in the filter")
            held = [group["shard"][:1].combine_chunks(), pa.array([known.buckets], pa.int32()), pa.array([known.to_bytes()])]
            return pa.Table.from_arrays(held, ["shard", "buckets", "blob"])

        self._store(self._beside_filters(keys).applyInArrow(change, FILTERS), "filters")

    def delete(self, ids: DataFrame) -> None:
        """Take back all rows of the given doc_ids; ids that aren't there, or missing, change nothing."""
        gone = self._store(ids.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct(), "gone")
        rows = self.live_postings()
        less = rows.join(gone, "doc_id", "left_semi").groupBy(*KEY).agg(F.count(F.lit(1)).alias("less"))
        less = self._store(less, "less")
        left = less.join(self.counts(less), KEY).select(*KEY, (F.col("refs") - F.col("less")).alias("refs"))
        left = self._store(left, "left")
        # the smallest id among the rows that stay
        stay = rows.join(gone, "doc_id", "left_anti").join(left.where("refs > 0"), KEY, "left_semi")
        firsts = stay.groupBy(*KEY).agg(F.min("doc_id").alias("first"))
        changed = left.join(firsts, KEY, "left").select(self._shard(), *KEY, "refs", "first")
        changed = self._store(changed, "counts")
        self._change_filters(changed.where("refs = 0").select("shard", "k1"), born=False)
        self.steps += 1
        self.deleted.append(self.steps)

    # ---- results -------------------------------------------------------------------
    def drops(self) -> DataFrame:
        """(doc_id, tag, gone): the keys whose lines a row loses, for rows that lose any.

        A key's lines stay in the smallest id that holds it, in all its rows; rows without an id come
        last, and keep a line that only they hold.
        """
        # written, so that it comes to the join by a shuffle of its own, and Spark can split a common key
        shared = written(self.counts().where("refs > 1 and first is not null").select(*KEY, "first"), "shared")
        rows = self.live_postings().join(shared, KEY).where("doc_id is null or doc_id > first")
        return rows.groupBy("doc_id", "tag").agg(F.collect_set(F.struct(*KEY)).alias("gone"))

    def dedup(self, docs: DataFrame) -> DataFrame:
        """The rows of `docs` with the lines taken from `text` that the index says, n_lines (before) and n_dropped.

        A line is what stands between line feeds; a missing or empty text is one empty line, and the
        text of a row is never missing afterwards. A row that isn't in the index keeps its lines.
        Rows that repeat id and text lose the same lines. Columns called n_lines or n_dropped are
        replaced; an empty table stays empty.
        """
        ship_package(self.spark)
        docs = docs.drop("n_lines", "n_dropped")
        new = StructType([*docs.schema.fields]).add("n_lines", "long").add("n_dropped", "long")
        drops = self.drops().select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), F.col("gone").alias("__gone"))
        same = F.col("doc_id").eqNullSafe(F.col("__id")) & (_tag() == F.col("__tag"))
        joined = docs.join(drops, same, "left").select(*docs.columns, "__gone")
        joined = joined.withColumn("text", F.col("text").cast("binary"))
        at, min_chars = docs.columns.index("text"), self.min_chars
        schema = StructType([f if f.name != "text" else joined.schema["text"] for f in new.fields])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, "text", SLICE):
                    kept, lines, dropped = [], [], []
                    gone_column = batch.column(batch.num_columns - 1)
                    for k, text in enumerate(_texts(batch, "text")):
                        if not gone_column[k].is_valid:
                            kept.append(text)
                            lines.append(text.count(b"\n") + 1)
                            dropped.append(0)
                            continue
                        pairs = gone_column[k].values
                        both = np.stack([pairs.field(0).to_numpy(), pairs.field(1).to_numpy()], 1).astype("<i8").tobytes()
                        gone = {both[i : i + 16] for i in range(0, len(both), 16)}
                        whole_text = text.split(b"\n")
                        stay = [
                            x for x in whole_text
                            if not is_counted(key := line_key(x), min_chars) or key_digest(key) not in gone
                        ]
                        kept.append(b"\n".join(stay))
                        lines.append(len(whole_text))
                        dropped.append(len(whole_text) - len(stay))
                    held = list(batch.columns[:-1])
                    held[at] = pa.array(kept, pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [*held, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], names=schema.names
                    )

        return joined.mapInArrow(run, schema).withColumn("text", F.col("text").cast("string"))
