"""MinHash near-dedup by a signature-coordinate inverted join.

Every (coordinate, value) of a signature is a posting list of documents. Two documents whose
signatures agree in at least `agree` coordinates must share one of the rarest `coordinates -
agree + 1` lists of either, so only these prefixes are joined; lists of one document are skipped,
and so are documents with fewer than `agree` shared coordinates. Agreement is then counted on the
signatures, and pairs above the threshold are confirmed on the full shingle sets.

Groups of copies are never expanded into pairs. Equal sets are one class. In a list, all are first
compared with one pivot, the document that shares most; what is linked by then is one component.
After that only documents outside a list's main component meet the others, and there the overlap
of two documents is known from what each has beside the pivot's set and what it lacks of it. How
much of it they must share is known for each of them, so they are joined over the rarest of
these shingles, and not over the list. All this is exact, so no link between components is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import alone, dropped, ship_package, written
from .textbytes import U64, Words, mix, shingle_sets, slices

COORDINATES = 64
NEAR = 50  # percent of similarity to a pivot from which on the differences are kept
MISS = 1e-5  # chance that signatures of two documents just at the threshold agree too little
BROADCAST_IDS = 1_000_000  # ids of documents, counted, that are broadcast; more are joined by a shuffle


def agreement(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The largest number of agreeing coordinates that a pair at the threshold reaches but for `miss`."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def signatures(docs: DataFrame, words: int, coordinates: int = COORDINATES) -> DataFrame:
    """(doc_id, n_shingles, digest, sig): set size, digest of the set, and its MinHash signature."""
    kind = pa.list_(pa.field("element", pa.int32(), nullable=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _multipliers(coordinates)
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                text, shingle = shingle_sets(Words(batch.column(1)), words)
                sizes = np.bincount(text, minlength=len(batch))
                ends = np.concatenate([[0], np.cumsum(sizes)])
                starts = ends[:-1][sizes > 0]
                least = np.zeros((len(batch), coordinates), np.int32)
                for k, factor in enumerate(factors):
                    if len(starts):
                        lowest = np.minimum.reduceat(shingle * factor, starts) >> U64(32)
                        least[sizes > 0, k] = lowest.astype(np.uint32).view(np.int32)
                digests = [
                    hashlib.blake2b(shingle[a:b].tobytes(), digest_size=16).digest()
                    for a, b in zip(ends, ends[1:], strict=False)
                ]
                offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * coordinates)
                sig = pa.ListArray.from_arrays(offsets, pa.array(least.ravel())).cast(kind)
                columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), sig]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "sig"])

    schema = "doc_id long, n_shingles long, digest binary, sig array<int>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, shingles): the whole shingle set of each document, as 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                text, shingle = shingle_sets(Words(batch.column(1)), words)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(batch)))])
                made = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(shingle.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0), made], ["doc_id", "shingles"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, shingles array<long>")


def _is_forest(edges: DataFrame) -> bool:
    """Do edges (a, b) with a > b make stars: has each a one b, and is no b an a?"""
    ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("child"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("b").alias("u"), F.lit(0).alias("child"), F.lit(1).alias("centre"))
    )
    roles = ends.groupBy("u").agg(F.sum("child").alias("child"), F.max("centre").alias("centre"))
    return roles.where("child > 1 or (child = 1 and centre = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(doc, component): the smallest document reachable over links (a, b), for every linked document.

    Large-star and small-star steps in turn: each document points its neighbours at the smallest
    one it knows, until the edges are stars. Neighbourhoods are never collected; the edges are
    written after each step, and the number of rounds follows the logarithm of the longest chain.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = down.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else down
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = written(least, "least")
        found = both.join(least, "u")
        if large:  # the neighbours above u
            moved = found.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:  # the neighbours below u, and u itself
            own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            moved = found.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own)
        return written(moved.where("a > b").distinct(), "edges")

    ordered = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(ordered.distinct(), "edges")
    while not _is_forest(edges):
        edges = star(star(edges, True), False)
    centres = edges.select(F.col("b").alias("doc"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("doc"), F.col("b").alias("component")).unionByName(centres)


def _similar(shared: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * shared >= percent * (n + m - shared)


def _side(table: DataFrame, name: str, *columns: str) -> DataFrame:
    """The table for one end of a pair: `doc` as `name`, and the columns with its name added."""
    return table.select(F.col("doc").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


FACTS = ["doc", "n", "comp", "pivot_n", "needs", "extra", "lost", "extra_bits", "lost_bits"]
BITS = 8  # 64-bit words of a bitmap that stands for a set


def _bits(column: str) -> Column:
    """A bitmap of a set of hashes: each turns one bit on."""
    one = "shiftleft(1L, cast(pmod(shiftright(w, 8), 64) as int))"
    words = [f"aggregate({column}, 0L, (a, w) -> a | if(pmod(w, {BITS}) = {k}, {one}, 0L))" for k in range(BITS)]
    return F.when(F.col(column).isNotNull(), F.expr(f"array({', '.join(words)})"))


def _common_at_most(name: str) -> Column:
    """An upper bound of what two sets share, from sizes and bitmaps: where the bits differ, the sets differ."""
    apart = F.aggregate(
        F.zip_with(f"{name}_bits_x", f"{name}_bits_y", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, c: s + c
    )
    return F.least(f"{name}_x", f"{name}_y", F.floor((F.col(f"{name}_x") + F.col(f"{name}_y") - apart) / 2))


class _Index:
    """Prefix postings of class representatives, and the sets that confirm their links."""

    def __init__(self, docs: DataFrame, reps: DataFrame, words: int, percent: int, coordinates: int):
        self.docs, self.reps, self.words, self.percent, self.coordinates = docs, reps, words, percent, coordinates
        self.agree = agreement(coordinates, percent)
        tokens = reps.select("doc", F.posexplode("sig").alias("k", "v"))
        lists = tokens.groupBy("k", "v").agg(F.count(F.lit(1)).alias("df"))
        lists = written(lists.where("df > 1"), "lists")
        met = tokens.join(lists, ["k", "v"]).select(
            "doc", F.struct("df", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("v")).alias("t")).alias("own")
        )
        own = met.groupBy("doc").agg(F.array_sort(F.collect_list("own")).alias("own"))  # one per coordinate at most
        held = own.where(F.size("own") >= self.agree).select(
            "doc",
            F.transform(F.slice("own", F.lit(1), F.size("own") - self.agree + 1), lambda o: o["t"]).alias("prefix"),
            F.aggregate("own", F.lit(0.0), lambda x, o: x + F.log(o["df"].cast("double"))).alias("centre"),
        )
        self.held = written(held, "held")
        dropped(lists)

    def overlaps(self, pairs: DataFrame, percent: int) -> DataFrame:
        """(a, b, n_a, n_b, shared, only_a, only_b) of written pairs whose signatures agree as those of `percent` do.

        `shared` is exact, from the whole sets; `only_a` are the shingles of a that b lacks.
        """
        same = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda x, y: x + y)
        signed = pairs.join(_side(self.reps, "a", "sig"), "a").join(_side(self.reps, "b", "sig"), "b")
        close = written(signed.where(same >= agreement(self.coordinates, percent)).select("a", "b"), "close")
        dropped(pairs)
        ids = written(close.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
        wanted = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
        full = sets(self.docs.join(wanted, "doc_id", "left_semi"), self.words).withColumnRenamed("doc_id", "doc")
        full = written(full, "sets")
        whole = close.join(_side(full, "a", "shingles"), "a").join(_side(full, "b", "shingles"), "b")
        a, b = F.col("shingles_a"), F.col("shingles_b")
        found = whole.select(
            "a", "b", F.size(a).alias("n_a"), F.size(b).alias("n_b"), F.array_except(a, b).alias("only_a"), F.array_except(b, a).alias("only_b")
        )
        found = found.withColumn("shared", F.col("n_a") - F.size("only_a"))
        return found.where(_similar(F.col("shared"), F.col("n_a"), F.col("n_b"), percent))

    def links(self, overlaps: DataFrame) -> DataFrame:
        same = _similar(F.col("shared"), F.col("n_a"), F.col("n_b"), self.percent)
        return overlaps.where(same).select("a", "b").distinct()

    def pivots(self) -> tuple[DataFrame, DataFrame]:
        """(postings, lists): (doc, n, t) of the prefixes, and (t, pivot) of lists of several documents."""
        sized = self.held.join(self.reps.select("doc", "n"), "doc")
        postings = written(sized.select("doc", "n", "centre", F.explode("prefix").alias("t")), "postings")
        lists = postings.groupBy("t").agg(F.max_by("doc", F.struct("centre", "doc")).alias("pivot"), F.count(F.lit(1)).alias("m"))
        return postings, written(lists.where("m > 1").select("t", "pivot"), "pivots")

    def rows_beside(self, postings: DataFrame, lists: DataFrame, comps: DataFrame, overlaps: DataFrame) -> DataFrame:
        """The members of lists that hold several components, and what is known of each from the list's pivot.

        (t, pivot, main, doc, n, comp, prefix, pivot_n, beside, lacking, needs): `needs` is the least number of
        shingles beside the pivot's that the document shares with whatever it links to: a link takes
        `percent` of its set, and of the pivot's set it has but what it doesn't lack.
        """

        def seen_from(pivot: str, doc: str) -> DataFrame:
            return overlaps.select(
                F.col(pivot).alias("pivot"), F.col(doc).alias("doc"), F.col(f"n_{pivot}").alias("pivot_n"),
                F.col(f"only_{doc}").alias("beside"), F.col(f"only_{pivot}").alias("lacking"),
            )

        rows = postings.join(comps, "doc", "left").withColumn("comp", F.coalesce("component", "doc")).drop("component", "centre")
        sizes = rows.groupBy("t", "comp").agg(F.count(F.lit(1)).alias("m"))
        main = sizes.groupBy("t").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
        open_ = written(lists.join(main.where("comps > 1"), "t").select("t", "pivot", "main"), "open")
        rows = written(rows.join(open_, "t"), "open_rows")
        known = seen_from("a", "b").unionByName(seen_from("b", "a"))
        rows = rows.join(known, ["pivot", "doc"], "left").join(self.held.select("doc", "prefix"), "doc")
        none, at_pivot = F.array().cast("array<long>"), F.col("doc") == F.col("pivot")
        for name, own in (("pivot_n", F.col("n")), ("beside", none), ("lacking", none)):
            rows = rows.withColumn(name, F.when(at_pivot, own).otherwise(F.col(name)))
        needs = F.ceil(self.percent * F.col("n") / 100) - (F.col("pivot_n") - F.size("lacking"))
        facts = {"needs": needs.cast("long"), "extra": F.size("beside"), "lost": F.size("lacking")}
        facts |= {"extra_bits": _bits("beside"), "lost_bits": _bits("lacking")}
        return rows.withColumns(facts)

    def candidates(self, rows: DataFrame) -> DataFrame:
        """(pivot, x, y): pairs of documents of different components that may link, before their sets are looked at.

        If x or y needs a shingle beside the pivot's, they share one among the first
        `size - needs + 1` of either, in the order of how many documents have it beside this pivot;
        so unlike documents around a common template meet only over rare shingles. Pairs without such a
        need, or with a member that is too far from the pivot for its differences to be known, meet
        in the list.
        """
        seen = rows.where("beside is not null").select("pivot", *FACTS, "beside").dropDuplicates(["pivot", "doc"])
        words = written(seen.select("pivot", "doc", F.explode("beside").alias("w")), "beside")
        often = written(words.groupBy("pivot", "w").agg(F.count(F.lit(1)).alias("df")), "often")
        ranked = words.join(often, ["pivot", "w"]).groupBy("pivot", "doc")
        ranked = ranked.agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("ws"))
        ranked = ranked.join(seen.drop("beside"), ["pivot", "doc"]).where("size(ws) >= needs")
        first = F.slice("ws", F.lit(1), (F.size("ws") - F.greatest("needs", F.lit(1)) + 1).cast("int"))
        first = ranked.select("pivot", *FACTS, F.explode(first).alias("f")).where("f.df > 1")
        first = written(first.select("pivot", *FACTS, F.col("f.w").alias("w")), "first")
        sizes = first.groupBy("pivot", "w", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("pivot", "w")
        mains = sizes.agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"))
        mains = written(mains.where("comps > 1").drop("comps"), "mains")
        first = written(first.join(mains, ["pivot", "w"]), "first")
        found = self._met(first, first, ["pivot", "w"])
        far, near = rows.where("beside is null"), rows.where("beside is not null")
        loose = near.where("needs <= 0")
        for one, two in ((loose, loose), (far, rows), (near, far)):
            found = found.unionByName(self._met(one, two, ["t", "pivot"]))
        return found.select("pivot", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))

    def _met(self, one: DataFrame, two: DataFrame, keys: list[str]) -> DataFrame:
        """Pairs (x, y) that share the keys, differ in component, and aren't shown to be unlike by sizes and bits.

        The largest component of a group, `main`, meets the others but not itself.
        """
        in_list = "t" in keys
        held = [*FACTS, *(["prefix", "beside", "lacking"] if in_list else [])]
        x = one.where("comp != main").select(*keys, "main", *[F.col(c).alias(f"{c}_x") for c in held])
        y = two.select(*keys, *[F.col(c).alias(f"{c}_y") for c in held])
        n, m = F.col("n_x"), F.col("n_y")
        need = F.ceil(self.percent * (n + m) / (100 + self.percent))  # the overlap that a link needs
        # of the pivot's set both have what neither lacks; what both lack, and have beside it, is bounded by the bits
        in_pivot = F.col("pivot_n_x") - F.col("lost_x") - F.col("lost_y") + _common_at_most("lost")
        like = F.coalesce(in_pivot + _common_at_most("extra") >= need, F.lit(True))
        sizes = 100 * F.least(n, m) >= self.percent * F.greatest(n, m)
        met = (F.col("comp_x") != F.col("comp_y")) & sizes & like
        if one is two:  # else both orders are met
            met = met & ((F.col("comp_y") == F.col("main")) | (F.col("doc_x") < F.col("doc_y")))
        if in_list:  # a pair that shares several lists is made by the first of them
            met = met & (F.element_at(F.array_intersect("prefix_x", "prefix_y"), 1) == F.col("t"))
            # lists hold few rows by now, so their differences come along, and the overlap is known as it is
            both_lack, both_have = (F.size(F.array_intersect(f"{c}_x", f"{c}_y")) for c in ("lacking", "beside"))
            in_pivot = F.col("pivot_n_x") - F.col("lost_x") - F.col("lost_y") + both_lack
            met = met & F.coalesce(in_pivot + both_have >= need, F.lit(True))
        else:
            met = met & ((F.col("needs_x") > 0) | (F.col("needs_y") > 0))
        return x.join(y, keys).where(met).select("pivot", F.col("doc_x").alias("x"), F.col("doc_y").alias("y"))

    def pairs_beside(self, rows: DataFrame) -> DataFrame:
        """Pairs (a, b) between components that share a list and that its pivot doesn't show to be unlike."""
        met = written(self.candidates(rows).distinct(), "met")
        asked = met.select("pivot", F.explode(F.array("x", "y")).alias("doc")).distinct()
        facts = rows.select("pivot", "doc", "n", "pivot_n", "beside", "lacking").join(asked, ["pivot", "doc"], "left_semi")
        facts = written(facts.dropDuplicates(["pivot", "doc"]), "facts")  # only of those that met

        def side(name: str) -> DataFrame:
            return facts.select("pivot", F.col("doc").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "pivot_n", "beside", "lacking")])

        both = met.join(side("x"), ["pivot", "x"]).join(side("y"), ["pivot", "y"])
        n, m = F.col("n_x"), F.col("n_y")
        need = F.ceil(self.percent * (n + m) / (100 + self.percent))  # the overlap that a link needs
        # of the pivot's set both have what neither lacks; beside it, what stands in both differences
        both_lack = F.size(F.array_intersect("lacking_x", "lacking_y"))
        in_pivot = F.col("pivot_n_x") - F.size("lacking_x") - F.size("lacking_y") + both_lack
        shared = in_pivot + F.size(F.array_intersect("beside_x", "beside_y"))
        unknown = F.col("beside_x").isNull() | F.col("beside_y").isNull()
        return both.where(unknown | (shared >= need)).select(F.col("x").alias("a"), F.col("y").alias("b"))

    def linked(self) -> DataFrame:
        """(doc, component) of all documents with a link."""
        postings, lists = self.pivots()
        met = postings.join(lists, "t").where("doc != pivot")
        met = written(met.select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b")).distinct(), "pairs")
        first = alone(lambda: self.overlaps(met, NEAR), "overlaps")
        sizes = ["a", "b", "n_a", "n_b", "shared"]
        agreed = written(first.select(*sizes), "agreed")
        comps = alone(lambda: components(self.links(agreed)), "components")
        rows = alone(lambda: self.rows_beside(postings, lists, comps, first), "rows")
        dropped(postings, lists, first, self.held)
        pairs = alone(lambda: self.pairs_beside(rows).distinct(), "pairs")
        dropped(rows)
        second = alone(lambda: self.overlaps(pairs, self.percent).select(*sizes), "overlaps")
        # what is linked already stands for its links
        held = comps.select(F.col("doc").alias("a"), F.col("component").alias("b"))
        return components(held.unionByName(self.links(second)))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, coordinates: int = COORDINATES
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    A document's set holds its distinct runs of `words` words (lower-cased A-Z); with fewer words,
    all of them as one; a missing or empty text, or one of white space, has an empty set and links
    with nothing. Documents link if their sets share `percent` % of their union; component_id is
    the smallest doc_id reachable, and it is the one kept. Rows without an id link with nothing:
    their component_id is NULL and they are kept. Rows that repeat id and text share their fate; an
    id that names several texts has the links of all of them. A very long text is taken whole: its set
    is held by one task, a few bytes per shingle. Other columns aren't looked at; an
    empty table gives an empty one.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(signatures(docs, words, coordinates), "signatures")
    sized = written(signed.select("doc_id", "n_shingles", "digest"), "sized")
    usable = signed.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("n_shingles", "digest").agg(
        F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("members"), F.first("sig").alias("sig")
    )
    classes = written(classes, "classes")
    dropped(signed)
    reps = classes.select("doc", F.col("n_shingles").alias("n"), "sig")
    linked = alone(lambda: _Index(docs, reps, words, percent, coordinates).linked(), "components")
    named = classes.select("n_shingles", "digest", "doc", "members").join(linked, "doc", "left")
    moved = named.where("members > 1 or component is not null").select(
        "n_shingles", "digest", F.coalesce("component", "doc").alias("component")
    )
    moved = written(moved, "moved")
    dropped(classes, linked)
    rows = sized.join(moved, ["n_shingles", "digest"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` that stay: of each component the document with the smallest id."""
    rows = near_duplicates(docs, **settings).groupBy("doc_id").agg(F.max("kept").alias("kept"))
    gone = written(rows.where("not kept").select("doc_id"), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
