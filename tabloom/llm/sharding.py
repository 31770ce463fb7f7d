"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot is a hash and never changes. Which shard holds a slot is a small table with a
version; rebalancing edits that table, and only the slots it moves are copied.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 4096  # fixed for the life of a dataset; the map has this many rows


def virtual_slot(n_slots: int = SLOTS) -> Column:
    """Slot of a record, from a hash of its id and text."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_slots)).cast("int")


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (missing: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def slot_bytes(docs: DataFrame, n_slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, rows, bytes) of the slots that hold records: added up before the shuffle."""
    placed = docs.select(virtual_slot(n_slots).alias("virtual_slot"), record_bytes(F.col("text")).alias("b"))
    return placed.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"), F.sum("b").alias("bytes"))


def first_map(sizes: DataFrame, n_shards: int, n_slots: int = SLOTS) -> list[int]:
    """Shard of every slot: the slots by falling bytes, each to the shard with the fewest so far.

    Only the bytes per slot, `n_slots` numbers, reach the driver.
    """
    weight = {r["virtual_slot"]: r["bytes"] for r in sizes.collect()}
    loads = [(0, s) for s in range(n_shards)]
    shards = [0] * n_slots
    for slot in sorted(range(n_slots), key=lambda k: (-weight.get(k, 0), k)):
        load, shard = heapq.heappop(loads)
        shards[slot] = shard
        heapq.heappush(loads, (load + weight.get(slot, 0), shard))
    return shards


def edit_map(shards: list[int], sizes: DataFrame, n_shards: int) -> list[int]:
    """The map for other sizes or another number of shards, moving few slots.

    Slots of shards that no longer exist go to the lightest shard. Then the heaviest shard gives
    the lightest one its largest slot that narrows their gap, until none does.
    """
    weight = [0] * len(shards)
    for r in sizes.collect():
        weight[r["virtual_slot"]] = r["bytes"]
    shards, loads = list(shards), [0] * n_shards
    held = [set() for _ in range(n_shards)]
    for slot, shard in enumerate(shards):
        if shard < n_shards:
            held[shard].add(slot)
            loads[shard] += weight[slot]

    def move(slot: int, to: int) -> None:
        shards[slot] = to
        held[to].add(slot)
        loads[to] += weight[slot]

    for slot in sorted((k for k, s in enumerate(shards) if s >= n_shards), key=lambda k: (-weight[k], k)):
        move(slot, min(range(n_shards), key=lambda s: (loads[s], s)))
    while True:
        high = max(range(n_shards), key=lambda s: (loads[s], -s))
        low = min(range(n_shards), key=lambda s: (loads[s], s))
        gap = loads[high] - loads[low]
        fit = [k for k in held[high] if 0 < weight[k] <= gap // 2]
        if not fit:
            return shards
        slot = max(fit, key=lambda k: (weight[k], -k))
        held[high].remove(slot)
        loads[high] -= weight[slot]
        move(slot, low)


def save_map(spark, path: str, version: int, shards: list[int]) -> None:
    """Store one version of the map; a version that exists is an error, so none is ever overwritten."""
    rows = spark.createDataFrame(list(enumerate(shards)), "virtual_slot int, shard int").coalesce(1)
    rows.write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """(version, virtual_slot, shard) of one version, by default the last."""
    every = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def assign(docs: DataFrame, slot_map: DataFrame, n_slots: int = SLOTS, edited: DataFrame | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, version, shard, slot) of every document.

    slot is the record's place in its shard, gapless from 0: the rows of the shard's earlier
    virtual slots, plus its place by (doc_id, size, checksum) in its own. A missing text counts as
    empty, a missing id sorts first, repeated rows take places of their own, and an empty table
    gives an empty one. Only ids, sizes and checksums are shuffled, by virtual slot. The map has
    `n_slots` rows, so it is broadcast. With a second map, `edited`, the place of every document
    under it comes from the same pass, as edited_version, edited_shard and edited_slot.

    Slots are hashes of id and text, so that the bytes of shards come out even: equal texts with
    different ids are not kept together, while rows that repeat both share a slot, which one task
    numbers (20 bytes a row, not the texts). A very long text is read whole, for its length and checksum.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        record_bytes(F.col("text")).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        virtual_slot(n_slots).alias("virtual_slot"),
    )
    maps = {"": slot_map} if edited is None else {"": slot_map, "edited_": edited}
    offsets = slot_bytes(docs, n_slots).select("virtual_slot", "rows")
    for name, table in maps.items():
        shard, version = F.col("shard").alias(f"{name}shard"), F.col("version").alias(f"{name}version")
        # as many rows as slots
        before = Window.partitionBy(f"{name}shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
        offsets = offsets.join(table.select("virtual_slot", shard, version), "virtual_slot")
        offsets = offsets.withColumn(f"__{name}before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32"))
    placed = rows.withColumn("__in", inside).join(F.broadcast(offsets.drop("rows")), "virtual_slot")
    places = [
        c
        for name in maps
        for c in (f"{name}version", f"{name}shard", (F.col(f"__{name}before") + F.col("__in") - 1).cast("long").alias(f"{name}slot"))
    ]
    return placed.select("doc_id", "size", "text_crc32", "virtual_slot", *places)


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, n_slots: int = SLOTS) -> None:
    """Write the documents, one folder per shard; Spark splits a shard that is too large for a task."""
    placed = docs.drop("shard").withColumn("__slot", virtual_slot(n_slots))
    table = F.broadcast(slot_map.select(F.col("virtual_slot").alias("__slot"), "shard"))
    placed.join(table, "__slot").drop("__slot").hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
