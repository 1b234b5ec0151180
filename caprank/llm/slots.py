"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into a fixed number of slots (thousands, far more than
shards).  Bytes are summed per slot by a combining aggregate, and only that small
table (one row for each slot) reaches the driver.  The map from slots to shards is
a stored table: version 0 deals the slots out in turn, and each later version is
the list of edits (slot, from, to) that turns the one before into it.  Rebalancing
edits the map: moves and swaps of slots between the fullest and the emptiest shard
until their sizes are near equal.  Growing by a shard moves slots into the new one
only.  A record's shard is its slot looked up in a version, so nothing is hashed
anew when the map changes.

Law of the query: ``bytes`` (sizes near equal).

Scale: the map and the slot sums have ``slots`` rows whatever the input.  Equal
rows are counted first and told apart by their copy number, which is
part of the hash, so a record that a third of all rows repeat is spread over all
slots.  Records travel as (id, size, checksum, digest), never with their text.

Defined results: a null text has no bytes (size 8) and checksum 0; null ids are
ids as others; repeated rows are records of their own; equal texts are not kept
together (a group of copies may be larger than a shard); a record larger than a
fair share has a shard as near to alone as slots allow; an empty table has no rows;
``sharded`` takes rows of any columns besides doc_id and text (the query passes
these two only).
"""

from __future__ import annotations

import heapq
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caprank.llm.common import documents, written
from caprank.llm.merkle import leaf_hash
from caprank.session import ensure_checkpoint_dir

SLOTS = 8192
SHARDS = 24
#: Bytes of a record besides its text.
FRAME = 8
#: Copies of one record that one task numbers.
COPIES = 100_000
#: Rebalancing stops when fullest and emptiest shard differ by this share of the mean.
TOLERANCE = 0.001


class SlotMap:
    """Slot-to-shard map with its history of edits."""

    def __init__(self, slots: int = SLOTS, shards: int = SHARDS, edits: list[tuple[int, int, int, int]] | None = None):
        self.slots, self.base_shards = slots, shards
        #: (version, slot, from shard, to shard), in order
        self.edits = list(edits or [])

    @property
    def version(self) -> int:
        return self.edits[-1][0] if self.edits else 0

    def at(self, version: int | None = None) -> np.ndarray:
        """Shard of each slot in a version (the last one by default)."""
        shard = np.arange(self.slots) % self.base_shards
        for v, slot, _, to in self.edits:
            if version is None or v <= version:
                shard[slot] = to
        return shard

    def shards(self, version: int | None = None) -> int:
        return max(self.base_shards, int(self.at(version).max()) + 1)

    def edit(self, to: dict[int, int]) -> int:
        """New version with some slots moved; without a change the old one."""
        now, version = self.at(), self.version + 1
        self.edits += [(version, s, int(now[s]), t) for s, t in sorted(to.items()) if now[s] != t]
        return self.version

    def rebalance(self, size: np.ndarray, tolerance: float = TOLERANCE) -> int:
        """Edit the map until shard sizes are near equal: the slot that best halves
        the difference goes from the fullest to the emptiest shard, or two slots
        are swapped; stops within the tolerance or when neither helps."""
        shard, k = self.at(), self.shards()
        total = np.bincount(shard, weights=size, minlength=k).astype(np.int64)
        mean = max(1.0, total.sum() / k)
        stuck = np.zeros(k, dtype=bool)  # shards that give nothing to the emptiest one, say for one huge record
        for _ in range(20 * self.slots):
            full, empty = int(np.where(stuck, -1, total).argmax()), int(total.argmin())
            gap = int(total[full] - total[empty])
            if stuck.all() or gap <= tolerance * mean:
                break
            a, b = np.flatnonzero((shard == full) & (size > 0)), np.flatnonzero(shard == empty)
            best = (gap, -1, -1)  # what is left of the gap, slot of the full one, slot of the empty one
            if len(a):
                left = np.abs(gap - 2 * size[a])
                i = int(left.argmin())
                best = min(best, (int(left[i]), int(a[i]), -1))
            if best[0] > tolerance * mean and len(a) and len(b):
                b = b[np.argsort(size[b], kind="stable")]
                want = size[a] - gap // 2
                for side in (-1, 0):
                    j = np.clip(np.searchsorted(size[b], want) + side, 0, len(b) - 1)
                    left = np.abs(gap - 2 * (size[a] - size[b[j]]))
                    i = int(left.argmin())
                    best = min(best, (int(left[i]), int(a[i]), int(b[j[i]])))
            left, x, y = best
            if x < 0 or left >= gap:
                stuck[full] = True
                continue
            stuck[:] = False
            shard[x] = empty
            moved = int(size[x])
            if y >= 0:
                shard[y] = full
                moved -= int(size[y])
            total[full] -= moved
            total[empty] += moved
        return self.edit(dict(enumerate(shard.tolist())))

    def grow(self, size: np.ndarray) -> int:
        """One more shard: slots move into it, from the fullest shards first, until
        it has its fair share; no slot moves between the old ones."""
        shard, k = self.at(), self.shards()
        total = np.bincount(shard, weights=size, minlength=k).astype(np.int64)
        share = total.sum() // (k + 1)
        moves: dict[int, int] = {}
        own = {j: sorted(np.flatnonzero(shard == j).tolist(), key=lambda s: (size[s], s)) for j in range(k)}
        heap = [(-int(total[j]), j) for j in range(k)]
        heapq.heapify(heap)
        got = 0
        while heap and got < share:
            _, j = heapq.heappop(heap)
            while own[j] and got + size[own[j][-1]] > share:
                own[j].pop()  # too large for what is left
            if own[j]:
                s = own[j].pop()
                moves[s], got = k, got + int(size[s])
                total[j] -= size[s]
                heapq.heappush(heap, (-int(total[j]), j))
        return self.edit(moves)

    def save(self, spark: SparkSession, path: str | None = None) -> str:
        """Store base and edits as a table of its own in the shared folder: row
        (0, slot, null, shard) for the base, then the edits by version."""
        path = path or f"{ensure_checkpoint_dir(spark)}/slot-map-{uuid.uuid4().hex}"
        base = np.arange(self.slots) % self.base_shards
        rows = [(0, s, None, int(t)) for s, t in enumerate(base)] + [tuple(map(int, e)) for e in self.edits]
        (spark.createDataFrame(rows, "version int, slot int, old int, shard int").coalesce(1)
         .write.mode("errorifexists").parquet(path))
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SlotMap:
        rows = sorted(map(tuple, spark.read.parquet(path).collect()), key=lambda r: (r[0], r[1]))
        base = [r for r in rows if r[0] == 0]
        return cls(len(base), max(r[3] for r in base) + 1, [r for r in rows if r[0] > 0])

    def table(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """(virtual_slot, shard) of a version, one row for each slot."""
        return spark.createDataFrame(list(enumerate(self.at(version).tolist())), "virtual_slot int, shard int")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32`` and ``row_sha``, a digest of all its
    columns, in place of its columns other than doc_id."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + FRAME).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(leaf_hash([F.col(c) for c in docs.columns])).alias("row_sha"))


def records(docs: DataFrame, slots: int = SLOTS, copies: int = COPIES) -> DataFrame:
    """(doc_id, size, text_crc32, row_sha, copy, virtual_slot) of every row.

    Equal rows are counted and numbered, so that the hash of a record needs neither
    its place in the input nor another row."""
    same = measured(docs).groupBy("doc_id", "size", "text_crc32", "row_sha").agg(F.count("*").alias("n"))
    # two steps: a record of very many copies becomes ranges first, and these are dealt out
    ranges = written(same.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(copies).cast("long")))),
                     "records")
    if not ranges.where(f"n > {copies}").isEmpty():
        ranges = ranges.repartition("row_sha", "lo")
    own = ranges.withColumn("copy", F.explode(F.sequence("lo", F.least(F.col("lo") + copies, F.col("n")) - 1)))
    return own.select("doc_id", "size", "text_crc32", "row_sha", "copy",
                      F.pmod(F.xxhash64("row_sha", "copy"), F.lit(slots)).cast("int").alias("virtual_slot"))


def slot_sizes(recs: DataFrame) -> DataFrame:
    """(virtual_slot, n, bytes): at most one row for each slot."""
    return recs.groupBy("virtual_slot").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def size_vector(sums: DataFrame, slots: int) -> np.ndarray:
    """Bytes of each slot on the driver (``slots`` numbers)."""
    out = np.zeros(slots, dtype=np.int64)
    for r in sums.collect():
        out[r["virtual_slot"]] = r["bytes"]
    return out


def placed(recs: DataFrame, sums: DataFrame, slot_map: SlotMap, version: int | None = None) -> DataFrame:
    """Records with ``shard`` and ``slot``, their place 0, 1, ... in the shard:
    virtual slots in ascending order, inside them records by id.  Offsets are summed
    over the slot table, rows are numbered inside their slot."""
    table = slot_map.table(recs.sparkSession, version).join(sums, "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    table = table.select("virtual_slot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "row_sha", "copy")
    return (recs.withColumn("at", F.row_number().over(inside) - 1).join(F.broadcast(table), "virtual_slot")  # one row a slot
            .withColumn("slot", (F.col("before") + F.col("at")).cast("long")).drop("before", "at"))


def sharded(docs: DataFrame, slots: int = SLOTS, shards: int = SHARDS) -> tuple[DataFrame, SlotMap]:
    """(placed records, the map that was rebalanced for them)."""
    recs = records(docs, slots)
    sums = written(slot_sizes(recs), "slots")
    slot_map = SlotMap(slots, shards)
    slot_map.rebalance(size_vector(sums, slots))
    return placed(recs, sums, slot_map), slot_map


def write_shards(docs: DataFrame, plan: DataFrame, path: str) -> None:
    """Write the rows of each shard into a folder of its own, in slot order.  One
    row of each group of equal rows joins the plan, which has a record for each."""
    whole = docs.withColumn("row_sha", F.unhex(leaf_hash([F.col(c) for c in docs.columns]))).dropDuplicates(["row_sha"])
    joined = whole.join(plan.select("row_sha", "shard", "slot"), "row_sha").drop("row_sha")
    (joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))


def op12_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    plan, slot_map = sharded(documents(spark, sf_dir).select("doc_id", "text"))
    slot_map = SlotMap.load(spark, slot_map.save(spark))  # what later runs would read
    return plan.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
                       F.lit(slot_map.version).alias("map_version"))
