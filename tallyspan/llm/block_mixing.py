"""Mixing sources to target weights by blocks, multinomial shard counts and index permutations.

Every source's words form one stream, document after document in a fixed order, cut into blocks of
``BLOCK`` words (the last one may be shorter). A source's target becomes a number of slots: whole
epochs of its blocks and a part of one more, whose last slot is cut so that the words meet the target.
The slots of all sources are dealt over output shards: each shard draws its counts by source from a
multinomial, seeded by the shard's number alone. Running sums over shards number the slots of a source
0, 1, 2 ...; the few that lie beyond a source's slots go, in order, to the sources that are short, so
that the totals are met exactly. Slot number i reads, in epoch i div blocks, the block that the
source's keyed permutation of that epoch maps i mod blocks to; an equi-join by source and block index
fetches the documents' spans. An epoch takes each block once, so no document is taken more often than
there are epochs.

Sources are few: one row per source (its words and documents) is held by the driver and sent to the
tasks. Documents, blocks and slots stay distributed, and a source that holds most of them is spread
over buckets, shards and blocks like any other.

Defined results: a null or empty text has size 0 and is never taken; null is a source of its own, last
in order; rows that share an id are documents of their own (identical rows share what one place
takes only by their order); a null id is kept; an empty table gives an empty result; a source without
words has target 0. Very long texts are many blocks. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import mixed, saved
from tallyspan.spread import df_col

#: Words of a block.
BLOCK = 64
#: Slots of an output shard.
SHARD_SLOTS = 1 << 16
#: Documents of a bucket, the unit in which a source is laid out, on average.
BUCKET = 1_000
#: No source is taken more often than this.
EPOCHS = 3
#: Shards whose counts are summed together.
_GROUP = 1_024
#: Slots of a batch.
_BATCH = 1 << 15
_ROUNDS = 6


def n_words(text: Column) -> Column:
    """Stretches without ASCII white space; 0 for null."""
    stretches = F.split(F.coalesce(text.cast("string"), F.lit("")), "[ \\x09-\\x0D]+")
    size = F.size(stretches)
    return (size - (F.element_at(stretches, 1) == "").cast("int") - ((size > 1) & (F.element_at(stretches, -1) == "")).cast("int")).cast("long")


def capped_targets(sizes: list[int], weights: list[int], epochs: int = EPOCHS) -> list[float]:
    """Shares of the sum of ``sizes`` by weight; what exceeds ``epochs`` times a size is shared anew."""
    targets = [0.0] * len(sizes)
    left, open_ = sum(sizes), list(range(len(sizes)))
    while open_:
        weight = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] > epochs * sizes[i] * weight]
        if not above:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in above:
            targets[i] = float(epochs * sizes[i])
        left -= sum(epochs * sizes[i] for i in above)
        open_ = [i for i in open_ if i not in set(above)]
    return targets


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1, element by element: a Feistel network over the next even
    power of two, walked until the value is in range."""
    half = np.maximum((np.ceil(np.log2(np.maximum(size, 2).astype(float))).astype(np.int64) + 1) // 2, 1).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    limit, key = size.astype(np.uint64), key.astype(np.uint64)
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in reversed(range(_ROUNDS)) if inverse else range(_ROUNDS):
            salt = k + np.uint64((r + 1) * 0x632BE59BD9B4E019 % (1 << 64))
            if inverse:
                left, right = right ^ (mixed(left ^ salt) & m), left
            else:
                left, right = right, left ^ (mixed(right ^ salt) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= limit[todo]]
    return out.astype(np.int64)


@dataclass
class Plan:
    """What the driver knows of each source: name, words, target, blocks, slots and the words of its last slot."""

    names: list[str | None]
    sizes: list[int]
    rows: list[int]
    targets: list[float]
    block: int
    seed: int

    def __post_init__(self) -> None:
        self.blocks = np.array([-(-s // self.block) for s in self.sizes], np.int64)
        slots, cut = [], []
        for i, (size, target) in enumerate(zip(self.sizes, self.targets)):
            want, n = round(target), int(self.blocks[i])
            epoch, rest = divmod(want, size) if size else (0, 0)
            count, last = epoch * n, self.block
            if rest:
                # the short block counts as one where the epoch's order puts it among the slots needed
                short = int(permuted(np.array([n - 1]), np.array([n]), self.keys(np.array([i]), np.array([epoch])), True)[0])
                lack = n * self.block - size
                m = -(-rest // self.block)
                if m > short:
                    m = -(-(rest + lack) // self.block)
                held = m * self.block - (lack if m > short else 0)
                full = self.block - (lack if m - 1 == short else 0)
                count, last = count + m, full - (held - rest)
            slots.append(count)
            cut.append(last)
        self.slots, self.cut = np.array(slots, np.int64), np.array(cut, np.int64)

    def keys(self, source: np.ndarray, epoch: np.ndarray) -> np.ndarray:
        """The key of a source's permutation in an epoch; it follows from the source's name."""
        named = np.array([zlib.crc32(f"{self.seed}:{n!r}".encode()) for n in self.names], np.uint64)
        return mixed(named[source] * np.uint64(1 << 20) + epoch.astype(np.uint64))


def laid_out(sized: DataFrame, plan: Plan, bucket: int = BUCKET) -> DataFrame:
    """``sized(doc_id, source, size)`` with ``rank`` (the source's number) and ``at``, the document's
    first word in the stream of its source. A source's order is by bucket, then id."""
    spark = sized.sparkSession
    rows = [(n, i, max(1, -(-r // bucket))) for i, (n, r) in enumerate(zip(plan.names, plan.rows))]
    table = spark.createDataFrame(rows, "mix_source string, rank int, buckets long")
    placed = sized.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("mix_source")))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size"), F.col("buckets")))
    inside = Window.partitionBy("rank", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # one row per bucket
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    starts = starts.select("rank", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("first"))
    joined = placed.join(starts, ["rank", "bucket"])
    return joined.select("doc_id", "source", "size", "rank", (F.col("first") + F.col("local")).alias("at"))


def blocks_of(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rank, block, offset, doc_id, at, start, length``: the document spans that make up each block."""
    last = F.floor((F.col("at") + F.col("size") - 1) / block)
    parts = docs.filter(F.col("size") > 0).select("rank", "doc_id", "size", "at", F.explode(F.sequence(F.floor(F.col("at") / block), last)).alias("block"))
    low = F.greatest(F.col("at"), F.col("block") * block)
    high = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block)
    return parts.select(
        "rank", "block", (low - F.col("block") * block).alias("offset"), "doc_id", "at", (low - F.col("at")).alias("start"), (high - low).alias("length")
    )


def _seeded(seed: int, shard: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=[seed, shard]))


def shard_counts(spark, plan: Plan, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``shard, size, rank, count, place``: the multinomial counts of every shard; ``place`` is the
    source's first place in the shard before the places are permuted."""
    total = int(plan.slots.sum())
    shares, seed = plan.slots / max(total, 1), plan.seed

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                size = min(shard_slots, total - shard * shard_slots)
                counts = _seeded(seed, shard).multinomial(size, shares)
                rank = np.flatnonzero(counts)
                place = (np.cumsum(counts) - counts)[rank]
                same = np.full(len(rank), shard, np.int64)
                cols = (same, np.full(len(rank), size, np.int64), rank.astype(np.int32), counts[rank].astype(np.int64), place.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["shard", "size", "rank", "count", "place"])

    return spark.range(-(-total // shard_slots)).mapInArrow(draw, "shard long, size long, rank int, count long, place long")


def slots_of(counts: DataFrame, plan: Plan) -> DataFrame:
    """``shard, place, rank, epoch, block, limit``: one row per output slot, with the block it reads and
    the words it takes of it at most."""
    group = (F.col("shard") / _GROUP).cast("long")
    counts = counts.withColumn("group", group)
    before = lambda *keys: Window.partitionBy("rank", *keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("rank", "group").agg(F.sum("count").alias("n"))
    groups = groups.select("rank", "group", F.coalesce(F.sum("n").over(before("group")), F.lit(0)).alias("first"))
    counts = counts.withColumn("local", F.coalesce(F.sum("count").over(before("group", "shard")), F.lit(0)))
    counts = counts.join(groups, ["rank", "group"]).select("shard", "size", "rank", "count", "place", (F.col("first") + F.col("local")).alias("first"))

    drawn = np.zeros(len(plan.names), np.int64)
    for row in counts.groupBy("rank").agg(F.sum("count").alias("n")).collect():  # one row per source
        drawn[row["rank"]] = row["n"]
    over, short = np.maximum(drawn - plan.slots, 0), np.maximum(plan.slots - drawn, 0)
    over_before, short_ends = np.cumsum(over) - over, np.cumsum(short)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for at in range(0, row["count"], _BATCH):
                    n = min(_BATCH, row["count"] - at)
                    index = row["first"] + at + np.arange(n)
                    rank = np.full(n, row["rank"], np.int64)
                    beyond = np.flatnonzero(index >= plan.slots[row["rank"]])
                    if len(beyond):
                        number = over_before[row["rank"]] + index[beyond] - plan.slots[row["rank"]]
                        to = np.searchsorted(short_ends, number, side="right")
                        rank[beyond] = to
                        index[beyond] = drawn[to] + number - (short_ends[to] - short[to])
                    size = plan.blocks[rank]
                    epoch = index // size
                    block = permuted(index % size, size, plan.keys(rank, epoch))
                    limit = np.where(index == plan.slots[rank] - 1, plan.cut[rank], plan.block)
                    shard = np.full(n, row["shard"], np.int64)
                    key = mixed(shard.astype(np.uint64) + np.uint64(plan.seed << 40))
                    place = permuted(row["place"] + at + np.arange(n), np.full(n, row["size"], np.int64), key)
                    cols = (shard, place, rank.astype(np.int32), epoch.astype(np.int32), block, limit.astype(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["shard", "place", "rank", "epoch", "block", "limit"])

    return counts.mapInArrow(expand, "shard long, place long, rank int, epoch int, block long, limit long")


@dataclass
class Mix:
    """``documents``: ``doc_id, source, size, rank, at``; ``spans``: ``shard, place, rank, epoch, block,
    offset, doc_id, at, start, length``, the words start .. start + length - 1 of a document in the slot
    at ``place`` of a shard; ``plan``: sizes and targets by source."""

    documents: DataFrame
    spans: DataFrame
    plan: Plan


def mix(
    docs: DataFrame,
    weights: dict[str | None, int] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
    bucket: int = BUCKET,
    epochs: int = EPOCHS,
    seed: int = 0,
) -> Mix:
    """The mix of all ``docs``. ``weights`` by source; by default 1, 2, 3 repeating, in code-point order."""
    spark = docs.sparkSession
    sized = docs.select(df_col(id_col).cast("long").alias("doc_id"), df_col(source_col).cast("string").alias("source"), n_words(df_col(text_col)).alias("size"))
    sized = saved(sized)
    found = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")).collect()
    # Python compares strings by code point
    found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
    names, sizes = [r["source"] for r in found], [r["words"] for r in found]
    weigh = [1 + i % 3 if weights is None else weights.get(n, 0) for i, n in enumerate(names)]
    plan = Plan(names, sizes, [r["rows"] for r in found], capped_targets(sizes, weigh, epochs), block, seed)
    documents = saved(laid_out(sized, plan, bucket))
    slots = slots_of(shard_counts(spark, plan, shard_slots), plan)
    # both sides grow with the input: neither is for a broadcast
    spans = slots.hint("merge").join(blocks_of(documents, block), ["rank", "block"])
    taken = F.least(F.col("offset") + F.col("length"), F.col("limit")) - F.col("offset")
    spans = spans.withColumn("length", taken).filter(F.col("length") > 0)
    return Mix(documents, spans.select("shard", "place", "rank", "epoch", "block", "offset", "doc_id", "at", "start", "length"), plan)


def taken_words(result: Mix) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken``."""
    spark, plan = result.documents.sparkSession, result.plan
    rows = [(i, s, t) for i, (s, t) in enumerate(zip(plan.sizes, plan.targets))]
    sources = spark.createDataFrame(rows, "rank int, source_size long, target double")
    # a document with words is known by its source and first word
    taken = result.spans.groupBy("rank", "at").agg(F.sum("length").alias("taken")).withColumnsRenamed({"rank": "taken_rank", "at": "taken_at"})
    same = (F.col("rank") == F.col("taken_rank")) & (F.col("at") == F.col("taken_at")) & (F.col("size") > 0)
    out = result.documents.join(taken.hint("merge"), same, "left").join(F.broadcast(sources), "rank")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
