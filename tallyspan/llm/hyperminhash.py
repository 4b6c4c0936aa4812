"""Near-duplicate documents by HyperMinHash.

Every document's word shingles fall into ``BUCKETS`` buckets; a bucket keeps the leading-zero count
and ten mantissa bits of its smallest hash in a 16-bit register. Bands of registers are join keys.
Each bucket of equal band keys has one hub, its member of lowest priority number, the same document
for most bands of a family. Members of one hub meet in blocks; in a block, pairs that could still
link two components are estimated from registers, corrected for register collisions, and confirmed
on the full shingle sets. A block returns a spanning forest, so neither pairs nor copies multiply.

Documents with equal shingle sets are one class before any of this, so thousands of copies cost one
aggregation. Work in a hub's blocks grows with the square of the number of its *different* texts
(only for members that still share enough shingles with another member); memory does not.

Defined results: no word = empty set, linked with nothing; fewer words than a shingle has = one
shingle, the whole sequence; a null id takes no part (component null, kept true); rows that share an
id are one document of the graph. Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import WordHashes, forget, in_batches, mixed, saved, utf8, word_windows
from tallyspan.spread import durable

BUCKETS, MANTISSA, BAND = 160, 10, 5
#: Members of a hub that meet in one task are two blocks of this many at most.
BLOCK = 512
#: Two minima of equal expected size share a register without being equal at about this rate.
COLLISION = 0.169919487 * 2.0 ** (1 - MANTISSA)
#: Estimates this many standard deviations below the threshold are not confirmed.
SLACK = 4.5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_set(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: words split at ASCII white space, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    return np.unique(word_windows(h, min(size, len(h))))


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers: 0 for an empty bucket, else 1 + (leading zeros, mantissa bits)."""
    low = np.full(BUCKETS, _EMPTY, np.uint64)
    bucket = ((shingles >> np.uint64(32)) * np.uint64(BUCKETS)) >> np.uint64(32)
    np.minimum.at(low, bucket.astype(np.int64), mixed(shingles ^ np.uint64(0x5851F42D4C957F2D)))
    zeros = (53 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
    mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return np.where(low == _EMPTY, 0, (zeros << np.uint64(MANTISSA)) + mantissa + np.uint64(1)).astype(np.uint16)


def band_keys(regs: np.ndarray) -> list[int]:
    """One 64-bit key per band that has a filled register."""
    bands = regs.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(len(bands), dtype=np.uint64)
    for column in bands.T:
        key = mixed(key * np.uint64(65537) + column)
    return key[bands.any(axis=1)].view(np.int64).tolist()


def estimate(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimate of one register row against many, and the buckets it rests on."""
    filled = ((one != 0) | (many != 0)).sum(axis=1)
    equal = ((one == many) & (one != 0)).sum(axis=1)
    share = equal / np.maximum(filled, 1)
    return (share - COLLISION) / (1 - COLLISION), filled


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def forest(ids: list[int], sets: list[np.ndarray], hub: int, side: list[int], cross: bool, percent: int) -> list[tuple[int, int]]:
    """Links among the documents: a spanning forest of all pairs at or above the threshold.

    With ``cross`` only pairs of different sides matter, besides those with the hub.
    """
    n, parent = len(ids), list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    # a document whose shingles are mostly found nowhere else here links with nothing here
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    common = values[counts > 1]
    shared = [int(np.isin(s, common, assume_unique=True).sum()) for s in sets]
    alive = np.array([100 * c >= percent * len(s) and len(s) > 0 for c, s in zip(shared, sets)])
    size = np.array([len(s) for s in sets])
    if hub in ids:
        h = ids.index(hub)
        for i in np.flatnonzero(alive):
            if i != h and linked(sets[h], sets[i], percent):
                parent[root(i)] = root(h)
    regs = np.stack([registers(s) for s in sets])
    at, limit = np.array(side), percent / 100
    for i in np.flatnonzero(alive):
        label = np.array([root(j) for j in range(i + 1, n)])
        maybe = alive[i + 1 :] & (label != root(i))
        maybe &= 100 * np.minimum(size[i], size[i + 1 :]) >= percent * np.maximum(size[i], size[i + 1 :])
        if cross:
            maybe &= at[i + 1 :] != at[i]
        rest = np.flatnonzero(maybe) + i + 1
        if not len(rest):
            continue
        guess, filled = estimate(regs[i], regs[rest])
        near = guess >= limit - SLACK * np.sqrt(limit * (1 - limit) / np.maximum(filled, 1))
        for j in rest[near][np.argsort(-guess[near], kind="stable")].tolist():
            if root(i) != root(j) and linked(sets[i], sets[j], percent):
                parent[root(j)] = root(i)
    least: dict[int, int] = {}
    for i in range(n):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [(ids[i], least[root(i)]) for i in range(n) if least[root(i)] != ids[i]]


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Per document: ``doc_id, text_hash, n_shingles, digest`` of the set, ``keys`` of the bands."""
    hashes = WordHashes()

    def sign(batch: dict[str, list]) -> dict[str, list]:
        forget()
        out = {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "n_shingles": [], "digest": [], "keys": []}
        for text in batch["text"]:
            s = shingle_set(text, shingle, hashes)
            out["n_shingles"].append(len(s))
            out["digest"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            out["keys"].append(band_keys(registers(s)) if len(s) else [])
        return out

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    return in_batches(rows, sign, "doc_id long, text_hash long, n_shingles long, digest binary, keys array<long>")


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links(a, b)``: the smallest id it reaches.

    Each round takes the least label of the neighbours and of the label itself; a round that
    changes nothing is the last. Every round is written to the shared folder.
    """
    links = durable(links.select("a", "b").distinct())
    both = links.union(links.select("b", "a")).toDF("id", "other")
    labels = durable(both.groupBy("id").agg(F.least("id", F.min("other")).alias("label")))
    while True:
        near = both.join(labels.toDF("other", "l"), "other").groupBy("id").agg(F.min("l").alias("near"))
        jump = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        moved = labels.join(near, "id").join(jump, "label").select("id", "label", F.least("label", "near", "far").alias("new"))
        moved = durable(moved)
        if not moved.filter(F.col("new") != F.col("label")).limit(1).count():
            return moved.select("id", "label")
        labels = moved.select("id", F.col("new").alias("label"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * |A & B| >= percent * |A | B| for their sets of ``shingle``
    consecutive words; a component is named by its smallest id.
    """
    hashes = WordHashes()
    signed = saved(signatures(docs, id_col, text_col, shingle))
    named = signed.filter(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    first = F.struct("doc_id", "text_hash")
    classes = named.groupBy("digest").agg(F.min(first).alias("first"), F.first("keys").alias("keys"))
    classes = saved(classes.select("digest", F.col("first.doc_id").alias("rep"), F.col("first.text_hash").alias("text_hash"), "keys"))
    bands = classes.select("rep", "text_hash", F.explode("keys").alias("key"))
    by_priority = F.struct(F.xxhash64("rep").alias("priority"), "rep", "text_hash")
    hubs = bands.groupBy("key").agg(F.min(by_priority).alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    member = bands.join(hubs.select("key", "hub"), "key")
    member = saved(member.select(F.col("hub.rep").alias("hub"), "rep", "text_hash").distinct())
    # members of a hub are dealt over blocks, and every pair of blocks is one group
    sizes = member.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = member.join(sizes, "hub").withColumn("own", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int"))
    meet = dealt.select("hub", "rep", "text_hash", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meet = meet.select("hub", "rep", "text_hash", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    # the hub itself is in every group
    groups = sizes.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), "blocks")
    groups = groups.select("hub", "i", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)).alias("j"))
    own_hub = member.filter(F.col("hub") == F.col("rep")).join(groups, "hub").select("hub", "rep", "text_hash", F.lit(-1).alias("own"), "i", "j")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("rep"), utf8(text_col).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    met = meet.filter(F.col("hub") != F.col("rep")).unionByName(own_hub).join(texts, ["rep", "text_hash"])

    def confirm(table: pa.Table) -> pa.Table:
        forget()
        rows = table.to_pydict()
        seen = {}
        for rep, text, own in zip(rows["rep"], rows["text"], rows["own"]):
            seen.setdefault(rep, (text, own))
        ids = sorted(seen)
        sets = [shingle_set(seen[i][0], shingle, hashes) for i in ids]
        links = forest(ids, sets, rows["hub"][0], [seen[i][1] for i in ids], rows["i"][0] != rows["j"][0], percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    links = met.groupBy("hub", "i", "j").applyInArrow(confirm, "a long, b long")
    label = components(links)
    rep = classes.select("digest", "rep").join(label.toDF("rep", "label"), "rep", "left")
    rep = rep.select("digest", F.coalesce("label", "rep").alias("component_id"))
    out = signed.select("doc_id", "n_shingles", "digest").join(rep, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
