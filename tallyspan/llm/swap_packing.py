"""Best-fit packing of documents into sequences, improved by swaps.

Documents become token ids and are cut only where they are longer than a sequence. A full piece is a
sequence of its own; the rest are dealt at random over shards of about ``SHARD`` documents, a shard
being a task's work whatever the size of the input. In a shard, pieces go longest first into the
fullest sequence that has room. Then a local search takes every open sequence as the source, the
emptiest first, and moves one or two of its pieces into a gap, exchanges one piece for a shorter one
of another sequence, or two pieces for one, whenever the sum of squared fills grows; a source that
runs empty is gone. The search ends at the lower bound or when a pass over all finds nothing.

Defined results: a null text is an empty one and holds its end token alone; rows that share an id are
packed each; a null id is kept as it is; no document, no sequence. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyspan.llm.common import released, remembered, saved
from tallyspan.spread import df_col

#: Bytes that a worker's memory of stretches and their ids may hold, and what an entry takes by itself.
CACHE_BYTES, _ENTRY = 48 << 20, 240
#: Bytes of text that are cut together.
BATCH_BYTES = 4 << 20
#: Documents of a shard, on average.
SHARD = 20_000
#: Sequence numbers of full pieces start here.
_FULL = 1 << 62


class WordIds:
    """Ids (little-endian unsigned 32-bit) of texts, by the stretches between ASCII white space.

    White space separates tokens and is dropped by the tokenizer, so these stretches can be encoded on
    their own. ASCII marks (but no apostrophe) between a letter or digit and white space are tokens of
    their own and are cut off; A-Z are lower-cased, as the tokenizer does. Arrow cuts the texts of a batch
    and numbers its distinct stretches; each of those is looked up once, and Arrow puts the ids together.
    New words of Latin letters go to the tokenizer together, as one text, and are told apart by the tokens
    that end a word. What is remembered is bounded in bytes: of two halves the older one goes, and what it
    has that is asked for again moves to the younger one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.ends = ends
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, new: list[str]) -> None:
        """Encode new stretches; words go together, as one text."""
        plain = [w for w in new if w.isalpha() and max(w) < _LATIN_END]
        for at in range(0, len(plain), 4096):
            some = plain[at : at + 4096]
            ids = self._ids(" ".join(some))
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) == len(some):
                data = ids.tobytes()
                self.known.update(zip(some, (data[a:b] for a, b in zip([0, *stops], stops))))
        rest = [w for w in new if w not in self.known]
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.known.update(zip(some, (np.array(e.ids, "<u4").tobytes() for e in encoded)))

    def _look_up(self, words: list[str]) -> list[bytes]:
        if self.held > CACHE_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
        absent = [w for w in words if w not in self.known]
        if absent:
            old = {w: ids for w, ids in zip(absent, map(self.older.get, absent)) if ids is not None}
            self.known.update(old)
            if len(old) < len(absent):
                self._learn([w for w in absent if w not in old])
        found = [self.known[w] for w in words]
        self.held += _ENTRY * len(absent) + sum(map(len, absent))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number by text."""
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts.fill_null("")), _MARKS, r"\1 \2\3"))
        coded = lists.flatten().dictionary_encode()
        data = self._look_up(coded.dictionary.to_pylist())
        sizes = np.fromiter((len(d) // 4 for d in data), np.int64, len(data))
        store = pa.array(np.frombuffer(b"".join(data), "<u4"))
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        at = coded.indices
        ids = pa.ListArray.from_arrays(pa.array(starts), store).take(at).flatten().to_numpy(zero_copy_only=False)
        before = np.concatenate([[0], np.cumsum(sizes[at.to_numpy(zero_copy_only=False)])])
        ends = before[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return ids, np.diff(ends)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        ids, counts = self.encode(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


_LATIN_END = "\u0250"  # letters before it are composed and have plain lower-case forms
_MARKS = r"([\p{L}\p{N}])([!-&(-/:-@\[-`{-~]+)([ \t\n\r]|$)"


def word_ids(path: str) -> WordIds:
    """One tokenizer per worker process."""
    return remembered(f"words {path}", lambda: WordIds(path))


def _cut(ids: np.ndarray, counts: np.ndarray, capacity: int, end_id: int) -> dict[str, pa.Array]:
    """Pieces of documents of ``counts`` ids, to each of which the end is added: ``row, piece, start, length, ids``."""
    total = counts + 1
    last = np.cumsum(total) - 1
    filled = np.full(int(total.sum()), end_id, "<u4")
    body = np.ones(len(filled), bool)
    body[last] = False
    filled[body] = ids
    many = -(-total // capacity)
    row = np.repeat(np.arange(len(counts)), many)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    start = piece * capacity
    length = np.minimum(total[row] - start, capacity)
    offsets = np.concatenate([[0], 4 * np.cumsum(length)]).astype(np.int32)
    held = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(filled)])
    return {"row": pa.array(row), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length), "ids": held}


def text_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``size`` bytes of ``text``, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")), at + 1)
            yield batch.slice(at, to - at)
            at = to


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids`` (ids: little-endian unsigned 32-bit) of every document."""
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for batch in text_batches(batches, BATCH_BYTES):
            out = _cut(*words.encode(batch.column("text")), capacity, end_id)
            out["doc_id"] = batch.column("doc_id").take(out["row"])
            yield pa.RecordBatch.from_arrays([out[n] for n in names], names=names)

    rows = docs.select(df_col(id_col).cast("long").alias("doc_id"), F.coalesce(df_col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(lambda batches: released(run(batches)), "doc_id long, piece int, start long, length long, ids binary")


class Shard:
    """Sequences of one shard: ``bins[b]`` holds piece numbers, ``room[b]`` the free tokens."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.len, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []

    def fit(self) -> None:
        """Best fit, longest first; a bit set over the free sizes finds the tightest sequence."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms = 0
        for i in np.argsort(-self.len, kind="stable").tolist():
            size = int(self.len[i])
            enough = rooms >> size
            if enough:
                room = size + (enough & -enough).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    rooms &= ~(1 << room)
            else:
                room, b = self.capacity, len(self.bins)
                self.bins.append([])
                self.room.append(room)
            self.bins[b].append(i)
            self.room[b] = left = room - size
            if left:
                by_room[left].append(b)
                rooms |= 1 << left

    def improve(self) -> None:
        """Moves and swaps that raise the sum of squared fills, from every open sequence, the emptiest
        first, until a pass over them finds none or the lower bound is reached. The sum is an integer
        that only grows, so the passes end."""
        least = -(-int(self.len.sum()) // self.capacity)
        self.used = len(self.bins)
        self.free = np.array(self.room, dtype=np.int64)
        self.home = np.zeros(len(self.len), np.int64)
        for b, items in enumerate(self.bins):
            self.home[items] = b
        by_length = np.argsort(self.len, kind="stable")
        changed = True
        while changed:
            changed = False
            open_bins = np.flatnonzero((self.free > 0) & (self.free < self.capacity))
            # a full sequence is never a target again; a gap stands before the pieces, as one of no length
            inside = by_length[self.free[self.home[by_length]] > 0]
            self.item = np.concatenate([np.full(len(open_bins), -1), inside])
            self.size = np.concatenate([np.zeros(len(open_bins), np.int64), self.len[inside]])
            self.gap_of = open_bins
            for source in open_bins[np.argsort(-self.free[open_bins], kind="stable")].tolist():
                while self.used > least and self.bins[source] and (self._move(source) or self._swap(source)):
                    changed = True
            if self.used <= least:
                return

    def _shift(self, out: list[int], back: list[int], source: int, target: int) -> None:
        for items, old, new in ((out, source, target), (back, target, source)):
            for i in items:
                self.bins[old].remove(i)
                self.bins[new].append(i)
                self.home[i] = new
                self.free[old] += self.len[i]
                self.free[new] -= self.len[i]
        self.used -= not self.bins[source]

    def _move(self, source: int) -> bool:
        """One piece into the tightest gap that takes it with a gain, the longest piece first."""
        for i in sorted(self.bins[source], key=lambda i: -self.len[i]):
            fits = (self.free >= self.len[i]) & (self.free < self.free[source] + self.len[i]) & (self.free < self.capacity)
            fits[source] = False
            gap = np.where(fits, self.free, self.capacity + 1)
            target = int(gap.argmin())
            if gap[target] <= self.capacity:
                self._shift([i], [], source, target)
                return True
        return False

    def _swap(self, source: int) -> bool:
        """One or two pieces of the source for one shorter piece elsewhere, or two for a gap, with the
        largest step. A step of g into a sequence with r free tokens gains if g <= r < free + g."""
        where = np.concatenate([self.gap_of, self.home[self.item[len(self.gap_of) :]]])
        room = self.free[where]
        # of a piece and its sequence's room together: an offer of n tokens gains from n to n + free - 1
        reach = np.where((where == source) | (room >= self.capacity), -1, self.size + room)
        own = sorted(self.bins[source], key=lambda i: -self.len[i])
        offers = {int(self.len[i]): [i] for i in reversed(own)}
        for k, i in enumerate(own):
            for j in own[k + 1 :]:
                offers.setdefault(int(self.len[i] + self.len[j]), [i, j])
        best, choice, free = 0, None, int(self.free[source])
        for total in sorted(offers, reverse=True):
            if total <= best:
                break
            near = reach[: np.searchsorted(self.size, total - best)]
            hit = (near >= total) & (near < total + free)
            at = int(hit.argmax()) if len(hit) else 0
            if len(hit) and hit[at]:
                best, choice = total - int(self.size[at]), (offers[total], at)
        if choice is None:
            return False
        out, at = choice
        self._shift(out, [int(self.item[at])] if self.item[at] >= 0 else [], source, int(where[at]))
        return True


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number (dense) and offset of each piece."""
    shard = Shard(lengths, capacity)
    shard.fit()
    shard.improve()
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0
    for items in shard.bins:
        if not items:
            continue
        at = 0
        for i in items:
            where[i], offset[i] = number, at
            at += int(lengths[i])
        number += 1
    return where, offset


def pack(parts: DataFrame, capacity: int = 2048, shard: int = SHARD) -> DataFrame:
    """``parts`` (with ``doc_id, piece, length``) and ``sequence_id, offset``. A full piece is a sequence; the
    others, one of a document at most, are dealt over shards by their place in the table, so that neither a
    long document nor repeated or missing ids meet in one shard."""
    parts = saved(parts)  # the places stay the same if a task runs again
    place = F.monotonically_increasing_id()
    names = parts.columns
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    arrow = to_arrow_schema(schema)
    full = parts.filter(F.col("length") >= capacity).select(*names, (place + F.lit(_FULL)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = parts.filter(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // shard))

    def put(table: pa.Table) -> pa.Table:
        number = table.column("shard")[0].as_py()
        table = table.drop_columns(["shard"]).sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("length", "ascending")])
        where, offset = pack_lengths(table.column("length").to_numpy(), capacity)
        table = table.append_column("sequence_id", pa.array((number << 40) + where)).append_column("offset", pa.array(offset))
        return table.cast(arrow)

    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", place), F.lit(shards)).cast("long"))
    return dealt.groupBy("shard").applyInArrow(put, schema).unionByName(full)


def pack_documents(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, shard: int = SHARD
) -> DataFrame:
    """Pieces of all documents, token ids included, with their ``sequence_id`` and ``offset``."""
    return pack(pieces(docs, tokenizer, id_col, text_col, capacity, end_id), capacity, shard)
