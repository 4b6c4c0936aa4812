"""Byte-level BPE with a rank queue over a hierarchical bitmap.

The queue holds one bucket per merge rank. A bucket keeps positions in the linked list of symbols; a
bitmap of three levels marks the filled buckets, and find-first-set on each level gives the next
rank. An entry whose symbols have been merged since is stale and skipped. So a piece of n bytes takes
about n log n steps however long it is, where repeated search takes n * n.

Text is split by a pattern; a piece that is a token is that token, any other is merged. All short
pieces of a batch that are new share one queue: their symbols stand in one array, a bucket holds the
positions of a rank in all of them, and taking a bucket merges the first position of every piece at
once. A long piece has a queue of its own. Pieces are encoded once as long as a task remembers them.
Decoding joins the bytes of the ids.

Defined results: a null text is an empty one and has no ids; an unknown id fails on decoding; the
same row twice gives the same result twice. Extra columns pass through; one named like the result is
replaced by it.
"""

from __future__ import annotations

import array
import base64
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyspan.llm.common import few_rows, free_names, remembered, utf8
from tallyspan.spread import df_col

#: Pieces longer than this have a queue of their own and are not remembered.
SHORT_BYTES = 64
#: Pieces that a task remembers, texts whose new pieces share a queue.
CACHE_PIECES, TOGETHER = 250_000, 2048
_BITS = 64


_LOOSE_MARK = re.compile(r"[\W_][,.]|^[,.]").search


class Bitmap:
    """A set of ranks; ``first`` finds the smallest by find-first-set on three levels."""

    def __init__(self):
        self.top = 0  # bit i: mid[i] has a bit
        self.mid: dict[int, int] = {}
        self.low: dict[int, int] = {}

    def add(self, rank: int) -> None:
        word, bit = divmod(rank, _BITS)
        group, place = divmod(word, _BITS)
        self.low[word] = self.low.get(word, 0) | 1 << bit
        self.mid[group] = self.mid.get(group, 0) | 1 << place
        self.top |= 1 << group

    def first(self) -> int:
        group = (self.top & -self.top).bit_length() - 1
        word = group * _BITS + (self.mid[group] & -self.mid[group]).bit_length() - 1
        return word * _BITS + (self.low[word] & -self.low[word]).bit_length() - 1

    def remove(self, rank: int) -> None:
        word, bit = divmod(rank, _BITS)
        group, place = divmod(word, _BITS)
        self.low[word] &= ~(1 << bit)
        if not self.low[word]:
            self.mid[group] &= ~(1 << place)
            if not self.mid[group]:
                self.top &= ~(1 << group)


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


class Bpe:
    """Encoder for a file of ranks (lines of base64 token and rank) and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.pieces = regex.compile(pattern).findall
        # does the pattern end pieces where _chunks cuts?
        self.cuts = self.pieces("a b,\nc1. d") == ["a", " b", ",", "\n", "c", "1", ".", " d"]
        self.known: dict[str, bytes] = {}
        # every way to make a token of two tokens
        get, keys, ranks = self.ranks.get, array.array("q"), array.array("i")
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = get(token[:i]), get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        order = np.argsort(np.array(keys))
        self.pair_keys, self.pair_ranks = np.array(keys)[order], np.array(ranks, np.int64)[order]
        self.byte_ids = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the joined symbols, -1 where they make no token."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (left >= 0) & (right >= 0), self.pair_ranks[at], -1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece, by a queue of its own."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        size = [1] * n  # bytes of the symbol that begins here, 0 where none does
        before = list(range(-1, n - 1))
        get, filled, buckets = self.ranks.get, Bitmap(), {}

        def push(rank: int | None, position: int) -> None:
            if rank is None:
                return
            if rank in buckets:
                heapq.heappush(buckets[rank], position)
            else:
                buckets[rank] = [position]
                filled.add(rank)

        for i in range(n - 1):
            push(get(piece[i : i + 2]), i)
        while filled.top:
            rank = filled.first()
            i = heapq.heappop(buckets[rank])
            if not buckets[rank]:
                del buckets[rank]
                filled.remove(rank)
            j = i + size[i]
            if not size[i] or j >= n or get(piece[i : j + size[j]]) != rank:
                continue  # stale: a symbol has grown or is gone
            size[i], size[j] = size[i] + size[j], 0
            after = i + size[i]
            if after < n:
                before[after] = i
                push(get(piece[i : after + size[after]]), i)
            if before[i] >= 0:
                push(get(piece[before[i] : after]), before[i])
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : i + size[i]]])
            i += size[i]
        return ids

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of many pieces by one queue, as little-endian 32-bit numbers."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(data)
        owner = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        ends = np.cumsum(sizes)
        symbol = self.byte_ids[data]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        current = np.full(n, -1, np.int32)  # rank of the pair that begins here
        inner = np.flatnonzero(after >= 0).astype(np.int32)
        current[inner] = self._rank(symbol[inner], symbol[after[inner]])
        buckets: dict[int, list[np.ndarray]] = {}
        filled = Bitmap()

        def push(at: np.ndarray, rank: np.ndarray) -> None:
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for r, a, b in zip(rank[starts].tolist(), starts, [*starts[1:], len(at)]):
                if r in buckets:
                    buckets[r].append(at[a:b])
                else:
                    buckets[r] = [at[a:b]]
                    filled.add(r)

        push(inner, current[inner])
        while filled.top:
            rank = filled.first()
            some = buckets.pop(rank)
            filled.remove(rank)
            at = some[0] if len(some) == 1 else np.concatenate(some)
            at = np.unique(at[current[at] == rank])  # the others are stale
            if not len(at):
                continue
            first = np.ones(len(at), bool)
            first[1:] = owner[at[1:]] != owner[at[:-1]]
            if not first.all():
                buckets[rank] = [at[~first]]
                filled.add(rank)
                at = at[first]
            gone = after[at]
            follow = after[gone]
            symbol[at], symbol[gone], after[at] = rank, -1, follow
            current[gone] = current[at] = -1
            more = follow >= 0
            before[follow[more]] = at[more]
            ahead, left = at[more], before[at]
            behind = left[left >= 0]
            current[ahead] = self._rank(symbol[ahead], symbol[follow[more]])
            current[behind] = self._rank(symbol[behind], symbol[after[behind]])
            both = np.concatenate([ahead, behind])
            push(both, current[both])
        alive = symbol >= 0
        ids = symbol[alive].astype("<i4").tobytes()
        stops = (4 * np.cumsum(np.bincount(owner[alive], minlength=len(pieces)))).tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops)]

    def _learn(self, chunks: set[str]) -> None:
        """Encode new chunks: all their new pieces together, then the chunks from pieces."""
        ranks, known, single = self.ranks, self.known, []
        split: dict[str, list[str]] = {}
        for chunk in chunks:
            if self.cuts and (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
                single.append(chunk)
            else:
                split[chunk] = self.pieces(chunk)
        pieces = set(single).union(*split.values())
        new: list[str] = []
        for piece in pieces - known.keys():
            data = piece.encode("utf-8")
            if data in ranks:
                known[piece] = np.array([ranks[data]], "<i4").tobytes()
            elif len(data) > SHORT_BYTES:
                known[piece] = np.array(self.merge(data), "<i4").tobytes()
            else:
                new.append(piece)
        if new:
            known.update(zip(new, self.merge_all([p.encode("utf-8") for p in new])))
        known.update((c, b"".join(map(known.__getitem__, parts))) for c, parts in split.items())

    def _even(self, text: str) -> bool:
        """Is white space single blanks and line ends among other characters, and does every comma and
        full stop follow a letter or digit? Then pieces end there."""
        if not self.cuts or not text or text[0].isspace() or text[-1].isspace() or "\0" in text:
            return False
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _LOOSE_MARK(text):
            return False
        return len(text.split()) == text.count(" ") + text.count("\n") + 1

    def _chunks(self, text: str, even: bool) -> list[str]:
        """The text cut before blanks, commas and full stops and around line ends, if that is even;
        else its pieces."""
        if not even:
            return self.pieces(text)
        text = text.replace(" ", "\0 ").replace(",", "\0,").replace(".", "\0.")
        return list(filter(None, text.replace("\n", "\0\n\0").split("\0")))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        out: list[bytes] = []
        for at in range(0, len(texts), TOGETHER):
            if len(self.known) > CACHE_PIECES:
                self.known.clear()
            some, new = [(t, self._even(t)) for t in texts[at : at + TOGETHER]], set()
            for text, even in some:
                new.update(self._chunks(text, even))
            new -= self.known.keys()
            if new:
                self._learn(new)
            out += [b"".join(map(self.known.__getitem__, self._chunks(t, even))) for t, even in some]
            for piece in [p for p in new if len(p) > SHORT_BYTES]:
                del self.known[piece]
        return out


class Tokens:
    """Decoder: the bytes of all tokens in one array."""

    def __init__(self, path: str):
        tokens = sorted((rank, token) for token, rank in read_ranks(path).items())
        self.size = np.zeros(tokens[-1][0] + 1, np.int32)
        self.size[[rank for rank, _ in tokens]] = [len(token) for _, token in tokens]
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(token for _, token in tokens), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids in turn."""
        size = self.size[ids]
        if len(ids) and not size.all():
            raise ValueError("an id is no token")
        begin = self.start[ids] - (np.cumsum(size) - size)
        return self.data[np.repeat(begin, size) + np.arange(int(size.sum()))].tobytes()


def _kept_table(key: tuple, make: Callable[[], object]) -> object:
    """Tables of a worker process: one may encode in a task and decode in the next."""
    tables = remembered("bpe", dict)
    if key not in tables:
        tables[key] = make()
    return tables[key]


def bpe(path: str, pattern: str) -> Bpe:
    """One table of ranks per worker process."""
    return _kept_table((path, pattern), lambda: Bpe(path, pattern))


def tokens(path: str) -> Tokens:
    return _kept_table((path,), lambda: Tokens(path))


def _mapped(df: DataFrame, work: str, out: str, kind: T.DataType, columns: list[str], make: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """``columns`` of ``df``, and ``out`` made from the column ``work`` a few rows at a time."""
    few_rows(df.sparkSession)
    schema = T.StructType([*(df.schema[c] for c in columns), T.StructField(out, kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                made = [*(batch.column(c) for c in columns), make(batch.column(work))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(made, arrow)], schema=arrow)

    return df.select(*[df_col(c) for c in (*columns, work)]).mapInArrow(run, schema)


def _kept(docs: DataFrame, columns: list[str] | None, out: str) -> list[str]:
    return [c for c in (docs.columns if columns is None else columns) if c.lower() != out.lower()]


def encode(docs: DataFrame, ranks: str, pattern: str, text_col: str = "text", out: str = "ids", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``columns``) with the token ids of the text as ``array<int>``."""
    (work,) = free_names(docs, "text_bytes")

    def ids(texts: pa.Array) -> pa.Array:
        coded = bpe(ranks, pattern).encode_all([t.decode("utf-8", "replace") for t in texts.to_pylist()])
        ends = np.cumsum([0, *(len(x) // 4 for x in coded)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")))

    return _mapped(docs.withColumn(work, utf8(text_col)), work, out, T.ArrayType(T.IntegerType()), _kept(docs, columns, out), ids)


def decode(docs: DataFrame, ranks: str, ids_col: str = "ids", out: str = "decoded", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``columns``) with the bytes that the ids stand for; null ids give null."""
    (work,) = free_names(docs, "ids_read")

    def joined(ids: pa.Array) -> pa.Array:
        return pa.array([None if x is None else tokens(ranks).decode(x.values.to_numpy()) for x in ids], pa.binary())

    return _mapped(docs.withColumn(work, df_col(ids_col)), work, out, T.BinaryType(), _kept(docs, columns, out), joined)
