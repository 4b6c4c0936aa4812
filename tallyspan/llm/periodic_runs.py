"""Periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of words with smallest period q and at least max(6, 4 q) words that no neighbouring
word extends with period q. The words of a batch of documents become ids, and Re-Pair replaces repeated
pairs of neighbouring symbols by nonterminals, the more frequent of overlapping pairs first, until a
round shortens the batch by less than ``LEAST_GAIN``; no pair crosses two documents. What is left of a
document is halved again and again, so that its start rule is a balanced tree of pairs. Every rule, a
nonterminal or a node of such a tree, has one inner boundary. The runs that cross it inside the rule's
words are computed once, on one occurrence of the rule: a period must leave the words at the boundary
equal to those one period before or after it, and hashes of prefixes give the reach to both sides. They
are then translated to all positions that derive the rule. What a rule's edge cuts short is part of a
run found at a larger rule, so stretches of one period that overlap by a period or more are merged.
Every run found is compared word by word, so a collision of hashes cannot show in the result.

A batch holds at most ``BATCH_BYTES`` of text or a single document; work and memory grow with
n log n of its words, whatever the words are. Runs do not depend on the grouping into batches.

Defined results: a null, empty or blank text has no words and no runs; rows that share an id and ids
that are null are rows like any other; of very long texts all words count; an empty table gives an empty
result. Extra columns are not read. Bytes that are no ASCII white space belong to words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyspan.llm.common import utf8
from tallyspan.spread import df_col

#: Text of a batch.
BATCH_BYTES = 3 << 20
#: Re-Pair ends when a round removes a smaller share of the symbols.
LEAST_GAIN = 0.02
#: Candidates that are tested at a time.
_CHUNK = 1 << 18
#: Two moduli and two bases of the prefix hashes.
_PRIMES = (2_147_483_647, 2_147_483_629)
_BASES = (911_382_323, 972_663_749)

MIN_LENGTH, MIN_PERIODS = 6, 4


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0 .. count - 1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


class Prefixes:
    """Hashes of all stretches of a sequence."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.sums, self.powers = [], []
        for prime, base in zip(_PRIMES, _BASES):
            powers = np.ones(n + 1, np.uint64)
            filled = 1
            step = base % prime
            while filled < n + 1:  # powers of 0 .. filled - 1 give the next ones
                more = min(filled, n + 1 - filled)
                powers[filled : filled + more] = powers[:more] * np.uint64(pow(step, filled, prime)) % np.uint64(prime)
                filled += more
            terms = (words.astype(np.uint64) + np.uint64(1)) * powers[:n] % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)]))
            self.powers.append(powers)

    def same(self, at: np.ndarray, period: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Are the ``length`` words from ``at`` those from ``at - period``?"""
        equal = np.ones(len(at), bool)
        for prime, sums, powers in zip(_PRIMES, self.sums, self.powers):
            p = np.uint64(prime)
            here = (sums[at + length] - sums[at]) % p
            there = (sums[at - period + length] - sums[at - period]) % p * powers[period] % p
            equal &= here == there
        return equal

    def reach(self, at: np.ndarray, period: np.ndarray, limit: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``at`` on (or before ``at``) equal those a period earlier, up to ``limit``."""
        low, high = np.zeros(len(at), np.int64), limit.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(at if forward else at - mid, period, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def crossing(words: np.ndarray, prefixes: Prefixes, low: np.ndarray, inner: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """``rule, start, end, period`` of the runs inside low .. high - 1 that hold both words at ``inner``."""
    found = []
    most = (high - low) // MIN_PERIODS
    ends = np.cumsum(most)
    at = 0
    while at < len(most):
        to = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _CHUNK, side="right")), at + 1)
        found.append(_crossing(words, prefixes, low[at:to], inner[at:to], high[at:to], most[at:to], at))
        at = to
    return tuple(np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found) if found else [()] * 4))


def _crossing(words, prefixes, low, inner, high, most, first):
    rule = np.repeat(np.arange(len(most)), most)
    period = _ramp(most) + 1
    b, lo, hi = inner[rule], low[rule], high[rule]
    # of a run of four periods, two lie on one side of the boundary: the words there have an equal one in it
    found = []
    for back in (True, False):
        fits = np.flatnonzero(b - 1 - period >= lo if back else b + period < hi)
        at = b[fits] if back else b[fits] + period[fits]
        for shift in (0, 1):
            equal = words[at - shift] == words[at - shift - period[fits]]
            fits, at = fits[equal], at[equal]
        # the stretch around that place in which every word equals the one a period before it
        q = period[fits]
        ahead = prefixes.reach(at, q, hi[fits] - at, True)
        behind = prefixes.reach(at, q, at - lo[fits] - q, False)
        start, end = at - behind - q, at + ahead
        good = end - start >= np.maximum(MIN_PERIODS * q, MIN_LENGTH)
        found.append((rule[fits[good]], start[good], end[good], q[good]))
    rule, start, end, period = map(np.concatenate, zip(*found))
    # a stretch found with several periods has the smallest
    order = np.lexsort((period, end, start, rule))
    rule, start, end, period = rule[order], start[order], end[order], period[order]
    new = np.ones(len(rule), bool)
    new[1:] = (rule[1:] != rule[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    rule, start, end, period = rule[new], start[new], end[new], period[new]
    length = end - start - period
    spots = np.repeat(start + period, length) + _ramp(length)
    equal = words[spots] == words[spots - np.repeat(period, length)]
    if not equal.all():
        raise ArithmeticError("two different stretches of words have one hash")
    return rule + first, start, end, period


def _chosen(left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of neighbours (``joined``: in one document) are replaced in this round, and a number
    of each pair. A pair gives way to an overlapping one that is more frequent."""
    spots = np.flatnonzero(joined)
    code = left[spots] << np.int64(32) | right[spots]
    _, number, count = np.unique(code, return_inverse=True, return_counts=True)
    priority = np.zeros(len(left) + 2, np.int64)
    place = np.empty(len(count), np.int64)
    place[np.lexsort((np.arange(len(count)), count))] = np.arange(1, len(count) + 1)
    priority[spots + 1] = np.where(count[number] > 1, place[number], 0)
    here = priority[1:-1]
    best = (here > 0) & (here >= priority[:-2]) & (here >= priority[2:])
    picked = np.flatnonzero(best)
    if not len(picked):
        return picked, picked
    # equal pairs that overlap (a a a): every other one
    opens = np.concatenate([[True], np.diff(picked) > 1])
    group_start = picked[np.maximum.accumulate(np.where(opens, np.arange(len(picked)), 0))]
    picked = picked[(picked - group_start) % 2 == 0]
    own = here[picked]
    _, own, again = np.unique(own, return_inverse=True, return_counts=True)
    return picked[again[own] > 1], own[again[own] > 1]


def _grammar(words: np.ndarray, document: np.ndarray, n_ids: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Re-Pair, round by round: ``rule, low, inner, high`` of every replaced pair (its place in the text),
    and last, with rule None, the places where the symbols that are left begin."""
    symbol, at, next_id = words.astype(np.int64), np.arange(len(words)), n_ids
    while len(symbol) > 1:
        joined = document[at[1:]] == document[at[:-1]]
        picked, rule = _chosen(symbol[:-1], symbol[1:], joined)
        if not len(picked):
            break
        ends = np.append(at[1:], len(words))
        yield rule, at[picked], at[picked + 1], ends[picked + 1]
        symbol[picked] = next_id + rule
        next_id += int(rule.max()) + 1
        keep = np.ones(len(symbol), bool)
        keep[picked + 1] = False
        before = len(symbol)
        symbol, at = symbol[keep], at[keep]
        if len(symbol) > before * (1 - LEAST_GAIN):
            break
    yield None, at, at, at


def _halved(first: np.ndarray, last: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``low, inner, high`` of the nodes of balanced trees over symbols first .. last - 1 of each document."""
    while True:
        many = last - first > 1
        first, last = first[many], last[many]
        if not len(first):
            return
        mid = (first + last) // 2
        yield starts[first], starts[mid], starts[last]
        first, last = np.concatenate([first, mid]), np.concatenate([mid, last])


def find_runs(words: np.ndarray, sizes: np.ndarray, n_ids: int) -> tuple[np.ndarray, ...]:
    """``document, start, length, period`` of all runs, in this order, over documents of ``sizes`` words,
    one after the other in ``words`` (ids below ``n_ids``)."""
    document = np.repeat(np.arange(len(sizes)), sizes)
    prefixes = Prefixes(words)
    found = [np.zeros((3, 0), np.int64)]
    for rule, low, inner, high in _grammar(words, document, n_ids):
        if rule is not None:
            order = np.argsort(rule, kind="stable")
            rule, low, inner, high = rule[order], low[order], inner[order], high[order]
            one = np.flatnonzero(np.concatenate([[True], rule[1:] != rule[:-1]]))
            times = np.diff(np.append(one, len(rule)))
            which, start, end, period = crossing(words, prefixes, low[one], inner[one], high[one])
            # all positions that derive the rule
            n = times[which]
            to = low[np.repeat(one[which], n) + _ramp(n)] - np.repeat(low[one[which]], n)
            found.append(np.stack([np.repeat(start, n) + to, np.repeat(end, n) + to, np.repeat(period, n)]))
        else:
            starts = np.append(low, len(words))
            of = document[low]
            docs, first = np.unique(of, return_index=True)
            for lo, mid, hi in _halved(first, np.append(first[1:], len(low)), starts):
                found.append(np.stack(crossing(words, prefixes, lo, mid, hi)[1:]))
    start, end, period = np.concatenate(found, axis=1)
    # merge what overlaps by a period or more; documents never share a run
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    top, stretch = int(len(words)) + 1, period.copy()
    reach = np.maximum.accumulate(end + stretch * (2 * top)) - stretch * (2 * top) if len(end) else end
    fresh = np.ones(len(start), bool)
    fresh[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > reach[:-1])
    if len(start):
        fresh[1:] |= document[start[1:]] != document[start[:-1]]
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(start)) - 1
    start, end, period = start[head], reach[tail] if len(head) else end[head], period[head]
    of = document[start] if len(start) else start
    before = np.cumsum(sizes) - sizes
    order = np.lexsort((period, start, of))
    return of[order], (start - before[of])[order], (end - start)[order], period[order]


def covered(n: int, starts: np.ndarray, lengths: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts + periods, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:n]) > 0


def _batch(rows: list[tuple[object, bytes]]) -> dict[str, list]:
    texts = [text.split() for _, text in rows]
    known: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, int(sizes.sum()))
    of, start, length, period = find_runs(words, sizes, len(known))
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    out: dict[str, list] = {"doc_id": [r[0] for r in rows], "n_words": sizes.tolist(), "runs": [], "collapsed": []}
    for i, text in enumerate(texts):
        part = slice(bounds[i], bounds[i + 1])
        s, n, q = start[part], length[part], period[part]
        out["runs"].append([{"start": a, "length": b, "period": c} for a, b, c in zip(s.tolist(), n.tolist(), q.tolist())])
        if len(s):
            text = [w for w, gone in zip(text, covered(len(text), s, n, q).tolist()) if not gone]
        out["collapsed"].append(b" ".join(text).decode("utf-8", "replace"))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row: runs (``start, length, period``, in words) by start, then
    period, and the text without the words that repeat a run's first period."""
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            rows, held = [], 0
            for i, doc_id in enumerate(ids):
                text = texts[i].as_py()
                if rows and held + len(text) > batch_bytes:
                    yield pa.RecordBatch.from_pydict(_batch(rows), schema=arrow)
                    rows, held = [], 0
                rows.append((doc_id, text))
                held += len(text)
            if rows:
                yield pa.RecordBatch.from_pydict(_batch(rows), schema=arrow)

    return docs.select(df_col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text")).mapInArrow(run, schema)
