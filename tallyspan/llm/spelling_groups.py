"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

Words are counted over all texts. Two words one edit apart (one code point inserted, deleted or
replaced) share the first or the last half of the shorter one, so each word is listed under both halves,
once for its own length and once for the next smaller one. A list that holds more than ``LIST`` words is
split again in the same way over what its words do not share yet, as often as needed, so that no list
grows with the vocabulary; once a single place is open, a list holds as many words as one or two letters
allow. A pair that shares both halves is taken from the first one only, so every pair is found once.

A task sorts its lists (those of last halves by the reversed word) and scans each once per word: the
banded rows of the edit matrix (three cells) of the shared prefix of neighbours in the list are kept, and
as soon as all cells of a row exceed one edit, the range of words with that prefix is skipped.

Forms (a word's most frequent near word, if at least twice as frequent) lead to larger and larger counts,
so that pointer doubling finds all roots in a number of rounds that follows from the largest count.

Defined results: a null or empty text has no words; rows that share an id are counted each; of very long
texts all words count; an empty table gives an empty result; ties between forms go to the smaller word in
code-point order. Extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import saved, utf8
from tallyspan.spread import attach, df_col

MIN_CHARS, MIN_COUNT = 5, 3
#: Words of a list at most.
LIST = 16_384
#: Rows of lists that a task scans, on average.
TASK_ROWS = 65_536
#: Distinct words that a task counts before it hands them on.
COUNTED = 200_000
RUNS = "[A-Za-zÀ-ÿ]+"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alter: Callable[[object, list[str]], list[str]] | None = None) -> DataFrame:
    """``word, n`` over all texts: maximal runs of letters, A-Z lower-cased. ``alter`` gets the id of a row
    and its distinct words and returns what each of them is counted as."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, held = re.compile(RUNS).findall, Counter()

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            texts = batch.column("text")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                found = Counter(runs(texts[i].as_py().lower().decode("utf-8", "replace")))  # bytes: A-Z alone
                if alter is None:
                    held.update(found)
                else:
                    for word, n in zip(alter(doc_id, list(found)), found.values()):
                        held[word] += n
                if len(held) > COUNTED:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    rows = docs.select(df_col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _split(rows: DataFrame) -> DataFrame:
    """Every row under the first and under the last half of what its list leaves open. Columns: ``word, n,
    least`` (length of a pair's shorter word), ``head, tail`` (code points that the list's words share at both
    ends), ``apart`` (a pair that shares so many first code points belongs to another list), ``last`` (a list
    of last halves)."""
    half = F.floor((F.col("least") - F.col("head") - F.col("tail")) / 2).cast("int")
    first = F.struct((F.col("head") + half).alias("head"), F.col("tail"), F.col("apart"), F.lit(False).alias("last"))
    second = F.struct(F.col("head"), (F.col("tail") + half).alias("tail"), (F.col("head") + half).alias("apart"), F.lit(True).alias("last"))
    both = rows.select("word", "n", "least", F.explode(F.array(first, second)).alias("h"))
    listed = both.select("word", "n", "least", "h.head", "h.tail", "h.apart", "h.last")
    # letters alone make words, so blanks keep the parts of a name apart
    named = F.concat_ws(" ", "least", "head", "tail", "apart", "last", F.left("word", F.col("head")), F.right("word", F.col("tail")))
    return listed.withColumn("list", named)


def lists_of(words: DataFrame, limit: int = LIST) -> DataFrame:
    """``list, last, apart, least, word, n``: every word in the lists in which its near words are."""
    size = F.length("word")
    none = F.lit(1 << 30).cast("int").alias("apart")
    zero = F.lit(0).cast("int")
    least = F.explode(F.array(size, size - 1)).alias("least")
    todo = words.select("word", "n", least, zero.alias("head"), zero.alias("tail"), none).filter(F.col("least") >= MIN_CHARS)
    out = None
    while True:
        sized = saved(attach(_split(todo), ["list"], list_size=F.count(F.lit(1))))
        small = (F.col("list_size") <= limit) | (F.col("least") - F.col("head") - F.col("tail") < 2)
        kept = sized.filter(small & (F.col("list_size") > 1))
        out = kept if out is None else out.unionByName(kept)
        todo = sized.filter(~small)
        if todo.isEmpty():
            return out


def _shared(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def near_in(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs i < j of a sorted list of distinct words that are one edit apart."""
    many = len(texts)
    shared = [0] * many
    for j in range(1, many):
        shared[j] = _shared(texts[j - 1], texts[j])
    for i, word in enumerate(texts):
        size, j = len(word), i + 1
        if j == many:
            return
        # row d: edits between d code points of the other word and d - 1, d, d + 1 of this one
        rows = [(2, 0, 1)] + [(1, 0, 1)] * shared[j]
        end = word + "\0\0"
        while j < many:
            other, d = texts[j], shared[j]
            del rows[d + 1 :]
            less, same, more = rows[d]
            bad = False
            for d in range(d, len(other)):
                c = other[d]
                # places before the word's first code point or behind its last cost too much by themselves
                at = less + (d == 0 or c != word[d - 1]) if d <= size else 2
                next_less = min(at, same + 1)
                next_same = min(same + (c != end[d]) if d < size else 2, more + 1, next_less + 1) if d + 1 <= size else 2
                next_more = min(more + (c != end[d + 1]), next_same + 1) if d + 2 <= size else 2
                less, same, more = next_less, next_same, next_more
                if less > 1 and same > 1 and more > 1:
                    bad = True
                    break
                rows.append((less, same, more))
            if bad:
                j = bisect_right(texts, other[: d + 1] + "\U0010ffff", j + 1)
                continue
            if -1 <= size - len(other) <= 1 and (less, same, more)[size - len(other) + 1] <= 1:
                yield i, j
            j += 1


def near_pairs(words: DataFrame, limit: int = LIST) -> DataFrame:
    """``word, n, near, near_n``: every unordered pair of ``words(word, n)`` one edit apart, once."""

    def pairs_of(rows: list[tuple]) -> Iterator[tuple]:
        _, last, apart, least, _, _ = rows[0]
        texts = [r[4][::-1] if last else r[4] for r in rows]
        for i, j in near_in(texts):
            a, b = rows[i], rows[j]
            if min(len(a[4]), len(b[4])) == least and _shared(a[4], b[4]) < apart:
                yield a[4], a[5], b[4], b[5]

    names = ["list", "last", "apart", "least", "word", "n"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        found: list[tuple] = []

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=["word", "n", "near", "near_n"])

        for batch in batches:
            for row in zip(*[batch.column(n).to_pylist() for n in names]):
                if held and held[0][0] != row[0]:
                    if len(held) > 1:
                        found.extend(pairs_of(held))
                    held = []
                    if len(found) > COUNTED:
                        yield handed()
                        found = []
                held.append(row)
        if held:
            found.extend(pairs_of(held))
        if found:
            yield handed()

    listed = lists_of(words, limit).select(*names)
    key = F.when(F.col("last"), F.reverse("word")).otherwise(F.col("word"))
    # scanning takes far longer than its bytes suggest: a task's share is counted in words
    parts = max(1, -(-4 * words.count() // TASK_ROWS))
    sorted_lists = listed.withColumn("key", key).repartition(parts, "list").sortWithinPartitions("list", "key").select(*names)
    return sorted_lists.mapInArrow(scan, "word string, n long, near string, near_n long")


def _roots(forms: DataFrame, largest: int) -> DataFrame:
    """``word, root`` for ``forms(word, form)``: where the forms end. Counts double with every form, so a
    chain has at most log2(largest) of them, and every round doubles what is covered."""
    links = saved(forms.select("word", F.col("form").alias("root")))
    for _ in range(max(largest.bit_length() - 1, 1).bit_length()):
        further = links.select(F.col("word").alias("via"), F.col("root").alias("end"))
        links = saved(links.join(further, F.col("root") == F.col("via"), "left").select("word", F.coalesce("end", "root").alias("root")))
    return links


def spelling_groups(counts: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, times: int = 2, limit: int = LIST) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of the words in ``counts(word, n)`` that have ``min_chars`` code
    points (never fewer than five) and occur ``min_count`` times. ``times``: how much more frequent a form is."""
    if min_chars < MIN_CHARS or times < 2:
        raise ValueError("words have at least five code points and forms are at least twice as frequent")
    words = saved(counts.filter((F.length("word") >= min_chars) & (F.col("n") >= min_count)))
    pairs = near_pairs(words, limit)
    ways = [F.struct(F.col(a).alias("word"), F.col(b).alias("near"), F.col(c).alias("near_n")) for a, b, c in (("word", "near", "near_n"), ("near", "word", "n"))]
    both = pairs.select(F.explode(F.array(*ways)).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    known = words.join(best, "word", "left")
    frequent: Column = -F.col("best.less") >= times * F.col("n")
    known = saved(
        known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *[F.when(frequent, c).alias(a) for a, c in (("form", F.col("best.near")), ("form_n", -F.col("best.less")))])
    )
    largest = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(known.filter(F.col("form").isNotNull()), largest)
    return known.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
