"""Mixing, periodic runs and spelling variants against brute force, and their edge rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from tallyspan.llm import block_mixing, periodic_runs, spelling_groups

SCHEMA = "doc_id long, text string, source string, size long, rank int, block long, runs string, word string, n long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """rows: (doc_id, text, source); the other columns clash with those of the operators"""
    return spark.createDataFrame([(i, t, s, 7, 7, 7, "r", "w", 7) for i, t, s in rows], SCHEMA)


def documents(spark, sf):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]


# mixing


def targets(sizes, weights, times=3):
    """Water level by bisection: sum of min(level * weight, 3 * size) is the sum of sizes."""
    total, low, high = sum(sizes), 0.0, 3.0 * sum(sizes) + 1
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(mid * w, times * s) for w, s in zip(weights, sizes)) < total else (low, mid)
    return [min(low * w, times * s) for w, s in zip(weights, sizes)]


def mix_rows(spark, rows, **params):
    result = block_mixing.mix(frame(spark, rows), **params)
    return result, [r.asDict() for r in block_mixing.taken_words(result).collect()]


def assert_mixed(rows, got):
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((i or -1, len(WORD.findall(t or ""))) for i, t, _ in rows)
    by_source = defaultdict(list)
    for r in got:
        by_source[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in by_source[s]) for s in names]
    want = targets(sizes, [1 + i % 3 for i in range(len(names))])
    for s, size, target in zip(names, sizes, want):
        assert {r["source_size"] for r in by_source[s]} == {size}
        assert all(r["target"] == pytest.approx(target, rel=1e-9, abs=1e-6) for r in by_source[s])
        assert abs(sum(r["taken"] for r in by_source[s]) - target) <= 0.5 + 1e-6


@pytest.mark.parametrize(("block", "shard_slots", "bucket"), [(64, 1 << 16, 20_000), (7, 32, 3), (1, 5, 1)])
def test_mixing_meets_targets(spark, block, shard_slots, bucket):
    rng = random.Random(block)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["hot", "hot", "hot", "b", "é", "\U0001f600", None, "a"])) for i in range(120)]
    result, got = mix_rows(spark, rows, block=block, shard_slots=shard_slots, bucket=bucket)
    assert_mixed(rows, got)
    spans = [r.asDict() for r in result.spans.collect()]
    # every place of a shard is one slot; an epoch takes a block once; spans of a slot do not overlap
    slots = {(r["shard"], r["place"]): (r["rank"], r["epoch"], r["block"]) for r in spans}
    assert len(set(slots.values())) == len(slots) == int(result.plan.slots.sum())
    for shard in {k[0] for k in slots}:
        assert sorted(p for s, p in slots if s == shard) == list(range(sum(1 for s, _ in slots if s == shard)))
    covered = Counter()
    for r in spans:
        assert r["length"] > 0 and r["offset"] + r["length"] <= block
        for w in range(r["start"], r["start"] + r["length"]):
            covered[r["rank"], r["at"], w, r["epoch"]] += 1
    assert set(covered.values()) <= {1}


def test_mixing_is_repeatable_and_spread(spark):
    rows = [(i, "w " * 50, "ab"[i % 2]) for i in range(400)]
    first, second = (mix_rows(spark, rows, block=10, shard_slots=100) for _ in range(2))
    key = lambda r: r["doc_id"]
    assert sorted(first[1], key=key) == sorted(second[1], key=key)
    # multinomial counts differ between shards, and every shard draws from both sources
    counts = Counter((r["shard"], r["rank"]) for r in first[0].spans.select("shard", "rank").collect())
    assert len({n for (_, rank), n in counts.items() if rank == 0}) > 3
    assert all((s, rank) in counts for s in range(20) for rank in (0, 1))


def test_mixing_edge_rows(spark):
    rows = [(5, "a b c", "x"), (5, "a b c", "x"), (None, "d e", None), (None, None, None), (7, " \n\t", "y"), (8, "", "x"), (9, "é\x85b\xa0c f " + "long " * 9000, "z")]
    _, got = mix_rows(spark, rows)
    assert_mixed(rows, got)
    assert mix_rows(spark, [])[1] == []
    assert [(r["size"], r["target"], r["taken"]) for r in mix_rows(spark, [(1, None, "a"), (2, "", None)])[1]] == [(0, 0.0, 0)] * 2


def test_permutation_is_one_and_inverts():
    for size in (1, 2, 3, 5, 64, 1000, 4097):
        index = np.arange(size)
        to = block_mixing.permuted(index, np.full(size, size), np.full(size, 12345))
        assert sorted(to.tolist()) == index.tolist()
        assert (block_mixing.permuted(to, np.full(size, size), np.full(size, 12345), inverse=True) == index).all()


def test_op11_meets_targets_on_the_table(spark, sf):
    rows = documents(spark, sf)
    got = entry.queries()["op11_block_mixing"](spark, sf).collect()
    source = {i: s for i, _, s in rows}
    assert_mixed(rows, [{**r.asDict(), "source": source[r["doc_id"]]} for r in got])


# periodic runs


def runs_of(w):
    """All runs, by trying every period."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        k = q
        while k < n:
            if w[k] != w[k - q]:
                k += 1
                continue
            end = k
            while end < n and w[end] == w[end - q]:
                end += 1
            start = k - q
            if end - start >= max(6, 4 * q) and not any(w[start : end - p] == w[start + p : end] for p in range(1, q)):
                out.append((start, end - start, q))
            k = end
    return sorted(out)


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(rng):
    kind = rng.randrange(6)
    if kind < 2:
        return [str(rng.randrange(2 + kind)) for _ in range(rng.randrange(0, 90))]
    if kind == 2:
        out = []
        for _ in range(rng.randrange(1, 6)):
            root = [str(rng.randrange(4)) for _ in range(rng.randrange(1, 9))]
            out += (root * rng.randrange(1, 9))[: rng.randrange(1, 60)]
        return out
    if kind == 3:
        return ["a"] * rng.randrange(0, 80)
    if kind == 4:
        return [str(rng.randrange(50)) for _ in range(rng.randrange(0, 100))]
    return ([str(rng.randrange(2)) for _ in range(5)] * 3 + ["1"]) * rng.randrange(1, 8)


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        docs = [periodic_words(rng) for _ in range(rng.randrange(1, 30))]
        ids = {}
        words = np.array([ids.setdefault(w, len(ids)) for d in docs for w in d], np.int64)
        found = periodic_runs.find_runs(words, np.array([len(d) for d in docs]), len(ids))
        got = [[] for _ in docs]
        for d, *run in zip(*(c.tolist() for c in found)):
            got[d].append(tuple(run))
        assert got == [runs_of(d) for d in docs]


def test_runs_of_one_period_whatever_the_length():
    for n, period in ((50_000, 1), (60_000, 700), (4_000, 1_000)):
        words = np.tile(np.arange(period), n // period + 1)[:n]
        assert [c.tolist() for c in periodic_runs.find_runs(words, np.array([n]), period)] == [[0], [0], [n], [period]]
    thue_morse = np.array([i.bit_count() % 2 for i in range(1 << 14)])
    assert len(periodic_runs.find_runs(thue_morse, np.array([len(thue_morse)]), 2)[0]) == 0


@pytest.mark.parametrize("batch_bytes", [1, 300, 1 << 20])
def test_run_rows_do_not_depend_on_batches(spark, batch_bytes):
    rng = random.Random(9)
    texts = [" ".join(periodic_words(rng)) for _ in range(40)]
    texts += [None, "", " \n\t", "é\x85 é\x85\té\x85\né\x85\x0bé\x85\x0cé\x85", "x y " * 20_000, "x y " * 20_000]
    rows = [(i if i % 5 else None, t, "s") for i, t in enumerate(texts)]
    got = periodic_runs.periodic_runs(frame(spark, rows), batch_bytes=batch_bytes).collect()
    want = []
    for i, t, _ in rows:
        words = WORD.findall(t or "")
        runs = [(0, 40_000, 2)] if len(words) == 40_000 else runs_of(words)
        want.append((i, len(words), runs, collapsed(words, runs)))
    assert sorted([(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got], key=str) == sorted(want, key=str)
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def test_op12_equals_brute_force_on_the_table(spark, sf):
    want = {}
    for i, text, _ in documents(spark, sf):
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        ids = {}
        numbers = [ids.setdefault(w, len(ids)) for w in words]
        runs = runs_of(numbers) if n < 2_500 else None
        if runs is not None:
            best = min(((-n, s, q) for s, n, q in runs), default=None)
            four = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
            digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
            want[i] = (len(runs), *four, digest, hashlib.sha256(collapsed(words, runs).encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in entry.queries()["op12_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(documents(spark, sf))
    assert {i: got[i] for i in want} == want
    assert sum(1 for v in want.values() if v[0]) > 5


# spelling variants


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else len(b) - len(a) == 1 and a[i:] == b[i + 1 :])


def groups_of(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    # words one edit apart share what one deletion leaves of either
    holes = defaultdict(set)
    for w in words:
        for rest in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))}:
            holes[rest].add(w)
    near = {w: {v for rest in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))} for v in holes[rest] if one_edit(w, v)} for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def found_groups(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_sorted_list_scan_equals_all_pairs():
    rng = random.Random(1)
    for _ in range(200):
        letters = rng.choice(["ab", "abc", "abcdé"])
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 8))) for _ in range(rng.randrange(1, 60))})
        want = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])]
        assert sorted(spelling_groups.near_in(words)) == want


@pytest.mark.parametrize("limit", [spelling_groups.LIST, 40, 3])
def test_spelling_groups_equal_brute_force_however_lists_are_split(spark, limit):
    rng = random.Random(limit)
    counts = {"".join(rng.choice("abÿ") for _ in range(rng.randrange(4, 9))): rng.choice([2, 3, 4, 9, 20, 70]) for _ in range(700)}
    counts |= {"a" * k: 3 * 2 ** (k - 5) for k in range(5, 25)}  # a chain of forms
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found_groups(spelling_groups.spelling_groups(table, limit=limit)) == groups_of(counts)
    assert spelling_groups.near_pairs(table.filter("n > 8"), limit).count() == spelling_groups.near_pairs(table.filter("n > 8"), limit).distinct().count()


def test_word_count_edge_rows(spark):
    rows = [(1, None, "s"), (1, "", "s"), (2, "Abc×def ÀÉ aBC2abc", "s"), (2, "ABC", "s"), (None, "z" * 30_000 + " abc", "s")]
    got = dict(map(tuple, spelling_groups.word_counts(frame(spark, rows)).collect()))
    # × lies between À and ÿ and counts as one of them
    assert got == {"abc×def": 1, "ÀÉ": 1, "abc": 4, "z" * 30_000: 1}
    assert spelling_groups.spelling_groups(spelling_groups.word_counts(frame(spark, []))).count() == 0


def test_op13_equals_brute_force_on_the_table(spark, sf):
    counts = Counter()
    for i, text, _ in documents(spark, sf):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    got = found_groups(entry.queries()["op13_spelling_groups"](spark, sf))
    assert got == groups_of(counts)
    assert any(v[0] for v in got.values())
