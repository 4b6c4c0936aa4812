"""Queue replay against a plain FIFO, also when one queue spans many blocks."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from tallyspan.streaming import queue as Q


def fifo(ops, capacity):
    queue, fate, sizes = deque(), {}, []
    for seq, op in enumerate(ops):
        if op > 0:
            if len(queue) >= capacity:
                fate[queue.popleft()] = ("dropped", seq)
            queue.append(seq)
        elif op < 0 and queue:
            fate[queue.popleft()] = ("consumed", seq)
        sizes.append(len(queue))
    for seq in queue:
        fate[seq] = ("queued", None)
    return fate, sizes


@pytest.mark.parametrize("block", [7, 10_000])
def test_replay_matches_a_fifo(spark, block):
    rng = random.Random(5)
    ops = [rng.choice([1, 1, 1, -1, -1, 0]) for _ in range(300)]
    log = spark.createDataFrame([(0, i, o, int(o == 0)) for i, o in enumerate(ops)], "q int, seq long, op long, bump int")
    replayed = Q.replay(log, ["q"], 5, block=block)
    fate, sizes = fifo(ops, 5)
    assert [r["size_after"] for r in replayed.orderBy("seq").collect()] == sizes
    got = {r["put_seq"]: (r["fate"], r["out_seq"]) for r in Q.fates(replayed, ["q"]).collect()}
    assert got == fate
    s = Q.statistics(replayed, ["q"]).first()
    kinds = [k for k, _ in fate.values()]
    assert (s["produced"], s["dropped"], s["consumed"]) == (len(kinds), kinds.count("dropped"), kinds.count("consumed"))
    assert kinds.count("dropped") > 0


def test_streams_of_several_files_give_the_batch_result(spark, tmp_path):
    from tallyspan.streaming import live as S

    rows = [(f"n{i % 3}", float(i), i, i // 20) for i in range(120)]
    log = spark.createDataFrame(rows, "name string, value double, seq long, version long")
    for part in range(4):
        log.filter(f"seq >= {30 * part} and seq < {30 * part + 30}").coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = S.file_stream(spark, str(tmp_path / "log"))
    got = S.version_roll_up(stream).collect()
    key = lambda r: (r["version"], r["name"], r["last"], r["sum"], r["avg"], r["min"], r["max"])
    assert sorted(map(key, got)) == sorted(map(key, S.version_roll_up(log).collect()))
    assert S.run(stream).count() == 120


def files_out_of_order(spark, path, rows, schema, cuts):
    """Files whose rows are not in order of time, read one a trigger in the order of ``cuts``."""
    import os
    import time

    for n, (a, b) in enumerate(cuts):
        part = str(path / f"part{n}")
        spark.createDataFrame(rows[a:b], schema).coalesce(1).write.parquet(part)
        now = time.time() - 1000 + 10 * n  # files are read by age
        for name in os.listdir(part):
            os.utime(os.path.join(part, name), (now, now))
    from tallyspan.streaming import live as S

    return S.file_stream(spark, str(path / "part*"))


@pytest.mark.parametrize("form", ["tumbling", "sliding", "session"])
def test_windows_of_files_out_of_order_lose_no_row(spark, tmp_path, form):
    import datetime as dt

    from tallyspan.streaming import live as S

    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = sorted(((f"m{rng.randrange(2)}", float(rng.randrange(100)), start + dt.timedelta(minutes=rng.randrange(60 * 72))) for _ in range(400)), key=lambda r: r[2])
    schema = "name string, value double, ts timestamp"
    # the third file brings what is two days behind
    stream = files_out_of_order(spark, tmp_path, rows, schema, [(100, 200), (300, 400), (0, 100), (200, 300)])
    key = lambda r: (r["name"], r["start"], r["end"], r["n"], r["total"], r["top"])
    whole = sorted(map(key, S.windowed_metrics(spark.createDataFrame(rows, schema), form).collect()))
    assert sorted(map(key, S.windowed_metrics(stream, form).collect())) == whole
    in_time, late = S.windows_and_late(stream, form)
    late = late.collect()
    # by hand: a row is late if its last window had ended an hour before the latest time seen
    seen, want = None, []
    for trigger, (a, b) in enumerate([(100, 200), (300, 400), (0, 100), (200, 300)]):
        for name, value, ts in rows[a:b]:
            if form == "session":
                end = ts + dt.timedelta(minutes=30)
            else:
                step = 6 if form == "tumbling" else 2
                end = ts.replace(hour=ts.hour // step * step, minute=0) + dt.timedelta(hours=6)
            if seen is not None and end <= seen - dt.timedelta(hours=1):
                want.append((name, value, ts, trigger))
        seen = max([seen or start, *(r[2] for r in rows[a:b])])
    assert sorted((r["name"], r["value"], r["ts"], r["trigger"]) for r in late) == sorted(want) and len(want) > 100
    if form != "sliding":  # a row is in three sliding windows
        assert sum(r["n"] for r in in_time.collect()) + len(late) == 400


def test_batches_are_assembled_across_triggers(spark, tmp_path):
    from tallyspan.streaming import live as S

    rng = random.Random(8)
    rows = [(0 if rng.random() < 0.8 else rng.choice([1, None]), i) for i in range(500)]
    schema = "q long, seq long"
    cuts = [(0, 40), (40, 41), (41, 300), (300, 500)]
    stream = files_out_of_order(spark, tmp_path, rows, schema, cuts)
    got = sorted(map(tuple, S.assembled(stream, "q", "seq", 16).collect()), key=str)
    want, at = [], {}
    for q, seq in rows:
        n = at[q] = at.get(q, -1) + 1
        want.append((q, seq, n // 16, n % 16))
    want = [w for w in want if w[2] < (at[w[0]] + 1) // 16]
    assert got == sorted(want, key=str)
    nothing = S.file_stream(spark, str(tmp_path / "part*")).filter("seq < 0")
    assert S.assembled(nothing, "q", "seq", 16).count() == 0


def test_version_without_duration_has_a_ratio(spark):
    """Versions that begin and end in one second: 1 - 0 / 0, 1 - 2 / 0 and 1 - -2 / 0, as in SQL, and no error."""
    rows = [("a", 0, 1, 5.0, True), ("a", 1, 2, 5.0, True), ("a", 2, 3, 9.0, False), ("a", 2, 4, 10.0, True), ("a", 3, 5, 13.0, False)]
    rows += [("b", 0, 1, 5.0, False), ("b", 0, 2, 7.0, True), ("b", 1, 3, 5.0, False), ("b", 1, 4, 3.0, True), ("b", 2, 5, 5.0, False)]
    log = spark.createDataFrame(rows, "q string, version long, pos long, seconds double, paused boolean")
    got = {(r["q"], r["version"]): (r["active"], r["total"], str(r["idle_ratio"])) for r in Q.idle_ratios(log, ["q"]).collect()}
    assert got == {
        ("a", 0): (0.0, 0.0, "nan"), ("a", 1): (0.0, 4.0, "1.0"), ("a", 2): (1.0, 4.0, "0.75"),
        ("b", 0): (2.0, 0.0, "-inf"), ("b", 1): (-2.0, 0.0, "inf"),
    }


def test_queues_and_readiness_go_on_from_trigger_to_trigger(spark, tmp_path):
    """Several files, one a trigger, with a queue without name; no operator keeps a state in memory."""
    import os
    import time

    from tallyspan.streaming import live as S

    rng = random.Random(9)
    rows = [(rng.choice(["a", "a", None]), i, rng.choice([1, 1, 1, -1, -1, 0]), rng.choice("xyz")) for i in range(400)]
    log = spark.createDataFrame(rows, "q string, seq long, op long, field string")
    for part in range(4):
        folder = tmp_path / "parts" / str(part)
        log.filter(f"seq >= {100 * part} and seq < {100 * part + 100}").coalesce(1).write.parquet(str(folder))
        (name,) = folder.glob("part*")
        os.utime(name, (time.time() - 100 + part,) * 2)
    stream = S.file_stream(spark, str(tmp_path / "parts" / "*" / "part*"))
    got = {r["q"]: tuple(r)[1:] for r in S.queue_counters(stream, "q", 5).collect()}
    for q in ("a", None):
        fate, sizes = fifo([op for name, _, op, _ in rows if name == q], 5)
        kinds = [k for k, _ in fate.values()]
        gets = sum(op < 0 for name, _, op, _ in rows if name == q)
        consumed = kinds.count("consumed")
        assert got[q] == (len(kinds), consumed, kinds.count("dropped"), gets - consumed, sizes[-1])
    tasks = {"one": ["x"], "two": ["x", "y"], "none": ["x", "w"]}
    found = S.ready(stream.withColumnRenamed("q", "s"), "s", tasks)
    assert not any("State" in line for line in found._jdf.queryExecution().toString().splitlines())
    first = {(q, f): min(i for name, i, _, g in rows if (name, g) == (q, f)) for q in ("a", None) for f in "xy"}
    want = [(q, "one", first[q, "x"]) for q in ("a", None)] + [(q, "two", max(first[q, "x"], first[q, "y"])) for q in ("a", None)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_long_queues_begin_with_what_they_hold(spark):
    ops = [random.Random(3).choice([1, -1]) for _ in range(50)]
    ops += [1, 1, -1, -1, -1, 1] * 8
    log = spark.createDataFrame([(q, i, o) for q in ("a", None) for i, o in enumerate(ops)], "q string, seq long, op long")
    held = spark.createDataFrame([("a", 3), (None, 2)], "q string, queue_size long")
    for block in (7, 10_000):
        got = {q: [r["size_after"] for r in Q.replay(log, ["q"], 4, block=block, held=held).filter(F.col("q").eqNullSafe(q)).orderBy("seq").collect()] for q in ("a", None)}
        for q, size in (("a", 3), (None, 2)):
            assert got[q] == fifo([1] * size + ops, 4)[1][size:]
