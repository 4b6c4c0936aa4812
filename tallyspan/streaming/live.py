"""Structured Streaming forms of batch operators, from a stream of files.

Every function takes a streaming DataFrame. ``run`` drains what is available into a shared folder
and hands the result back as a table. ``drain`` does so for operators that keep nothing in the memory of
executors: what a trigger adds, partial aggregates say, is written to a folder of that trigger, which a
trigger that is run again replaces, and a reader puts the parts together. Rows may then come in any
order and in any number of files; what comes later than a watermark allows goes to a table of its own.

Queue counters go on from the sizes that the trigger before left; a queue's events have to arrive in the
order of ``seq`` from trigger to trigger, as a log does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspan.operators.filters import drop_overlong
from tallyspan.sources.sinks import shared_folder
from tallyspan.spread import attach_table, ranked
from tallyspan.streaming.queue import readiness, replay, statistics


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files as a stream, with the schema of the files."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run(stream: DataFrame, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """Drain the stream. "append" keeps all rows, "complete" the last result, "update" the last row of each
    key. Every batch has a folder of its own, which a batch that is run again replaces."""
    spark = stream.sparkSession
    out, state = shared_folder(spark, "stream"), shared_folder(spark, "stream-state")

    def sink(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/__batch={batch}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", state).foreachBatch(sink).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.parquet(out)
    if mode == "append":
        return rows.drop("__batch")
    if mode == "complete":
        last = rows.agg(F.max("__batch").alias("__last"))
        return rows.join(F.broadcast(last), rows["__batch"] == last["__last"]).drop("__batch", "__last")
    cols = [c for c in rows.columns if c not in keys and c != "__batch"]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "__batch").alias("__r"))
    return latest.select(*keys, "__r.*")


#: What a trigger makes of its rows, its number and a reader of earlier triggers' tables: tables by name.
Step = Callable[[DataFrame, int, Callable[[str], DataFrame]], dict[str, DataFrame]]


def drain(stream: DataFrame, step: Step) -> dict[str, DataFrame]:
    """The tables that ``step`` makes, all triggers together, with their number in ``__batch``."""
    spark = stream.sparkSession
    out, state = shared_folder(spark, "stream"), shared_folder(spark, "stream-state")

    def earlier(batch: int) -> Callable[[str], DataFrame]:
        return lambda name: spark.read.parquet(f"{out}/{name}").filter(F.col("__batch") < batch)

    def sink(df: DataFrame, batch: int) -> None:
        for name, part in step(df, batch, earlier(batch)).items():
            part.write.mode("overwrite").parquet(f"{out}/{name}/__batch={batch}")

    # empty tables of trigger -1, so that there is always something to read
    empty = spark.createDataFrame([], stream.schema)
    shapes = step(empty, -1, lambda name: empty)
    for name, part in shapes.items():
        part.limit(0).write.parquet(f"{out}/{name}/__batch=-1")
    query = stream.writeStream.option("checkpointLocation", state).foreachBatch(sink).trigger(availableNow=True).start()
    query.awaitTermination()
    return {name: spark.read.parquet(f"{out}/{name}") for name in shapes}


def assembled(samples: DataFrame, queue: str, order: str, size: int) -> DataFrame:
    """Batches of ``size`` samples as they fill up: ``train_batch, slot`` per sample; the rest waits.

    A trigger numbers its samples after those of the triggers before it, of which only the counts are read;
    a queue with most samples is ranked by many tasks.
    """

    def step(df: DataFrame, batch: int, earlier: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        if batch < 0:
            before = df.select(F.col(queue).alias("__q"), F.lit(0).cast("long").alias("__n"))
        else:
            before = earlier("counts").groupBy(F.col(queue).alias("__q")).agg(F.sum("n").alias("__n"))
        placed = ranked(df.select(queue, order), [queue], [order], "__p")
        placed = placed.join(before, F.col(queue).eqNullSafe(F.col("__q")), "left")
        at = F.coalesce("__n", F.lit(0)) + F.col("__p") - 1
        counts = df.groupBy(queue).agg(F.count(F.lit(1)).alias("n"))
        return {"samples": placed.select(queue, order, at.cast("long").alias("at")), "counts": counts}

    tables = drain(samples, step)
    full = tables["counts"].groupBy(queue).agg((F.floor(F.sum("n") / size) * size).alias("__full"))
    placed = attach_table(tables["samples"].drop("__batch"), [queue], full, ["__full"]).filter(F.col("at") < F.col("__full"))
    return placed.select(queue, order, F.floor(F.col("at") / size).alias("train_batch"), (F.col("at") % size).alias("slot"))


def queue_counters(events: DataFrame, queue: str, capacity: int) -> DataFrame:
    """Counters of each bounded queue when the stream is drained: ``seq`` and ``op`` as in the batch replay.

    A trigger replays its events block by block from the sizes at which the triggers before it left the
    queues, and hands on its counters and sizes, a row for each of its queues.
    """

    def step(df: DataFrame, batch: int, earlier: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        held = None if batch < 0 else earlier("counters").groupBy(queue).agg(F.max_by("queue_size", "__batch").alias("queue_size"))
        return {"counters": statistics(replay(df.select(queue, "seq", "op"), [queue], capacity, held=held), [queue])}

    counters = drain(events, step)["counters"]
    sums = [F.sum(c).alias(c) for c in ("produced", "consumed", "dropped", "empty_gets")]
    return counters.groupBy(queue).agg(*sums, F.max_by("queue_size", "__batch").alias("queue_size"))


def ready(arrivals: DataFrame, sample: str, tasks: dict[str, Sequence[str]]) -> DataFrame:
    """``task, ready_seq`` per sample once all its fields have arrived, each pair once.

    A trigger hands on when each of the fields that a task needs came first; nothing is kept in memory.
    """
    needed = sorted({f for fields in tasks.values() for f in fields})

    def step(df: DataFrame, batch: int, earlier: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        return {"first": df.filter(F.col("field").isin(needed)).groupBy(sample, "field").agg(F.min("seq").alias("seq"))}

    return readiness(drain(arrivals, step)["first"], sample, tasks)


def _version_parts(log: DataFrame) -> DataFrame:
    last = F.max(F.struct("seq", "value")).alias("last")
    return log.groupBy("version", "name").agg(last, F.sum("value").alias("sum"), F.count("value").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"))


def _versions_of(parts: DataFrame) -> DataFrame:
    merged = parts.groupBy("version", "name").agg(F.max("last").alias("last"), F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"))
    return merged.select("version", "name", F.col("last.value").alias("last"), "sum", F.try_divide("sum", "n").alias("avg"), "min", "max")


def version_roll_up(log: DataFrame) -> DataFrame:
    """Metric statistics per parameter version, of a table or a stream; ``metrics.step_rule`` picks one of
    them. A stream writes the parts of each trigger; no version is kept in memory."""
    if not log.isStreaming:
        return _versions_of(_version_parts(log))
    return _versions_of(drain(log, lambda df, batch, earlier: {"parts": _version_parts(df)})["parts"])


def growing_dataset(rows: DataFrame, length: Column, limit: int) -> DataFrame:
    """New rows that pass the length filter, appended as they come."""
    return drop_overlong(rows, length, limit)


WINDOWS: dict[str, Callable[[Column], Column]] = {
    "tumbling": lambda ts: F.window(ts, "6 hours"),
    "sliding": lambda ts: F.window(ts, "6 hours", "2 hours"),
    "session": lambda ts: F.session_window(ts, "30 minutes"),
}


def _window_parts(log: DataFrame, form: str) -> DataFrame:
    d = log.groupBy("name", WINDOWS[form](F.col("ts")).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("value").alias("top"))
    return d.select("name", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total", "top")


def _windows_of(parts: DataFrame, form: str) -> DataFrame:
    keys = ["name", "start", "end"]
    if form == "session":
        # parts of one session overlap; there is at most one part for each stretch between two pauses of a trigger
        order = Window.partitionBy("name").orderBy("start", "end")
        reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
        parts = parts.withColumn("__new", (reach.isNull() | (F.col("start") >= reach)).cast("int"))
        parts = parts.withColumn("__session", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        parts = parts.groupBy("name", "__session").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("top").alias("top"))
        return parts.drop("__session")
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("top").alias("top"))


def windows_and_late(log: DataFrame, form: str, late: str = "1 hour") -> tuple[DataFrame, DataFrame]:
    """Of a stream ``name, value, ts``: the windows of the rows that come in time, and the late rows.

    A row is late if all its windows had ended when its trigger began, by the latest time seen before that
    less ``late``. Windows are kept as parts by trigger; late rows are kept whole, with the trigger that
    brought them.
    """
    last_end = {"tumbling": "6 hours", "sliding": "6 hours", "session": "30 minutes"}[form]

    def step(df: DataFrame, batch: int, earlier: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
        seen = None if batch < 0 else earlier("seen").agg(F.max("top_ts")).first()[0]  # one row a trigger
        if seen is None:
            gone = F.lit(False)
        else:
            limit = F.lit(seen) - F.expr(f"INTERVAL {late}")
            # a row's latest window begins at the last step at or before it
            begin = F.col("ts") if form == "session" else F.window("ts", "6 hours" if form == "tumbling" else "2 hours")["start"]
            gone = begin + F.expr(f"INTERVAL {last_end}") <= limit
        marked = df.select("name", "value", "ts").withColumn("__gone", gone)
        return {
            "parts": _window_parts(marked.filter(~F.col("__gone")), form),
            "late": marked.filter("__gone").drop("__gone"),
            "seen": df.agg(F.max("ts").alias("top_ts")),
        }

    tables = drain(log, step)
    return _windows_of(tables["parts"].drop("__batch"), form), tables["late"].withColumnRenamed("__batch", "trigger")


def windowed_metrics(log: DataFrame, form: str, late: str = "1 hour") -> DataFrame:
    """Count, sum and maximum per metric and time window; works on tables and on streams. Of a stream, the
    late rows (see ``windows_and_late``) are added to their windows in the end, so that none is lost."""
    if not log.isStreaming:
        return _window_parts(log, form)
    in_time, behind = windows_and_late(log, form, late)
    return _windows_of(in_time.unionByName(_window_parts(behind, form)), form)
