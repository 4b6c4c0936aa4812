"""Registered queries of the streaming family, on the events as a queue log."""

from pyspark.sql import functions as F

from tallyspan.operators import filters as X
from tallyspan.plans import register
from tallyspan.plans.advantage import r6
from tallyspan.sources import views as V
from tallyspan.sources.views import with_views
from tallyspan.streaming import live as S
from tallyspan.streaming import queue as Q

CAP = 40


def as_queue_log(e):
    """purchase, click and view put a sample, signup gets one, error bumps the version; users share three queues,
    and one of them has most of the events."""
    op = F.when(F.col("event_type").isin("purchase", "click", "view"), 1).when(F.col("event_type") == "signup", -1).otherwise(0)
    return e.select(
        F.when(F.col("user_id") % 10 < 8, 0).otherwise(F.col("user_id") % 10 - 7).cast("long").alias("queue"),
        F.col("event_id").alias("seq"),
        # expensive events take a sample too, which keeps the queue moving
        F.when(F.col("event_type") == "signup", -1).when(F.col("value") < 60, op).otherwise(-F.abs(op)).cast("long").alias("op"),
        (F.col("event_type") == "error").cast("int").alias("bump"),
        F.unix_timestamp(F.col("ts")).cast("double").alias("seconds"),
        F.col("event_type").alias("name"),
        "value",
    )


def log(spark, sf):
    return as_queue_log(V.table(spark, sf, "events"))


LOG = """l AS (SELECT CASE WHEN user_id % 10 < 8 THEN 0 ELSE user_id % 10 - 7 END AS queue, event_id AS seq,
 CAST(CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'signup' THEN -1 WHEN value < 60 THEN 1 ELSE -1 END AS BIGINT) AS op, CAST(event_type = 'error' AS INTEGER) AS bump, CAST(floor(epoch(ts)) AS DOUBLE) AS seconds, event_type AS name, value FROM events),
 p AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY seq) AS pos, sum(bump) OVER (PARTITION BY queue ORDER BY seq) AS version FROM l)"""
# the size after each event by recursion over positions
REPLAY = f"""WITH RECURSIVE {LOG}, z(queue, pos, before, after) AS (SELECT queue, pos, 0::BIGINT, least(greatest(op, 0), {CAP}) FROM p WHERE pos = 1
 UNION ALL SELECT p.queue, p.pos, z.after, least(greatest(z.after + p.op, 0), {CAP}) FROM z JOIN p ON p.queue = z.queue AND p.pos = z.pos + 1),
 r AS (SELECT p.*, z.before AS size_before, z.after AS size_after, op > 0 AND z.before >= {CAP} AS dropped, op < 0 AND z.before > 0 AS took FROM p JOIN z USING (queue, pos))"""


def replayed(spark, sf):
    return Q.replay(log(spark, sf), ["queue"], CAP)


def versioned(spark, sf):
    return Q.replay(Q.with_version(log(spark, sf), ["queue"]), ["queue"], CAP)


STATS = "SELECT queue, count(*) FILTER (op > 0) AS produced, count(*) FILTER (took) AS consumed, count(*) FILTER (dropped) AS dropped, count(*) FILTER (op < 0 AND NOT took) AS empty_gets, arg_max(size_after, pos) AS queue_size FROM r GROUP BY 1"
register("queue_replay", f"{REPLAY} SELECT queue, seq, size_before, size_after, dropped, took FROM r")(
    lambda spark, sf: replayed(spark, sf).select("queue", "seq", "size_before", "size_after", "dropped", "took")
)
register("queue_statistics", f"{REPLAY} {STATS}")(lambda spark, sf: Q.statistics(replayed(spark, sf), ["queue"]))
register("queue_statistics_stream", f"{REPLAY} {STATS}")(
    lambda spark, sf: S.queue_counters(as_queue_log(S.file_stream(spark, f"{sf}/events*.parquet")), "queue", CAP)
)
FATES = """a AS (SELECT queue, seq, row_number() OVER (PARTITION BY queue ORDER BY seq) AS n FROM r WHERE op > 0), b AS (SELECT queue, seq, took, version, row_number() OVER (PARTITION BY queue ORDER BY seq) AS n FROM r WHERE dropped OR took),
 f AS (SELECT a.queue, a.seq AS put_seq, b.seq AS out_seq, CASE WHEN took THEN 'consumed' WHEN b.seq IS NOT NULL THEN 'dropped' ELSE 'queued' END AS fate, b.version FROM a LEFT JOIN b USING (queue, n))"""
register("queue_fates", f"{REPLAY}, {FATES} SELECT queue, put_seq, out_seq, fate FROM f")(lambda spark, sf: Q.fates(replayed(spark, sf), ["queue"]))
register(
    "queue_staleness",
    f"""{REPLAY}, {FATES}, c AS (SELECT f.queue, CAST(f.version AS BIGINT) AS version, count(*) AS consumed, count(*) FILTER (f.version - r.version >= 1) AS stale FROM f JOIN r ON r.queue = f.queue AND r.seq = f.put_seq WHERE fate = 'consumed' GROUP BY 1, 2)
 SELECT *, CAST(sum(stale) OVER (PARTITION BY queue ORDER BY version) AS BIGINT) AS stale_total FROM c""",
)(lambda spark, sf: Q.staleness(versioned(spark, sf), ["queue"]))
STALL = """s AS (SELECT r.*, coalesce(max(CASE WHEN bump = 1 THEN size_after END) OVER v, 0) + count(*) FILTER (op > 0) OVER (PARTITION BY queue, version ORDER BY pos) AS stale_samples FROM r WINDOW v AS (PARTITION BY queue, version)),
 w AS (SELECT *, CASE WHEN size_after >= 40 THEN 'queue full' WHEN stale_samples >= 39 THEN 'stale samples' END AS reason FROM s)"""


def stalled(spark, sf):
    return Q.stalls(versioned(spark, sf), ["queue"], CAP, 26, 0.5, 1)


register("producer_stalls", f"{REPLAY}, {STALL} SELECT queue, seq, CAST(version AS BIGINT) AS version, stale_samples, reason IS NOT NULL AS paused, reason FROM w")(
    lambda spark, sf: stalled(spark, sf).select("queue", "seq", "version", "stale_samples", "paused", "reason")
)
register(
    "producer_idle_ratio",
    f"""{REPLAY}, {STALL}, v AS (SELECT queue, version, arg_min(seconds, pos) AS st, arg_min(seconds, pos) FILTER (reason IS NOT NULL) AS ps FROM w GROUP BY 1, 2)
 SELECT a.queue, CAST(a.version AS BIGINT) AS version, a.ps - a.st AS active, b.st - a.st AS total, round(1 - (a.ps - a.st) / (b.st - a.st), 6) AS idle_ratio FROM v a JOIN v b ON a.queue = b.queue AND b.version = a.version + 1 WHERE a.ps IS NOT NULL""",
)(lambda spark, sf: Q.idle_ratios(stalled(spark, sf), ["queue"]).withColumn("idle_ratio", r6("idle_ratio")))
ASSEMBLED = f"""WITH {LOG}, k AS (SELECT queue, seq, row_number() OVER (PARTITION BY queue ORDER BY seq) - 1 AS k, count(*) OVER (PARTITION BY queue) AS n FROM l WHERE op > 0)
 SELECT queue, seq, k // 64 AS train_batch, k % 64 AS slot FROM k WHERE k // 64 < n // 64"""
register("assembled_batches", ASSEMBLED)(
    lambda spark, sf: Q.assemble(log(spark, sf).filter("op > 0").select("queue", "seq"), ["queue"], "seq", 4, 16)
)
register("assembled_batches_stream", ASSEMBLED)(
    lambda spark, sf: S.assembled(as_queue_log(S.file_stream(spark, f"{sf}/events*.parquet")).filter("op > 0").select("queue", "seq"), "queue", "seq", 64)
)
TASKS = {"reward": ["view", "click"], "train": ["view", "click", "purchase"], "log": ["signup"]}


def arrivals(e):
    """A user's day is a sample whose fields arrive as events."""
    sample = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.dayofmonth("ts").cast("string"))
    return e.select(sample.alias("sample_id"), F.col("event_type").alias("field"), F.col("event_id").alias("seq"))


READY = """WITH a AS (SELECT user_id || '/' || day(ts) AS sample_id, event_type AS field, min(event_id) AS arrived FROM events GROUP BY 1, 2),
 n AS (SELECT 'reward' AS task, unnest(['view', 'click']) AS field UNION ALL SELECT 'train', unnest(['view', 'click', 'purchase']) UNION ALL SELECT 'log', 'signup'),
 k AS (SELECT task, count(*) AS need FROM n GROUP BY 1)
 SELECT sample_id, task, max(arrived) AS ready_seq FROM a JOIN n USING (field) JOIN k USING (task) GROUP BY sample_id, task, need HAVING count(*) = need"""
register("sample_readiness", READY)(lambda spark, sf: Q.readiness(arrivals(V.table(spark, sf, "events")), "sample_id", TASKS))
register("sample_readiness_stream", READY)(
    lambda spark, sf: S.ready(arrivals(S.file_stream(spark, f"{sf}/events*.parquet")), "sample_id", TASKS)
)


def version_log(e):
    return e.select(F.dayofmonth("ts").cast("long").alias("version"), F.col("event_type").alias("name"), "value", F.col("event_id").alias("seq"))


VERSIONS = """SELECT CAST(day(ts) AS BIGINT) AS version, event_type AS name, arg_max(value, event_id) AS last, round(sum(value), 6) AS sum, round(avg(value), 6) AS avg, min(value) AS min, max(value) AS max FROM events GROUP BY 1, 2"""


def rolled(d):
    return d.withColumn("sum", r6("sum")).withColumn("avg", r6("avg"))


register("version_roll_up", VERSIONS)(lambda spark, sf: rolled(S.version_roll_up(version_log(V.table(spark, sf, "events")))))
register("version_roll_up_stream", VERSIONS)(
    lambda spark, sf: rolled(S.version_roll_up(version_log(S.file_stream(spark, f"{sf}/events*.parquet"))))
)
register(
    "growing_dataset_stream",
    "SELECT doc_id, CAST(len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) AS INTEGER) AS n FROM documents WHERE len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')) <= 300",
)(
    lambda spark, sf: S.run(
        S.growing_dataset(S.file_stream(spark, f"{sf}/documents*.parquet").withColumn("n", X.words(F.col("text"))), F.col("n"), 300).select("doc_id", "n")
    )
)


def metric_events(e):
    return e.select(F.col("event_type").alias("name"), "value", F.col("ts").cast("timestamp").alias("ts"))


def seconds(d):
    return d.select(
        "name",
        F.unix_timestamp("start").alias("start_s"),
        F.unix_timestamp("end").alias("end_s"),
        "n",
        r6("total").alias("total"),
        "top",
    )


WINDOW_SQL = {
    "tumbling": """SELECT event_type AS name, CAST(floor(epoch(ts) / 21600) * 21600 AS BIGINT) AS start_s, CAST(floor(epoch(ts) / 21600) * 21600 + 21600 AS BIGINT) AS end_s, count(*) AS n, round(sum(value), 6) AS total, max(value) AS top FROM events GROUP BY 1, 2, 3""",
    "sliding": """WITH w AS (SELECT event_type AS name, value, CAST(floor(epoch(ts) / 7200) * 7200 AS BIGINT) - unnest([0, 7200, 14400]) AS s FROM events)
 SELECT name, s AS start_s, s + 21600 AS end_s, count(*) AS n, round(sum(value), 6) AS total, max(value) AS top FROM w GROUP BY 1, 2""",
    "session": """WITH g AS (SELECT event_type AS name, ts, value, CASE WHEN ts < lag(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
 s AS (SELECT *, sum(new) OVER (PARTITION BY name ORDER BY ts) AS k FROM g)
 SELECT name, CAST(floor(epoch(min(ts))) AS BIGINT) AS start_s, CAST(floor(epoch(max(ts) + INTERVAL 30 MINUTE)) AS BIGINT) AS end_s, count(*) AS n, round(sum(value), 6) AS total, max(value) AS top FROM s GROUP BY name, k""",
}
for _form, _sql in WINDOW_SQL.items():
    register(f"metric_windows_{_form}", _sql)(
        lambda spark, sf, form=_form: seconds(S.windowed_metrics(metric_events(V.table(spark, sf, "events")), form))
    )
    register(f"metric_windows_{_form}_stream", _sql)(
        lambda spark, sf, form=_form: seconds(S.windowed_metrics(metric_events(S.file_stream(spark, f"{sf}/events*.parquet")), form))
    )
