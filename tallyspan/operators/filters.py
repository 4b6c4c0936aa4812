"""Filters, samples and splits of prompt and response tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.spread import affine_scan, attach, dense_index, durable, hash_order, hash_uniform, ranked


def words(text: Column) -> Column:
    """Default token count: runs of letters and digits, and single other marks."""
    return F.regexp_count(text, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"))


def render_chat(messages: Column, template: Callable[[Column], Column] | None = None) -> Column:
    """Messages to one text. The default template is one ``<role>: content`` line per message and a
    trailing assistant line; a message without role or content makes the text null."""
    if template is not None:
        return template(messages)
    ok = F.forall(messages, lambda m: m["role"].isNotNull() & m["content"].isNotNull())
    lines = F.transform(messages, lambda m: F.concat(F.lit("<"), m["role"], F.lit(">: "), m["content"]))
    return F.when(ok, F.concat(F.array_join(lines, "\n"), F.lit("\n<assistant>: ")))


def drop_overlong(df: DataFrame, length: Column, limit: int) -> DataFrame:
    """Rows of at most ``limit`` tokens; a row whose length cannot be told counts as too long."""
    return df.filter(F.coalesce(length, F.lit(limit + 1)) <= limit)


def overlong_report(df: DataFrame, keys: Sequence[str], length: Column, limit: int) -> DataFrame:
    n = F.coalesce(length, F.lit(limit + 1))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("before"), F.count_if(n <= limit).alias("after"))


def members(df: DataFrame, **allowed: Sequence) -> DataFrame:
    """Rows whose (possibly nested) fields lie in the given sets; ``details__level`` is ``details.level``."""
    for name, values in allowed.items():
        df = df.filter(F.col(name.replace("__", ".")).isin(*values))
    return df


def dated(df: DataFrame, date: str, start: str | None = None, before: str | None = None, until: str | None = None) -> DataFrame:
    """start <= date < before, and < until if given."""
    c = F.col(date)
    if start is not None:
        df = df.filter(c >= F.to_timestamp(F.lit(start)))
    for end in (before, until):
        if end is not None:
            df = df.filter(c < F.to_timestamp(F.lit(end)))
    return df


def usable_solution(text: Column) -> Column:
    """A fenced Python block; null is not usable."""
    return F.coalesce(text.startswith("```python") & text.endswith("```"), F.lit(False))


def required(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(fields))


def required_report(df: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    missing = F.lit(False)
    for f in fields:
        missing = missing | F.col(f).isNull()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("skipped"))


def varied_groups(df: DataFrame, group: str, metric: str, keep_singletons: bool = False) -> DataFrame:
    """Groups whose metric is not the same for all members; a group of one is flat unless kept."""
    d = attach(df, [group], __hi=F.max(metric), __lo=F.min(metric), __n=F.count(F.lit(1)))
    keep = F.col("__hi") > F.col("__lo")
    if keep_singletons:
        keep = keep | (F.col("__n") == 1)
    return d.filter(keep).drop("__hi", "__lo", "__n")


#: Levels of a threshold search, and hexadecimal digits of a level: 4,096 buckets each.
DIGIT_LEVELS, DIGITS = 3, 3


def _threshold(codes: DataFrame, count: Column | int) -> Column:
    """The code (a text of hexadecimal digits, column ``code``) under which fewer than ``count`` rows lie while
    those up to it are as many: ``struct<code, rest>``, ``rest`` being how many rows of that very code are
    among the first ``count``. Found level by level from histograms of 4,096 buckets, while the query runs."""
    found = F.struct(F.lit("").alias("code"), F.lit(count).cast("long").alias("rest"))
    for level in range(1, DIGIT_LEVELS + 1):
        digits = F.left("code", F.lit(level * DIGITS))
        inside = codes.withColumn("__t", found).filter(F.left("code", F.lit((level - 1) * DIGITS)) == F.col("__t.code"))
        bucket = inside.groupBy(digits.alias("code")).agg(F.count(F.lit(1)).alias("n"), F.first("__t.rest").alias("rest"))
        # at most 4,096 rows
        up_to = F.sum("n").over(Window.orderBy("code").rowsBetween(Window.unboundedPreceding, 0))
        bucket = bucket.withColumn("up_to", up_to).filter(F.col("up_to") >= F.col("rest"))
        first = F.min(F.struct("code", (F.col("rest") - F.col("up_to") + F.col("n")).alias("rest")))
        # all rows and more: no bucket reaches the count
        found = F.coalesce(bucket.agg(first.alias("t")).scalar(), F.struct(F.lit("g").alias("code"), F.lit(0).cast("long").alias("rest")))
    return found


def _among_first(df: DataFrame, code: Column, order: Sequence[str], count: Column | int, out: str) -> DataFrame:
    """Add ``out``: is the row among the first ``count`` by ``code`` (as many hexadecimal digits as the search
    looks at, or more) and ``order``? Only rows that share the threshold's digits are sorted."""
    d = df.withColumn("__code", code)
    wide = DIGIT_LEVELS * DIGITS
    d = d.withColumn("__at", _threshold(d.select(F.col("__code").alias("code")), count)).withColumn("__d", F.left("__code", F.lit(wide)))
    tied = F.col("__d") == F.col("__at.code")
    edge = ranked(d.filter(tied), ["__d"], ["__code", *order], "__p")
    edge = edge.withColumn(out, F.col("__p") <= F.col("__at.rest")).drop("__p")
    rest = d.filter(~tied).withColumn(out, F.col("__d") < F.col("__at.code"))
    return rest.unionByName(edge).drop("__code", "__at", "__d")


def _order_number(kind: str, value: Column) -> Column:
    """A double that never falls where the values of a column rise: numbers, times, or the first bytes of texts."""
    if kind in ("string", "binary"):
        first = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    number = value.cast("double")
    # least and greatest pass over nulls
    return F.when(F.isnan(number), 8e307).when(number.isNotNull(), F.greatest(F.least(number, F.lit(8e307)), F.lit(-8e307)))


def first_rows(df: DataFrame, order: Sequence[str], count: int) -> DataFrame:
    """The first ``count`` rows by ``order``, for any count: a threshold on the place of the first column
    between its ends, then a filter. Rows that share that place with the threshold are sorted."""
    number = _order_number(dict(df.dtypes)[order[0]], F.col(order[0]))
    ends = df.agg(F.struct(F.min(number).alias("low"), F.max(number).alias("high")).alias("e")).scalar()
    share = (number - ends["low"]) / F.greatest(ends["high"] - ends["low"], F.lit(1e-300))
    place = F.floor(share * float(16 ** (DIGIT_LEVELS * DIGITS) - 1)).cast("long")
    code = F.lpad(F.lower(F.hex(F.coalesce(place, F.lit(0).cast("long")))), DIGIT_LEVELS * DIGITS, "0")
    return _among_first(df, code, list(order), count, "__in").filter("__in").drop("__in")


def random_rows(df: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """``count`` rows without replacement in seeded hash order, for any count: a threshold on the hash, then a filter."""
    return _among_first(df, hash_order(seed, key), [key], count, "__in").filter("__in").drop("__in")


def hash_split(df: DataFrame, key: str, ratio: float, seed: int) -> DataFrame:
    """Add ``split``: "test" for about ``ratio`` of the keys. Narrow: each row decides for itself."""
    return df.withColumn("split", F.when(hash_uniform(seed, key) < ratio, "test").otherwise("train"))


def exact_split(df: DataFrame, key: str, ratio: float, seed: int) -> DataFrame:
    """As ``hash_split`` with exactly ceil(ratio * n) test rows."""
    many = df.agg(F.ceil(F.count(F.lit(1)) * ratio).cast("long").alias("n")).scalar()
    d = _among_first(df, hash_order(seed, key), [key], many, "__in")
    return d.withColumn("split", F.when(F.col("__in"), "test").otherwise("train")).drop("__in")


def halve_tests(df: DataFrame, key: str, inputs: str, outputs: str, seed: int, share: float = 0.5) -> DataFrame:
    """Keep a seeded share of each row's tests, at least one, in their order."""
    n = F.size(inputs)
    keep = F.greatest(F.lit(1), F.floor(n * share).cast("int"))
    coded = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.struct(hash_order(seed, F.col(key).cast("string"), i.cast("string")).alias("h"), i.alias("i"))
    )
    kept = F.array_sort(F.transform(F.slice(F.array_sort(coded), F.lit(1), keep), lambda x: x["i"]))
    pick = lambda c: F.when(n > 0, F.transform(kept, lambda i: F.element_at(F.col(c), i + 1))).otherwise(F.col(c))
    return df.withColumn("__in", pick(inputs)).withColumn("__out", pick(outputs)).withColumn(inputs, F.col("__in")).withColumn(
        outputs, F.col("__out")
    ).drop("__in", "__out")


def tests_report(df: DataFrame, inputs: str, kept: str) -> DataFrame:
    return df.agg(F.avg(F.size(inputs)).alias("tests_before"), F.avg(F.size(kept)).alias("tests_after"))


def sample_generations(df: DataFrame, count: int, seed: int, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``count`` generations (per ``keys``) in seeded order of their text: a small table for reading."""
    from tallyspan.spread import top_k

    d = df.withColumn("__h", hash_order(seed, *cols))
    if keys:
        return top_k(d, list(keys), [F.col("__h"), *[F.col(c) for c in cols]], count, "__r").drop("__h", "__r")
    return d.orderBy("__h", *cols).limit(count).drop("__h")


WEIGHTS = {
    "pow": lambda s, hi, lo, power: F.pow(F.abs(s), F.lit(power)),
    "max_min": lambda s, hi, lo, power: F.when((s == hi) | (s == lo), 1.0).otherwise(0.0),
    "max_random": lambda s, hi, lo, power: F.when(s == hi, 0.4).otherwise(0.1),
}


def _last_before(batches: Iterator[pa.RecordBatch], keys: Sequence[str], rows: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Of a partition in order: every draw with the columns ``rows`` of the last interval before it (null if the
    partition has none yet), and last the partition's own last interval, without a draw."""
    held, names = None, [*keys, "__part", "draw", *rows]
    for batch in batches:
        if not batch.num_rows:
            continue
        interval = batch.column("draw").is_null().to_numpy(zero_copy_only=False)
        before = batch.slice(0, 1) if held is None else held
        whole = pa.Table.from_batches([before, batch]).combine_chunks()
        at = np.where(interval, np.arange(1, batch.num_rows + 1), -1 if held is None else 0)
        at = np.maximum.accumulate(at)
        drawn = np.flatnonzero(~interval)
        source = pa.array(at[drawn], mask=at[drawn] < 0)
        columns = [batch.column(c).take(pa.array(drawn)) for c in [*keys, "__part", "draw"]]
        columns += [whole.column(c).take(source).combine_chunks() for c in rows]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        if interval.any():
            held = batch.slice(int(np.flatnonzero(interval)[-1]), 1)
    if held is not None:
        yield pa.RecordBatch.from_arrays([held.column(c) for c in names], names=names)


def resample(
    df: DataFrame, batch: Sequence[str], row_key: str, score: str, method: str = "pow", power: float = 2.0, seed: int = 0
) -> DataFrame:
    """As many draws with replacement as a batch has rows, by score weights; ``draw`` numbers them.

    Weights get a floor of 1e-8. Each row owns an interval of the cumulated weights. Intervals and draws
    are sorted together by where they begin, over ranges of that order, and a draw takes the last
    interval before it; the last interval of a range goes on to the ranges behind it. So a row of half the
    weight is one row, whatever is drawn from it.
    """
    if method not in WEIGHTS:
        raise ValueError(f"unknown weights {method}")
    batch = list(batch)
    d = attach(df, batch, __hi=F.max(score), __lo=F.min(score), __n=F.count(F.lit(1)))
    weight = WEIGHTS[method](F.col(score), F.col("__hi"), F.col("__lo"), power) + 1e-8
    d = ranked(d.withColumn("__w", weight), batch, [row_key], "__r")
    d = affine_scan(d, batch, "__r", {"__cum": (F.lit(1.0), F.col("__w"), False)})
    d = durable(d.select(*df.columns, "__r", "__w", "__cum__x"))
    d = attach(d, batch, __total=F.sum("__w"))
    rows = [c for c in df.columns if c not in batch]
    start = F.col("__cum__x") / F.col("__total")
    intervals = d.select(*batch, start.alias("__at"), F.lit(None).cast("long").alias("draw"), F.col("__r"), *rows)
    draws = d.select(*batch, hash_uniform(seed, *batch, "__r").alias("__at"), F.col("__r").cast("long").alias("draw"), F.lit(None).cast("long").alias("__r"))
    both = intervals.unionByName(draws, allowMissingColumns=True)
    order = [*[F.col(c) for c in batch], F.col("__at"), F.col("draw").asc_nulls_first(), F.col("__r")]
    # one table: what a range hands on must come from the same ranges
    ranges = both.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id().cast("long"))
    ranges = ranges.select(*batch, "__part", "draw", *rows)
    fields = ", ".join(f"`{c}` {t}" for c, t in ranges.dtypes)
    found = durable(ranges.mapInArrow(lambda parts: _last_before(parts, batch, rows), fields))
    row = F.struct(*rows)
    # one row for each range that has an interval
    lasts = found.filter(F.col("draw").isNull()).select("__part", row.alias("__row"))
    parts = found.select("__part").distinct().join(lasts, "__part", "left")
    carried = F.last("__row", ignorenulls=True).over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("__part", carried.alias("__carried"))
    drawn = found.filter(F.col("draw").isNotNull()).join(F.broadcast(parts), "__part")
    missing = F.col(row_key).isNull()
    return drawn.select(*[F.when(missing, F.col("__carried")[c]).otherwise(F.col(c)).alias(c) if c in rows else F.col(c) for c in df.columns], "draw")


def whole_batches(indexed: DataFrame, size: int, drop_last: bool = True) -> DataFrame:
    """Add ``batch_id`` by dense index; the incomplete last batch goes for training and stays for validation."""
    d = attach(indexed, [], __n=F.count(F.lit(1))).withColumn("batch_id", F.floor(F.col("idx") / size))
    if drop_last:
        d = d.filter(F.col("batch_id") < F.floor(F.col("__n") / size))
    return d.drop("__n")


def curriculum(prompts: DataFrame, history: DataFrame, key: str, difficulty: Column, ascending: bool = True) -> DataFrame:
    """Prompts with their place ``turn`` by an aggregate over their history; prompts without one come first."""
    stats = history.groupBy(key).agg(difficulty.alias("difficulty"))
    d = prompts.join(stats, key, "left")
    sort = F.col("difficulty") if ascending else -F.col("difficulty")
    d = d.withColumn("__o", F.coalesce(sort, F.lit(float("-inf"))))
    return dense_index(d, ["__o", key], "turn").drop("__o")


def redact(df: DataFrame, cols: Sequence[str], pattern: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.regexp_replace(c, pattern, "*"))
    return df


def keyword_hits(df: DataFrame, keys: Sequence[str], text: str, word: str) -> DataFrame:
    """Every line with the word: ``line`` (0-based), ``column`` of its first hit and the line's text."""
    lines = df.filter(F.col(text).contains(word)).select(*keys, F.posexplode(F.split(text, "\n")).alias("line", "content"))
    return lines.withColumn("column", F.instr("content", word) - 1).filter(F.col("column") >= 0)


def by_request(df: DataFrame, request: str, key: str = "sample_id") -> DataFrame:
    return df.filter(F.col(key) == request)
