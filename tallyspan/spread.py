"""Group work that stays spread over the cluster when one key holds a large share of the rows.

Four shapes cover everything the operators need:

``attach``       group statistics next to each member (partial aggregation, then a join; where
                 few groups make it small, the adaptive planner broadcasts it, else it splits the
                 partitions of hot keys);
``ranked``       1, 2, 3 ... inside each group in a total order;
``dense_index``  0, 1, 2 ... over a whole table in a total order;
``affine_scan``  running recurrences along a group, block by block.

None of them collects a group into one task, and no window runs over a group that is larger
than ``HOT_ROWS``.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A group with more rows than this is "hot". A table of N rows has at most N / HOT_ROWS hot
# groups, which bounds everything that is broadcast per hot group.
HOT_ROWS = 1_000_000
# Rows of one group that may sit in one array during a scan.
SCAN_BLOCK = 16_384
# Levels at which the blocks of a group are themselves scanned: SCAN_BLOCK ** (1 + SCAN_LEVELS) rows fit.
SCAN_LEVELS = 2


def _shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which all executors share."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="run-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder so that a lost executor costs nothing."""
    _shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As ``durable``, as a Parquet table: compressed, read by column, and of a known size, so that a small one
    is broadcast where it is joined and the other side is not shuffled."""
    path = f"{_shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[prefix + key])
    return condition


def attach(df: DataFrame, keys: Sequence[str], of: DataFrame | None = None, **aggs: Column) -> DataFrame:
    """Add the group aggregates ``aggs`` of ``keys`` to every row.

    The aggregates are computed with map-side partials, over ``df`` or, if they need fewer columns,
    over ``of``, the same rows at an earlier step, so that what came since is not computed twice.
    """
    keys, source = list(keys), df if of is None else of
    if not keys:
        # one value for the whole table: a scalar subquery
        whole = source.agg(F.struct(*[c.alias(n) for n, c in aggs.items()]).alias("__whole")).scalar()
        wide = df.withColumn("__whole", whole)
        return wide.select(*[df_col(c) for c in df.columns], *[F.col(f"__whole.{n}").alias(n) for n in aggs])
    stats = source.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return attach_table(df, keys, stats, list(aggs))


def attach_table(df: DataFrame, keys: Sequence[str], stats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join ``stats`` (one row per key) to ``df``; null keys meet. Adaptive execution broadcasts a small
    ``stats`` by its real size and splits the partitions of hot keys of ``df`` otherwise."""
    keys, columns = list(keys), list(columns)
    renamed = stats.select(*[F.col(k).alias("__k_" + k) for k in keys], F.struct(*[F.col(c) for c in columns]).alias("__sp_v"))
    joined = df.join(renamed, _same(df, renamed, keys, "__k_"), "left")
    return joined.select(*[df_col(c) for c in df.columns], *[F.col("__sp_v")[c].alias(c) for c in columns])


def df_col(name: str) -> Column:
    return F.col(f"`{name}`")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """First ``k`` rows of each group. Spark keeps k rows per group before the shuffle
    (WindowGroupLimit), so a hot group costs k rows per task."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(spec)).filter(F.col(out) <= k)


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows).select(*keys)


def dense_index(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    """0-based position of each row in the total order of the columns ``order``.

    Range sort, written once; then one count per partition (as many rows as partitions) turns
    local positions into global ones. No window runs over the table.
    """
    parts = (
        df.repartitionByRange(*[df_col(c) for c in order])
        .sortWithinPartitions(*[df_col(c) for c in order])
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__seq", F.monotonically_increasing_id())
    )
    parts = durable(parts)
    sizes = parts.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"), F.min("__seq").alias("__first"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count of the sort
    sizes = sizes.select("__part", "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    return parts.join(F.broadcast(sizes), "__part").select(
        *[df_col(c) for c in df.columns], (F.col("__seq") - F.col("__first") + F.col("__before")).alias(out)
    )


def ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """1-based position inside each group of ``keys`` in the total order ``order``.

    Groups of ordinary size take a window. Groups above ``hot_rows`` take the range-sorted dense
    index, so that a group with a third of the table is ranked by many tasks.
    """
    keys, order = list(keys), list(order)
    if not keys:
        return dense_index(df, order, out).withColumn(out, F.col(out) + 1)
    spec = Window.partitionBy(*keys).orderBy(*[df_col(c) for c in order])
    windowed = lambda d: d.withColumn(out, F.row_number().over(spec).cast("long"))
    hot = hot_groups(df, keys, hot_rows)
    if hot.isEmpty():
        return windowed(df)
    marked = hot.withColumnsRenamed({k: "__h_" + k for k in keys})
    cold_rows = windowed(df.join(F.broadcast(marked), _same(df, marked, keys, "__h_"), "left_anti"))
    hot_rows_df = df.join(F.broadcast(marked), _same(df, marked, keys, "__h_"), "left_semi")
    indexed = dense_index(hot_rows_df, keys + order, "__idx")
    indexed = attach(indexed, keys, __start=F.min("__idx"))
    hot_ranked = indexed.withColumn(out, F.col("__idx") - F.col("__start") + 1).drop("__idx", "__start")
    return cold_rows.unionByName(hot_ranked)


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str, tie: str, fractions: dict[str, float]
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, from ranks: no group is held in memory.

    ``tie`` is a unique column that makes the order total; ``fractions`` maps output names to
    fractions in [0, 1].
    """
    keys = list(keys)
    r = ranked(df.select(*keys, value, tie).filter(F.col(value).isNotNull()), keys, [value, tie], "__pos")
    r = attach(r, keys, __size=F.count(F.lit(1)))
    picks = []
    for name, fraction in fractions.items():
        h = (F.col("__size") - 1) * F.lit(fraction) + 1
        part = F.col("__pos") == F.floor(h), F.col("__pos") == F.floor(h) + 1
        share = h - F.floor(h)
        v = F.col(value).cast("double")
        low, high = F.max(F.when(part[0], v)), F.max(F.when(part[1], v))
        weight = F.max(F.when(part[0], share))
        picks.append((low + F.coalesce(high - low, F.lit(0.0)) * weight).alias(name))
    return r.groupBy(*keys).agg(*picks)


def packed(
    df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str], out: str, block: int = SCAN_BLOCK
) -> DataFrame:
    """Rows of a group as arrays of at most ``block`` entries: ``keys, page, out`` sorted by ``pos``.

    A group that fits one block is one row with ``page`` 0; a larger one continues on further
    pages, so that no array grows with the group.
    """
    return (
        df.withColumn("page", F.floor((F.col(pos) - 1) / block))
        .groupBy(*keys, "page")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(pos), *[df_col(c) for c in cols]))).alias(out))
    )


def _segment_scan(a: np.ndarray, b: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """y[i] = b[i] + a[i] * y[i+1] inside consecutive segments, by doubling."""
    a, y = a.copy(), b.copy()
    a[np.cumsum(lens) - 1] = 0.0
    step, longest = 1, int(lens.max()) if len(lens) else 0
    while step < longest:
        y[:-step] += a[:-step] * y[step:]
        a[:-step] *= a[step:]
        a[-step:] = 0.0
        step *= 2
    return y


#: A scan without its columns: which way it goes, and the number of the scan that its b depends on.
_Shape = tuple[bool, int | None]


def _scan_all(shapes: Sequence[_Shape], parts: Sequence[list[np.ndarray]], carries: Sequence[np.ndarray], lens: np.ndarray, free: bool = False) -> list[np.ndarray]:
    """y of every scan over segments, each against its own direction reversed; ``parts``: a, b and, for a
    dependent scan, d. ``free`` leaves b out, so that only the carries have an effect."""
    last = np.cumsum(lens) - 1
    out: list[np.ndarray] = []
    for (_, other), part, carry in zip(shapes, parts, carries):
        a, b = part[0], np.zeros_like(part[1]) if free else part[1].copy()
        if other is not None:
            beside = np.empty_like(b)
            beside[:-1] = out[other][1:]
            beside[last] = carries[other]
            b += part[2] * beside
        b[last] += a[last] * carry
        out.append(_segment_scan(a, b, lens))
    return out


def _scan_input(shapes: Sequence[_Shape], columns: Sequence[pd.Series]) -> tuple[list[list[np.ndarray]], np.ndarray]:
    lens, parts, at = columns[0].map(len).to_numpy(np.int64), [], 0
    for reverse, other in shapes:
        some = columns[at : at + (2 if other is None else 3)]
        at += len(some)
        turn = 1 if reverse else -1
        parts.append([np.concatenate([np.asarray(x, dtype=float)[::turn] for x in c]) for c in some])
    return parts, lens


def _scanned(shapes: list[_Shape]):
    """Column function: y of every scan, from the lists of coefficients and then the carries."""
    fields = [T.StructField(f"y{i}", T.ArrayType(T.DoubleType())) for i in range(len(shapes))]

    @F.pandas_udf(T.StructType(fields))
    def run(*columns: pd.Series) -> pd.DataFrame:
        parts, lens = _scan_input(shapes, columns)
        carries = [c.to_numpy(float) for c in columns[len(columns) - len(shapes) :]]
        cuts = np.cumsum(lens)[:-1]
        found = _scan_all(shapes, parts, carries, lens)
        return pd.DataFrame({f"y{i}": [p[:: 1 if shapes[i][0] else -1] for p in np.split(y, cuts)] for i, y in enumerate(found)})

    return run


def _summarised(shapes: list[_Shape]):
    """Column function: what a block hands on, as ``b<i>`` without carries, ``a<i>`` per unit of its own carry
    and ``d<i>`` per unit of the carry of the scan it depends on."""
    fields = [T.StructField(f"{c}{i}", T.DoubleType()) for i in range(len(shapes)) for c in "abd"]

    @F.pandas_udf(T.StructType(fields))
    def run(*columns: pd.Series) -> pd.DataFrame:
        parts, lens = _scan_input(shapes, columns)
        first = np.cumsum(lens) - lens
        none = [np.zeros(len(lens)) for _ in shapes]
        out = {f"b{i}": y[first] for i, y in enumerate(_scan_all(shapes, parts, none, lens))}
        for i in range(len(shapes)):
            unit = _scan_all(shapes, parts, [np.ones(len(lens)) if j == i else z for j, z in enumerate(none)], lens, free=True)
            out[f"a{i}"] = unit[i][first]
            for j, (_, other) in enumerate(shapes):
                if other == i:
                    out[f"d{j}"] = unit[j][first]
        return pd.DataFrame({f.name: out.get(f.name, 0.0) for f in fields})

    return run


def has_long_groups(df: DataFrame, keys: Sequence[str], rows: int = SCAN_BLOCK) -> bool:
    return not hot_groups(df, keys, rows).isEmpty()


def _field(rows: Column, name: str) -> Column:
    return F.transform(rows, lambda row: row[name])


def affine_scan(
    df: DataFrame, keys: Sequence[str], pos: str, scans: dict[str, tuple], block: int = SCAN_BLOCK, levels: int = SCAN_LEVELS, save: bool = True
) -> DataFrame:
    """Add ``name`` for each ``name: (a, b, reverse)``: y[t] = b[t] + a[t] * y[next], where next is
    t + 1 for a reverse scan and t - 1 otherwise, and ``name__x`` = y[next] (0 beyond the end). With a
    fourth entry ``(d, other)`` the scan adds d[t] * other[next] to b[t], for an earlier scan of the same
    direction.

    A group is cut into blocks, written once. What a block hands on is again such a recurrence, over the
    blocks, and is scanned in the same way, block of blocks by block, at every size of a group; then each
    block is scanned with the carry that reaches it, all scans in one pass. ``save`` and ``levels`` are for
    that recursion.
    """
    keys, names = list(keys), list(scans)
    shapes: list[_Shape] = [(s[2], names.index(s[3][1]) if len(s) > 3 else None) for s in scans.values()]
    coefficients = {f"__{c}_{n}": column for n, s in scans.items() for c, column in zip("abd", [s[0], s[1], *([s[3][0]] if len(s) > 3 else [])])}
    prepared = df.select(*[df_col(c) for c in df.columns], *[c.cast("double").alias(n) for n, c in coefficients.items()])
    carried = [c for c in prepared.columns if c not in keys and c != pos]
    blocks = packed(prepared, keys, pos, carried, "__rows", block)
    blocks = durable(blocks) if save else blocks
    lists = [_field(F.col("__rows"), n) for n in coefficients]
    zero = F.lit(0.0)
    if levels:
        # only full blocks hand anything on, and only to or from further pages
        handing = blocks.filter((F.col("page") > 0) | (F.size("__rows") == block))
        summary = handing.select(*keys, (F.col("page") + 1).alias("__at"), _summarised(shapes)(*lists).alias("__s")).select(*keys, "__at", "__s.*")
        chained = {
            n: (F.col(f"a{i}"), F.col(f"b{i}"), reverse, *([] if other is None else [(F.col(f"d{i}"), names[other])]))
            for i, (n, (reverse, other)) in enumerate(zip(names, shapes))
        }
        handed = affine_scan(summary, keys, "__at", chained, block, levels - 1, save=False)
        handed = handed.select(*[F.col(k).alias("__k_" + k) for k in keys], (F.col("__at") - 1).alias("__page"), *[F.col(n + "__x").alias("__carry_" + n) for n in names])
        blocks = blocks.join(handed, _same(blocks, handed, keys, "__k_") & (F.col("page") == F.col("__page")), "left")
        carries = [F.coalesce(F.col("__carry_" + n), zero) for n in names]
    else:
        # SCAN_BLOCK ** (1 + SCAN_LEVELS) rows and more in one group
        lists = [F.when(F.col("page") > 0, F.raise_error(F.lit("a group has too many rows to scan"))).otherwise(c) for c in lists]
        carries = [zero] * len(names)
    blocks = blocks.select(*keys, "__rows", *[c.alias(f"__c_{n}") for n, c in zip(names, carries)], _scanned(shapes)(*lists, *carries).alias("__y"))
    size, parts = F.size("__rows"), ["__rows"]
    for i, (n, (reverse, _)) in enumerate(zip(names, shapes)):
        y, edge = F.col("__y")[f"y{i}"], F.array(F.col(f"__c_{n}"))
        beside = F.concat(F.slice(y, F.lit(2), size - 1), edge) if reverse else F.concat(edge, F.slice(y, F.lit(1), size - 1))
        blocks = blocks.withColumn("__y_" + n, y).withColumn("__x_" + n, beside)
        parts += ["__y_" + n, "__x_" + n]
    flat = blocks.select(*keys, F.explode(F.arrays_zip(*parts)).alias("__z"))
    return flat.select(
        *[df_col(c) if c in keys else F.col(f"__z.__rows.`{c}`").alias(c) for c in df.columns],
        *[F.col(f"__z.__y_{n}").alias(n) for n in names],
        *[F.col(f"__z.__x_{n}").alias(n + "__x") for n in names],
    )


def hash_order(seed: int, *cols: str | Column) -> Column:
    """Seeded pseudo-random order key that any SQL engine can recompute: md5 of the text form."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols]))


def hash_uniform(seed: int, *cols: str | Column) -> Column:
    """Seeded number in [0, 1): the first 12 hex digits of ``hash_order`` over 16^12."""
    digits = F.conv(F.substring(hash_order(seed, *cols), 1, 12), 16, 10).cast("double")
    return digits / F.lit(float(16**12))


def session(app: str = "tallyspan", cpus: str = "8") -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
