"""The batch algebra on DataFrames: select, union, repeat, slice, chunk, pad, fold.

Row positions are the dense column ``idx`` of ``with_index``; nothing relies on the order of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.functions.values import bound
from tallyspan.spread import affine_scan, attach, dense_index, hash_order, packed, ranked


def with_index(df: DataFrame, order: Sequence[str], out: str = "idx") -> DataFrame:
    """Dense 0-based index in the total order of ``order``."""
    return dense_index(df, list(order), out)


def select(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyError(f"no columns {missing}")
    return df.select(*keys)


def pop(df: DataFrame, row_key: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(popped columns, remaining columns), both with the row key."""
    rest = [c for c in df.columns if c not in keys or c == row_key]
    return select(df, [row_key, *[k for k in keys if k != row_key]]), df.select(*rest)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def union_columns(left: DataFrame, right: DataFrame, row_key: str) -> DataFrame:
    """Columns of both sides per row. Both sides must hold the same rows, and a column of both sides
    the same values (null equals null, NaN equals NaN); anything else is an error."""
    shared = [c for c in right.columns if c in left.columns and c != row_key]
    r = right.withColumnsRenamed({c: "__r_" + c for c in shared}).withColumn("__in_r", F.lit(True))
    both = left.withColumn("__in_l", F.lit(True)).join(r, row_key, "full_outer")
    whole = F.col("__in_l").isNotNull() & F.col("__in_r").isNotNull()
    columns = []
    for c in left.columns:
        if c in shared:
            clash = F.raise_error(F.lit(f"column {c} differs between the two sides")).cast(left.schema[c].dataType)
            columns.append(F.when(F.col(c).eqNullSafe(F.col("__r_" + c)), F.col(c)).otherwise(clash).alias(c))
        elif c == row_key:
            lost = F.raise_error(F.lit("the two sides do not have the same rows")).cast(left.schema[c].dataType)
            columns.append(F.when(whole, F.col(c)).otherwise(lost).alias(c))
        else:
            columns.append(F.col(c))
    return both.select(*columns, *[c for c in right.columns if c not in left.columns])


def conflicts(left: DataFrame, right: DataFrame, row_key: str) -> DataFrame:
    """Number of differing rows per shared column: the audit form of ``union_columns``."""
    shared = [c for c in right.columns if c in left.columns and c != row_key]
    both = left.join(right.withColumnsRenamed({c: "__r_" + c for c in shared}), row_key)
    counts = both.agg(*[F.count_if(~F.col(c).eqNullSafe(F.col("__r_" + c))).alias(c) for c in shared])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("conflicts")) for c in shared])))


def to_lists(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], block: int = 16_384) -> DataFrame:
    """Rows of a key as one list per column, sorted by ``order``, on pages of ``block`` entries."""
    pages = packed(ranked(df, keys, [order], "__p"), keys, "__p", cols, "__rows", block)
    lists = [F.transform("__rows", _picker(c)).alias(c) for c in cols]
    return pages.select(*keys, "page", *lists)


def _picker(name: str) -> Callable[[Column], Column]:
    return lambda r: r[name]


def fold(indexed: DataFrame, size: int, cols: Sequence[str]) -> DataFrame:
    """``size`` consecutive rows to one row of lists."""
    g = indexed.withColumn("fold", F.floor(F.col("idx") / size)).groupBy("fold")
    rows = g.agg(F.array_sort(F.collect_list(F.struct("idx", *cols))).alias("__r"))  # at most ``size`` rows
    return rows.select("fold", *[F.transform("__r", _picker(c)).alias(c) for c in cols])


def unfold(folded: DataFrame, size: int, cols: Sequence[str]) -> DataFrame:
    z = folded.select("fold", F.posexplode(F.arrays_zip(*cols)).alias("__i", "__z"))
    return z.select((F.col("fold") * size + F.col("__i")).alias("idx"), *[F.col(f"__z.{c}").alias(c) for c in cols])


def schema_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type, non-null count and number of list elements per column."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    aggs = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        many = F.sum(F.size(c)) if isinstance(f.dataType, T.ArrayType) else F.count(c)
        aggs += [F.count(c).alias("n_" + f.name), F.coalesce(many, F.lit(0)).alias("e_" + f.name)]
    row = df.agg(*aggs)
    cells = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("n_" + f.name).alias("values"),
            F.col("e_" + f.name).alias("elements"),
        )
        for f in fields
    ]
    return row.select(F.inline(F.array(*cells)))


def repeat(indexed: DataFrame, times: int, interleave: bool = True) -> DataFrame:
    """Each row ``times`` times; ``idx`` runs over copies first (interleaved) or over rows first (tiled)."""
    r = indexed.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    if interleave:
        return r.withColumn("idx", F.col("idx") * times + F.col("rep"))
    r = attach(r, [], __n=F.count(F.lit(1)))
    return r.withColumn("idx", F.col("rep") * (F.col("__n") / times).cast("long") + F.col("idx")).drop("__n")


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its own count says; 0 drops the row. Adds ``rep``."""
    n = F.col(times).cast("int")
    return df.filter(n > 0).withColumn("rep", F.explode(F.sequence(F.lit(0), n - 1)))


def unfold_chunks(df: DataFrame, parts: int, split: Sequence[str]) -> DataFrame:
    """Each row to ``parts`` rows: listed array columns are cut into equal chunks, the others repeat."""
    r = df.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    for c in split:
        n = F.size(c) / parts
        uneven = F.raise_error(F.lit(f"{c} cannot be cut into {parts} chunks")).cast(df.schema[c].dataType)
        cut = F.slice(F.col(c), (F.col("chunk") * n + 1).cast("int"), n.cast("int"))
        r = r.withColumn(c, F.when(F.size(c) % parts == 0, cut).otherwise(uneven))
    return r


def take_slice(indexed: DataFrame, start: int, stop: int, step: int = 1) -> DataFrame:
    i = F.col("idx")
    return indexed.filter((i >= start) & (i < stop) & ((i - start) % step == 0))


def take_rows(indexed: DataFrame, picks: DataFrame) -> DataFrame:
    """Rows in the order of ``picks`` (``idx``, ``new_idx``); a row may be picked repeatedly."""
    return indexed.join(picks, "idx").drop("idx").withColumnRenamed("new_idx", "idx")


def reorder(indexed: DataFrame, mapping: DataFrame) -> DataFrame:
    return take_rows(indexed, mapping)


def split_rows(indexed: DataFrame, size: int) -> DataFrame:
    return indexed.withColumn("chunk", F.floor(F.col("idx") / size))


def chunk(indexed: DataFrame, parts: int, allow_uneven: bool = False) -> DataFrame:
    """``parts`` runs of equally many rows; another row count is an error unless allowed."""
    d = attach(indexed, [], __n=F.count(F.lit(1)))
    size = F.ceil(F.col("__n") / parts)
    c = F.floor(F.col("idx") / size)
    if not allow_uneven:
        c = F.when(F.col("__n") % parts == 0, c).otherwise(F.raise_error(F.lit("rows cannot be cut into equal chunks")).cast("long"))
    return d.withColumn("chunk", c).drop("__n")


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; a column missing in one frame is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def merge_meta(meta: DataFrame, lists: Sequence[str] = ("metrics",)) -> DataFrame:
    """Meta entries ``part, key, value`` of several batches: list keys keep every value in part order,
    the others must agree."""
    is_list = F.col("key").isin(*lists)
    single = meta.filter(~is_list).groupBy("key").agg(F.min("value").alias("__a"), F.max("value").alias("__b"))
    clash = F.raise_error(F.concat(F.lit("conflicting values for "), F.col("key")))
    agreed = single.select("key", F.lit(0).alias("pos"), F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise(clash).alias("value"))
    return agreed.unionByName(meta.filter(is_list).select("key", F.col("part").cast("int").alias("pos"), "value"))


def pad_to_divisor(indexed: DataFrame, divisor: int) -> DataFrame:
    """Append rows from the start, lap after lap, until the count divides; ``is_pad`` marks them."""
    d = attach(indexed, [], __n=F.count(F.lit(1)))
    pad = F.pmod(-F.col("__n"), F.lit(divisor))
    laps = F.when(F.col("idx") < pad, F.floor((pad - 1 - F.col("idx")) / F.col("__n")) + 1).otherwise(0).cast("int")
    extra = d.filter(laps > 0).withColumn("__lap", F.explode(F.sequence(F.lit(1), laps)))
    extra = extra.withColumn("idx", F.col("idx") + F.col("__lap") * F.col("__n")).drop("__lap")
    return d.withColumn("is_pad", F.lit(False)).unionByName(extra.withColumn("is_pad", F.lit(True))).drop("__n")


def pad_with_edge(indexed: DataFrame, count: int, edge: str = "first") -> DataFrame:
    """Append ``count`` copies of the first or the last row."""
    d = attach(indexed, [], __n=F.count(F.lit(1)))
    source = d.filter(F.col("idx") == (F.lit(0) if edge == "first" else F.col("__n") - 1))
    extra = source.withColumn("__c", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))) if count else source.limit(0).withColumn("__c", F.lit(0))
    extra = extra.withColumn("idx", F.col("__n") + F.col("__c")).drop("__c").withColumn("is_pad", F.lit(True))
    return d.withColumn("is_pad", F.lit(False)).unionByName(extra).drop("__n")


def unpad(padded: DataFrame) -> DataFrame:
    return padded.filter(~F.col("is_pad")).drop("is_pad")


def mini_batch_plan(df: DataFrame, row_key: str, size: int, epochs: int, seed: int) -> DataFrame:
    """Seeded shuffle per epoch: ``epoch, batch_id, slot`` per row. The row count must divide by ``size``."""
    d = attach(df, [], __n=F.count(F.lit(1)))
    bad = F.raise_error(F.lit(f"the row count does not divide by {size}")).cast("long")
    e = d.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("__h", hash_order(seed, "epoch", row_key))
    r = ranked(e, ["epoch"], ["__h", row_key], "__r")
    spot = F.when(F.col("__n") % size == 0, F.col("__r") - 1).otherwise(bad)
    r = r.withColumn("__r", spot)
    return r.withColumn("batch_id", F.floor(F.col("__r") / size)).withColumn("slot", F.col("__r") % size).drop("__h", "__r", "__n")


# ---- arrays ------------------------------------------------------------------------------


def fit_array(arr: Column, length: int, pad: Column, left_pad: bool = True, truncation: str = "error") -> Column:
    """Array of exactly ``length`` entries; too long ones lose their left, right or middle part."""
    n = F.size(arr)
    missing = F.array_repeat(pad, F.greatest(F.lit(length) - n, F.lit(0)))
    padded = F.concat(missing, arr) if left_pad else F.concat(arr, missing)
    head = length // 2
    cuts = {
        "left": F.slice(arr, n - length + 1, F.lit(length)),
        "right": F.slice(arr, F.lit(1), F.lit(length)),
        "middle": F.concat(F.slice(arr, F.lit(1), F.lit(head)), F.slice(arr, n - (length - head) + 1, F.lit(length - head))),
    }
    if truncation == "error":
        return F.when(n <= length, padded).otherwise(F.raise_error(F.format_string(f"%d entries exceed {length}", n)))
    if truncation not in cuts:
        raise ValueError(f"unknown truncation {truncation}")
    return F.when(n <= length, padded).otherwise(cuts[truncation])


def drop_padding(arr: Column, mask: Column) -> Column:
    """Entries whose mask is 1."""
    kept = F.filter(F.arrays_zip(arr.alias("v"), mask.alias("m")), lambda x: x["m"] != 0)
    return F.transform(kept, lambda x: x["v"])


def restore_padding(values: Column, mask: Column, pad: float, kind: str = "bigint") -> Column:
    """Values back on the places where the mask is 1, ``pad`` elsewhere. The places of both are listed, paired
    with their values and put in order; null values or a null mask give null."""
    places = F.sequence(F.lit(0), F.size(mask) - 1)

    def paired(at: Column) -> Column:
        held = F.filter(at, lambda i: F.get(mask, i) != 0)
        free = F.filter(at, lambda i: F.get(mask, i) == 0)
        entry = lambda i, v: F.struct(i.alias("i"), v.cast(kind).alias("v"))
        both = F.concat(F.zip_with(held, values, entry), F.transform(free, lambda i: entry(i, F.lit(pad))))
        return F.transform(F.array_sort(both), lambda e: e["v"])

    none = F.array().cast(f"array<{kind}>")
    return F.when(values.isNotNull() & (F.size(mask) > 0), bound(places, paired)).when(values.isNotNull() & (F.size(mask) == 0), none)


def jagged(rows: DataFrame, keys: Sequence[str], order: str, col: str, block: int = 16_384) -> DataFrame:
    """Arrays of different lengths as one ragged column: ``keys, page, order`` (the ids of a page's rows),
    ``values`` (their entries, one array after the other), ``offsets`` (where each array starts, and the end)
    and ``known`` (false for a null array). A page holds ``block`` rows of a key at most."""
    keys = list(keys)
    sized = rows.select(*keys, order, col, F.greatest(F.size(col), F.lit(0)).alias("__len"))
    placed = affine_scan(ranked(sized, keys, [order], "__p"), keys, "__p", {"__end": (F.lit(1.0), F.col("__len"), False)}, block)
    placed = placed.withColumn("__end", F.col("__end").cast("long"))
    pages = packed(placed, keys, "__p", [order, col, "__len", "__end"], "__rows", block)
    first = F.col("__rows")[0]
    ends = F.transform("__rows", lambda r: r["__end"] - first["__end"] + first["__len"])
    return pages.select(
        *keys,
        "page",
        F.transform("__rows", _picker(order)).alias(order),
        F.flatten(F.transform("__rows", lambda r: F.coalesce(r[col], F.array()))).alias("values"),
        F.concat(F.array(F.lit(0).cast("long")), ends).alias("offsets"),
        F.transform("__rows", lambda r: r[col].isNotNull()).alias("known"),
    )


def from_jagged(pages: DataFrame, keys: Sequence[str], order: str, col: str) -> DataFrame:
    """The rows of a ragged column again: ``keys, order, col``."""
    ids = pages.select(*keys, "values", "offsets", "known", F.posexplode(order).alias("__i", order))
    start = F.get("offsets", F.col("__i"))
    part = F.slice("values", (start + 1).cast("int"), (F.get("offsets", F.col("__i") + 1) - start).cast("int"))
    return ids.select(*keys, order, F.when(F.get("known", F.col("__i")), part).alias(col))


def response_window(padded: Column, response_length: Column) -> Column:
    """The response part of a next-token array: the last ``response_length`` places, one to the left."""
    return F.slice(padded, F.size(padded) - response_length, response_length)


def flatten_struct(schema: T.StructType, prefix: str = "", sep: str = "/") -> list[Column]:
    """Leaf columns of nested structs under ``a/b`` names; a list gives ``list_len`` under its name."""
    found: list[Column] = []
    for f in schema.fields:
        path, name = f"{prefix}`{f.name}`", (prefix + f.name).replace("`", "").replace(".", sep)
        if isinstance(f.dataType, T.StructType):
            found += flatten_struct(f.dataType, path + ".", sep)
        elif isinstance(f.dataType, T.ArrayType):
            found += [F.size(F.col(path)).alias(name + sep + "list_len"), F.col(path).alias(name)]
        else:
            found.append(F.col(path).alias(name))
    return found


def flatten_lists(df: DataFrame, keys: Sequence[str], name: str, sep: str = "/") -> DataFrame:
    """A list column to ``path, value`` rows: ``name/list_len``, ``name/0``, ``name/1`` ..."""
    c = F.col(name)
    size = F.array(F.struct(F.lit(f"{name}{sep}list_len").alias("path"), F.size(c).cast("string").alias("value")))
    items = F.transform(c, lambda v, i: F.struct(F.concat(F.lit(name + sep), i.cast("string")).alias("path"), v.cast("string").alias("value")))
    return df.select(*keys, F.inline(F.concat(size, items)))
