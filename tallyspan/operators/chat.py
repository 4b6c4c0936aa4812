"""Token rows for supervised and reward-model training: ids, attention and loss masks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.operators.algebra import fit_array

Tokenizer = Callable[[Column], Column]


def word_ids(text: Column) -> Column:
    """Stand-in for a model tokenizer: one id per word or mark, its hash modulo 2^15."""
    words = F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9_]+|[^A-Za-z0-9_\s])"), F.lit(1))
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(32768)).cast("int"))


def _ones(n: Column, value: int = 1) -> Column:
    return F.array_repeat(F.lit(value), F.greatest(n, F.lit(0)).cast("int"))


def sft_rows(
    df: DataFrame, prompt: str, response: str, length: int, ids: Tokenizer = word_ids, pad: int = 0, end: int = 1, truncation: str = "error"
) -> DataFrame:
    """``input_ids, attention_mask, position_ids, loss_mask`` of ``length`` entries.

    The loss covers the predictions of response tokens: the first prompt length - 1 entries and the
    last response entry are 0.
    """
    d = df.withColumn("__p", ids(F.col(prompt))).withColumn("__r", F.concat(ids(F.col(response)), F.array(F.lit(end))))
    n_p, n_r = F.size("__p"), F.size("__r")
    full = F.concat(F.col("__p"), F.col("__r"))
    mask = _ones(n_p + n_r)
    fit = lambda a, fill: fit_array(a, length, F.lit(fill), False, truncation)
    last = F.least(n_p + n_r, F.lit(length)) - 1
    first = F.when(n_p > 1, F.least(n_p, F.lit(length)) - 1).otherwise(F.lit(0))
    attention = fit(mask, 0)
    d = d.withColumn("input_ids", fit(full, pad)).withColumn("attention_mask", attention)
    loss = F.transform("attention_mask", lambda m, i: F.when((i < first) | (i == last), F.lit(0)).otherwise(m))
    d = d.withColumn("loss_mask", loss)
    d = d.withColumn("position_ids", F.transform("attention_mask", lambda m, i: F.least(i, F.greatest(n_p + n_r - 1, F.lit(0)))))
    return d.drop("__p", "__r")


def chat_loss_mask(messages: Column, ids: Tokenizer = word_ids) -> Column:
    """1 on the words of assistant messages without their role mark, 0 elsewhere."""

    def one(m: Column) -> Column:
        head = F.size(ids(F.concat(F.lit("<"), m["role"], F.lit(">:"))))
        body = F.size(ids(m["content"]))
        told = F.when(m["role"] == "assistant", F.lit(1)).otherwise(F.lit(0))
        return F.concat(F.array_repeat(F.lit(0), head), F.array_repeat(told, body))

    return F.flatten(F.transform(messages, one))


def chat_ids(messages: Column, ids: Tokenizer = word_ids) -> Column:
    return F.flatten(F.transform(messages, lambda m: ids(F.concat(F.lit("<"), m["role"], F.lit(">: "), m["content"]))))


def pair_rows(df: DataFrame, prompt: str, length: int, ids: Tokenizer = word_ids, pad: int = 0, end: int = 1) -> DataFrame:
    """``chosen_ids`` and ``rejected_ids``: prompt, completion and end mark, right-padded or cut at ``length``.

    A cut row simply ends; it has no end mark.
    """
    for side in ("chosen", "rejected"):
        full = F.concat(ids(F.col(prompt)), ids(F.col(side)), F.array(F.lit(end)))
        cut = F.slice(full, F.lit(1), F.lit(length))
        whole = F.concat(full, F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(full), F.lit(0))))
        df = df.withColumn(side + "_mask", F.concat(_ones(F.least(F.size(full), F.lit(length))), _ones(F.lit(length) - F.size(full), 0)))
        df = df.withColumn(side + "_ids", F.when(F.size(full) <= length, whole).otherwise(cut))
    return df


def media_parts(content: Column, images: Column, videos: Column) -> Column:
    """Text with ``<image>`` and ``<video>`` marks as ``array<struct<type, text>>``; the marks must be
    as many as the media."""
    marked = F.regexp_replace(content, r"(<image>|<video>)", "\u0001$1\u0001")
    pieces = F.filter(F.split(marked, "\u0001"), lambda p: p != "")
    kind = lambda p: F.when(p == "<image>", "image").when(p == "<video>", "video").otherwise("text")
    parts = F.transform(pieces, lambda p: F.struct(kind(p).alias("type"), F.when(kind(p) == "text", p).alias("text")))
    count = lambda k: F.size(F.filter(parts, lambda x: x["type"] == k))
    wrong = F.raise_error(F.lit("placeholders and media differ in number")).cast("array<struct<type:string,text:string>>")
    return F.when((count("image") == images) & (count("video") == videos), parts).otherwise(wrong)
