"""Numbers, tuples and free-text answers as column expressions.

An answer is read as a bracket pair and a list of entries; two answers are equal if their pairs and
their entries are. Nothing here leaves the JVM except the search for a balanced box.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: written intervals and their brackets
INTERVALS = {"Interval.Ropen": "[)", "Interval.Lopen": "(]", "Interval.open": "()", "Interval": "[]"}
# fixed values: words before and after an answer, and words an answer follows in a sentence
ANSWER_AHEAD = ["answer:", "answer is", "answers are"]
ANSWER_BEHIND = ["is answer", "is the answer", "are answers", "are the answers"]
ANSWER_TAIL = ["be", "is", "are", "get"]

_THOUSANDS = r"^[-+]?\d{1,3}(,\d{3})+(\.\d+)?$"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def _bracketed(text: Column) -> Column:
    """``Interval.open(a, b)`` as ``(a, b)``."""
    return bound(text, _unnamed)


def _unnamed(text: Column) -> Column:
    out = text
    for name, pair in INTERVALS.items():
        body = F.substring(text, len(name) + 2, 1_000_000_000)
        inner = F.left(body, F.length(body) - 1)
        written = F.startswith(text, F.lit(name + "(")) & F.endswith(text, F.lit(")"))
        out = F.when(written, F.concat(F.lit(pair[0]), inner, F.lit(pair[1]))).otherwise(out)
    return out


def bare_number(text: Column) -> Column:
    """A text without separators, a dollar sign, a percent sign and a base suffix."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"\{,\}|,", ""), r"^\$|\\?%$", "")
    return F.regexp_replace(bare, r"^([-+]?\d+)(?:\.\d*)?_.*$", "$1")


def read_number(bare: Column, pi: float = math.pi) -> Column:
    """The number that a bare text is, a factor of pi multiplied out; null for any other text."""
    factor = r"^([-+]?\d*\.?\d*)\s*\\pi\s*(?:/\s*(\d+\.?\d*))?$"
    # no digit before pi stands for one
    times = F.regexp_replace(F.regexp_extract(bare, factor, 1), r"^([-+]?)$", "$11").try_cast("double")
    over = F.regexp_replace(F.regexp_extract(bare, factor, 2), "^$", "1").try_cast("double")
    plain = F.when(F.rlike(bare, F.lit(r"^[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?$")), bare.try_cast("double"))
    return F.when(F.endswith(bare, F.lit("pi")) | F.contains(bare, F.lit("pi/")), times * F.lit(pi) / over).otherwise(plain)


def _squeezed(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[\s{}]", "")


def _entries(text: Column, pi: float) -> Column:
    """``struct<pair, parts>`` of an answer, a part being its text and its number; a number with
    separators is one part."""
    first, last = F.left(text, F.lit(1)), F.right(text, F.lit(1))
    closed = (F.length(text) > 2) & first.isin("(", "[") & last.isin(")", "]")
    pair = F.when(closed, F.concat(first, last)).otherwise("")

    def read(pair: Column) -> Column:
        inner = F.when(pair == "", text).otherwise(F.substr(text, F.lit(2), F.length(text) - 2))
        one = F.rlike(inner, F.lit(_THOUSANDS)) | F.contains(inner, F.lit("{,}"))
        bare = F.transform(F.when(one, F.array(inner)).otherwise(F.split(inner, ",")), lambda p: F.struct(_squeezed(p).alias("text"), bare_number(p).alias("bare")))
        parts = F.transform(bare, lambda p: F.struct(p["text"].alias("text"), read_number(p["bare"], pi).alias("number")))
        return F.struct(pair.alias("pair"), parts.alias("parts"))

    return bound(pair, read)


def numbers_equal(given: Column, truth: Column, percent: bool = True, tolerance: float = 1e-4, pi: float = math.pi) -> Column:
    """Equal as numbers (also a factor 100 apart), as text, or entry by entry as tuples and intervals."""
    scales = (1.0, 0.01, 100.0) if percent else (1.0,)

    def same(a: Column, b: Column) -> Column:
        x, y = a["number"], b["number"]
        near = F.lit(False)
        for scale in scales:
            near = near | (F.abs(y * scale - x) <= F.lit(tolerance) * F.greatest(F.abs(y * scale), F.abs(x)))
        return (a["text"] == b["text"]) | F.coalesce(near, F.lit(False))

    def equal(both: Column) -> Column:
        left, right = both["left"], both["right"]
        # an empty entry equals none, except that equal texts are equal as a whole
        pairs = F.zip_with(left["parts"], right["parts"], lambda a, b: (a["text"] != "") & same(a, b))
        alike = (left["pair"] == right["pair"]) & (F.size(left["parts"]) == F.size(right["parts"]))
        return alike & F.forall(pairs, lambda e: F.coalesce(e, F.lit(False)))

    def entries(text: Column) -> Column:
        return bound(_bracketed(F.regexp_replace(F.trim(text), r"^Point\s*(?=\()", "")), lambda t: _entries(t, pi))

    listed = bound(F.struct(entries(given).alias("left"), entries(truth).alias("right")), equal)
    return F.when(given.isNotNull() & truth.isNotNull(), (_squeezed(given) == _squeezed(truth)) | listed)


def _any_of(marks: list[str]) -> str:
    return "(?:" + "|".join(rf"\Q{m}\E" for m in marks) + ")"


def free_text_answer(text: Column, box) -> Column:
    """``struct<matched, answer>``: what stands after the last announcement of an answer and before the
    last "is the answer", the last box in it, the text up to the last sentence end, and of that what
    follows the last verb, equals sign or colon; matched if something was cut and a digit is left.
    ``box`` finds the content of the last box of a column."""
    ahead = rf"(?is)^.*{_any_of(ANSWER_AHEAD)}(.*)$"
    behind = rf"(?is)^(.*){_any_of(ANSWER_BEHIND)}.*$"
    tail = rf"(?is)^.*(?:{_any_of(ANSWER_TAIL)}[ \n]|=|:[ \n])(.*)$"
    found = F.lit(False)

    def cut(value: Column, pattern: str) -> Column:
        nonlocal found
        hit = F.rlike(value, F.lit(pattern))
        found = found | hit
        return F.when(hit, F.trim(F.regexp_extract(value, pattern, 1))).otherwise(value)

    value = cut(cut(text, ahead), behind)
    boxed = box(value)
    has_box = F.coalesce(F.length(boxed) > 0, F.lit(False))
    found = found | has_box
    value = F.when(has_box, boxed).otherwise(value)
    value = F.trim(F.regexp_replace(value, r"(?s)^(.*)\. .*$", "$1"))
    value = cut(value, tail)
    return F.when(text.isNotNull(), F.struct((found & F.rlike(value, F.lit(r"\d"))).alias("matched"), value.alias("answer")))


#: A line that opens the input or example section: a heading of decorated words, or a line with a mark.
_HEADING = r"input(?:\s+(?:format|specification|section))?|input\s*(?:and|&|/)\s*output|examples?\s*\d*"
_SECTION = rf"(?im)^(?:[^\p{{L}}\p{{N}}\n]*(?:{_HEADING})[^\p{{L}}\p{{N}}\n]*|\W*input\s*:?\s*[-–—].*|.*(?:for\s+example\s*:|```|-{{5}}).*)$"


def description_of(problem: Column, least: int = 10) -> Column:
    """Text before the first input or example section; one of fewer than ``least`` characters is none."""
    head = F.split(problem, _SECTION, 2)[0]
    # a line of decoration at the end belongs to the section
    text = F.regexp_replace(head, r"\n[^\p{L}\p{N}\n]*\s*$", "")
    return F.when(F.length(head) < least, "").otherwise(F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")))
