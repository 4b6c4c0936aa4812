"""Written maths answers as column expressions: one spelling, plain text, and entry-by-entry grading.

``spelled`` brings LaTeX into one spelling, ``plain`` strips markup, units and number words, and
``graded`` compares two answers by either and then entry by entry. Answers are never evaluated.
Everything is a chain of replacements inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspan.functions.values import bound

# fixed values: replacements in order
MATH_REPLACEMENTS = [
    ("\n", ""), ("\\!", ""), ("\\\\", "\\"), ("tfrac", "frac"), ("dfrac", "frac"),
    ("\\left", ""), ("\\right", ""), ("^{\\circ}", ""), ("^\\circ", ""), ("\\$", ""),
]
# fixed values: units dropped from answers
UNITS = [
    "degree", "cm", "centimeter", "meter", "mile", "second", "minute", "hour", "day", "week",
    "month", "year", "foot", "feet", "inch", "yard", "liter",
]
# fixed values: replacements in order
ANSWER_REPLACEMENTS = [
    ("\\%", "%"), ("\\$", "$"), ("$", ""), ("%", ""), (" or ", " , "), (" and ", " , "),
    ("million", "*10^6"), ("billion", "*10^9"), ("trillion", "*10^12"),
]
# fixed values: LaTeX commands with a plain-text form
LATEX_TEXT = [("\\pi", "pi"), ("\\infty", "inf"), ("\\cup", "U"), ("\\cdot", "*"), ("\\times", "*")]

_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
_NEAR_WHOLE = 1e-7


def replaced(text: Column, table: list[tuple[str, str]]) -> Column:
    for old, new in table:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def spelled(text: Column) -> Column:
    r"""``struct<text, readable>``: fractions, roots, decimals and ``a/b`` in one spelling, without degree
    signs, percent signs, blanks, a unit behind ``\text{ `` and a short left side of an equation.

    Not readable: two units, a root or a fraction that ends the text or is followed by another one of its kind.
    """
    return bound(replaced(text, MATH_REPLACEMENTS), _spelled_clean)


def _spelled_clean(clean: Column) -> Column:
    value = F.substring_index(clean, "\\text{ ", 1)
    rules = [
        (r"\\{1,2}%", ""),
        (r"(?<![^ {])\.", "0."),  # a decimal point without a digit
        (r"^[^=]{0,2}=(?=[^=]*\z)", ""),
        (r"\\sqrt([^{])", r"\\sqrt{$1}"),
        (" ", ""),
    ]
    for pattern, new in rules:
        value = F.regexp_replace(value, pattern, new)
    units = F.size(F.split(clean, r"\\text\{ ")) - 1
    lone_root = F.rlike(clean, F.lit(r"\\sqrt(\s*\\sqrt|\s*\z)"))
    return bound(value, lambda v: _with_fractions(v, (units <= 1) & ~lone_root))


def _with_fractions(value: Column, readable: Column) -> Column:
    # a fraction of which less than two symbols are there: none at all cannot be read, one is left alone
    stump = r"\\frac([^{]?)(?=\\frac|\z)"
    short = F.rlike(value, F.lit(stump))
    bare = F.rlike(value, F.lit(stump)) & (F.regexp_extract(value, stump, 1) == "")
    braced = F.regexp_replace(F.regexp_replace(value, r"\\frac([^{])\{", r"\\frac{$1}{"), r"\\frac([^{])([^{])", r"\\frac{$1}{$2}")
    whole = r"(0|-?[1-9][0-9]*)"
    ratio = F.regexp_replace(braced, rf"^{whole}/{whole}\z", r"\\frac{$1}{$2}")
    text = F.when(short, value).when(value == "0.5", "\\frac{1}{2}").otherwise(ratio)
    return F.struct(text.alias("text"), (readable & ~bare).alias("readable"))


#: What a text must have for ``spelled`` to change it, or to find it unreadable.
_UNSPELLED = r"[\n\\^.= /]|[td]frac"
#: Texts that ``plain`` leaves as they are: digits, a ratio of them, lists of them in brackets.
_PLAIN = r"^(0|[1-9][0-9]{0,14}|[0-9]+/[0-9]+|[(\[][0-9,()\[\]]*)\z"


def normalised(text: Column) -> Column:
    """The text in one spelling; an unreadable one as it is."""

    def full(raw: Column) -> Column:
        return bound(spelled(raw), lambda s: F.when(s["readable"], s["text"]).otherwise(raw))

    # most texts have nothing to respell, and one look shows it
    return bound(text, lambda raw: F.when(F.rlike(raw, F.lit(_UNSPELLED)), full(raw)).otherwise(raw))


def same(a: Column, b: Column) -> Column:
    """Equal in one spelling; texts of which one is unreadable are compared as they are; two nulls are equal."""

    def compare(both: Column) -> Column:
        readable = both["a"]["readable"] & both["b"]["readable"]
        return F.when(readable, both["a"]["text"] == both["b"]["text"]).otherwise(both["raw_a"] == both["raw_b"])

    # a lambda may not hold a Python function, which a text may come from
    either = bound(F.struct(spelled(a).alias("a"), spelled(b).alias("b"), a.alias("raw_a"), b.alias("raw_b")), compare)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(either)


# ---- plain answers -----------------------------------------------------------------------


def without_separators(text: Column) -> Column:
    """Thousands separators dropped."""
    return F.regexp_replace(text, r"(?<=\d),(?=\d{3}(?!\d))", "")


def number_of(text: Column) -> Column:
    return F.when(F.rlike(text, F.lit(_NUMBER)), F.trim(text).try_cast("double"))


def whole_of(text: Column) -> Column:
    """The whole number that a text is, to seven digits, as a decimal; else null."""

    def near(x: Column) -> Column:
        return F.when(F.abs(x - F.rint(x)) <= _NEAR_WHOLE, F.rint(x).try_cast("decimal(38,0)"))

    return bound(number_of(text), near)


def _unwrapped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)^\\text\{(.+?)\}\z", "$1")


def _plain_latex(text: Column) -> Column:
    text = F.regexp_replace(text, r"\\[td]?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", " $1/$2")
    text = F.regexp_replace(text, r"\\sqrt\s*\{([^{}]*)\}", "sqrt($1)")
    text = replaced(text, LATEX_TEXT)
    # what has braces left is not understood and stays as it is
    return F.trim(F.when(F.contains(text, F.lit("{")), text).otherwise(F.replace(text, F.lit("\\"), F.lit(""))))


def plain(text: Column) -> Column:
    """Answer without markup, units and number words, in lower case; a whole number as its digits."""
    return bound(text, lambda t: F.when(F.rlike(t, F.lit(_PLAIN)), t).otherwise(_made_plain(t)))


def _made_plain(text: Column) -> Column:
    value = replaced(_unwrapped(text), ANSWER_REPLACEMENTS)
    value = F.regexp_replace(value, rf"(?:{'|'.join(UNITS)})(?:es)?s? *(?:\^[0-9]+)?", "")
    value = F.regexp_replace(value, r"\^ *\\circ|,\\! *", "")
    value = F.regexp_replace(value, r"(?s)^\{(.*)\}\z", "$1")
    as_whole = lambda v: bound(whole_of(v), lambda w: F.coalesce(w.cast("string"), v))
    value = bound(value, as_whole)
    value = bound(value, lambda v: F.when(F.contains(v, F.lit("\\")), _plain_latex(v)).otherwise(v))
    # a mixed number is a sum
    value = F.lower(F.regexp_replace(F.regexp_replace(value, "- *", "-"), r"(?<=[0-9]) +(?=[0-9])", "+"))
    whole = lambda v: bound(whole_of(without_separators(v)), lambda w: F.coalesce(w.cast("string"), v))
    return bound(value, whole)


def _entries(text: Column) -> Column:
    """Entries of a tuple or an interval; any other text is one entry, an empty one none."""
    return bound(without_separators(text), _listed)


def _listed(value: Column) -> Column:
    listed = F.rlike(value, F.lit(r"(?s)^[()\[\]][^()\[\]]+[()\[\]]\z"))
    inner = F.substr(value, F.lit(2), F.length(value) - 2)
    return F.when(value == "", F.array().cast("array<string>")).when(listed, F.transform(F.split(inner, ","), lambda p: F.trim(p))).otherwise(F.array(value))


def _alike(a: Column, b: Column) -> Column:
    """Ratios must be written alike, a whole number only equals a whole one, other texts and numbers must be equal."""
    ratio = F.lit(r"^-?[0-9]+.?/0*[1-9][0-9]*.?\z")
    numbers = lambda v: F.struct(whole_of(v).alias("w"), number_of(v).alias("x"))
    read = lambda t: F.struct(t.alias("t"), bound(without_separators(t), numbers).alias("n"))

    def agree(p: Column) -> Column:
        a, b = p["a"], p["b"]
        same_kind = a["n"]["w"].isNull() == b["n"]["w"].isNull()
        equal = (a["t"] == b["t"]) | F.coalesce(a["n"]["x"] == b["n"]["x"], F.lit(False))
        return F.when(F.rlike(a["t"], ratio) & F.rlike(b["t"], ratio), a["t"] == b["t"]).otherwise(same_kind & equal)

    return bound(F.struct(read(a).alias("a"), read(b).alias("b")), agree)


def graded(given: Column, truth: Column) -> Column:
    """Equal in one spelling, as plain answers, or entry by entry with the same brackets; false without an answer."""
    spelling = lambda t: normalised(F.trim(_unwrapped(F.regexp_replace(t, r"^\s+|\s+\z", ""))))

    def entries(p: Column) -> Column:
        a, b = p["truth"], p["given"]
        ends = (F.left(a, F.lit(1)) == F.left(b, F.lit(1))) & (F.right(a, F.lit(1)) == F.right(b, F.lit(1)))

        def agree(e: Column) -> Column:
            left, right = e["left"], e["right"]
            listed = (F.size(left) == F.size(right)) & ((F.size(left) <= 1) | ends)
            return listed & F.forall(F.zip_with(left, right, lambda x, y: F.coalesce(_alike(x, y), F.lit(False))), lambda x: x)

        return (a == b) | ((b != "") & bound(F.struct(_entries(a).alias("left"), _entries(b).alias("right")), agree))

    by_entry = bound(F.struct(plain(truth).alias("truth"), plain(given).alias("given")), entries)
    return F.when(given.isNull() | truth.isNull(), False).otherwise((spelling(given) == spelling(truth)) | by_entry)
