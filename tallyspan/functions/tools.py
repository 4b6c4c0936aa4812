"""Tool use as column expressions: named actions as a bag, their inputs as one merged object.

Inputs are read as VARIANT, so that nested values compare by content, whatever the order of their keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspan.functions.values import bound

_PAIRS = "array<struct<key string, value string>>"
_OBJECT = "map<string, variant>"


def _pairs(block: Column) -> Column:
    """Keys (in the order of the text) and values of a JSON object; null for any other text."""
    read = F.try_variant_get(F.try_parse_json(block), "$", _OBJECT)
    return bound(read, lambda o: F.when(o.isNotNull(), F.transform(F.json_object_keys(block), lambda k: F.struct(k.alias("key"), _written(o[k]).alias("value")))))


def _written(value: Column) -> Column:
    """A value as it is shown: text in quotes, True, False, None, else JSON."""
    kind = F.schema_of_variant(value)
    text = value.cast("string")
    quoted = F.when(F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"')), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )
    truth = F.when(text == "true", "True").otherwise("False")
    return F.when(kind == "STRING", quoted).when(kind == "BOOLEAN", truth).when(kind == "VOID", "None").otherwise(F.to_json(value))


def _merged(objects: Column) -> Column:
    """One list of pairs: a key stays where it came first and has the value that came last."""
    none = F.array().cast(_PAIRS)

    def add(seen: Column, pair: Column) -> Column:
        known = F.exists(seen, lambda p: p["key"] == pair["key"])
        changed = F.transform(seen, lambda p: F.when(p["key"] == pair["key"], pair).otherwise(p))
        return F.when(known, changed).otherwise(F.concat(seen, F.array(pair)))

    return F.aggregate(F.flatten(F.transform(objects, lambda o: F.coalesce(o, none))), none, add)


def _quoted(names: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", "), F.lit("]"))


def _shown(pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda p: F.concat(F.lit("'"), p["key"], F.lit("': "), p["value"])), ", "), F.lit("}"))


def use_score(solution: Column, truth: Column) -> Column:
    """``struct<score, pred, incorrect_format, feedback, nested_cut>``: 1 if the action names are the wanted
    ones, in any order, and the merged inputs are equal.

    An input block ends at the first closing brace, so a nested object is cut and, being bad JSON, left
    out; ``nested_cut`` tells that a full parse would have read more. ``truth`` is a list of objects with
    ``Action`` and ``Action_Input`` (an object or its text).
    """
    blocks = F.regexp_extract_all(solution, F.lit(r"(?s)Action Input:\s*(\{.*?\})"), F.lit(1))
    names = F.regexp_extract_all(solution, F.lit(r"(?U)Action:\s*(\w+)"), F.lit(1))
    formatted = F.rlike(solution, F.lit(r"(?s)Action:.*?\nAction Input:"))
    read = F.transform(blocks, lambda b: F.struct(b.alias("text"), _pairs(b).alias("pairs")))
    items = F.try_variant_get(F.try_parse_json(truth), "$", f"array<{_OBJECT}>")

    def input_text(value: Column) -> Column:
        return F.when(F.schema_of_variant(value) == "STRING", value.cast("string")).otherwise(F.to_json(value))

    def compare(s: Column) -> Column:
        got, want = s["inputs"], s["expected"]
        same_names = F.array_sort(s["names"]) == F.array_sort(s["wanted"])
        same_inputs = F.array_sort(got) == F.array_sort(want)
        versus = lambda what, a, b: F.concat(F.lit(f"{what} mismatch: predicted "), a, F.lit(", expected "), b)
        notes = F.concat_ws(
            "; ",
            F.when(~same_names, versus("Actions", _quoted(s["names"]), _quoted(s["wanted"]))),
            F.when(~same_inputs, versus("Action inputs", _shown(got), _shown(want))),
        )
        return F.struct(
            (same_names & same_inputs).cast("double").alias("score"),
            F.concat(F.lit("Actions: "), _quoted(s["names"]), F.lit(", Inputs: "), _shown(got)).alias("pred"),
            F.when(s["formatted"], 0).otherwise(1).alias("incorrect_format"),
            notes.alias("feedback"),
            s["cut"].alias("nested_cut"),
        )

    opened = lambda t, c: F.size(F.split(t, c))
    cut = lambda b: b["pairs"].isNull() & (opened(b["text"], r"\{") > opened(b["text"], r"\}"))

    def scored(p: Column) -> Column:
        known = F.struct(
            p["names"].alias("names"),
            F.transform(p["items"], lambda o: F.coalesce(o["Action"].cast("string"), F.lit(""))).alias("wanted"),
            _merged(F.transform(p["read"], lambda b: b["pairs"])).alias("inputs"),
            _merged(F.transform(p["items"], lambda o: _pairs(input_text(o["Action_Input"])))).alias("expected"),
            p["formatted"].alias("formatted"),
            F.exists(p["read"], cut).alias("cut"),
        )
        unread = F.struct(
            F.lit(0.0).alias("score"),
            F.lit("").alias("pred"),
            F.lit(1).alias("incorrect_format"),
            F.lit("Failed to parse ground truth JSON").alias("feedback"),
            F.exists(p["read"], cut).alias("nested_cut"),
        )
        return F.when(p["items"].isNull(), unread).otherwise(bound(known, compare))

    return F.when(solution.isNotNull(), bound(F.struct(read.alias("read"), items.alias("items"), names.alias("names"), formatted.alias("formatted")), scored))
