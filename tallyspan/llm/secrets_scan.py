"""Secret scan: keyword automaton, then anchored expressions near its hits, then checksums.

An Aho-Corasick automaton runs once over each text and finds where a keyword begins; expressions are
only tried anchored at those places. Long hexadecimal runs have no keyword: aligned blocks that are
hexadecimal throughout are found with array comparisons, and only their surroundings are looked at.
Kinds beyond the three base ones carry a checksum inside and count only if it fits.

Kinds, in the order in which spans that start together are listed:

* ``assign``, ``access``, ``hex``: the base kinds;
* ``github``, ``npm``: a prefix, 30 characters, and the CRC-32 of those in six base-62 digits;
* ``card``: 16 digits in one run, starting like a payment card, that pass the Luhn test.

Defined results: a null text is an empty one; spans are code points, end exclusive; the same row
twice gives the same result twice. Extra columns pass
through; one named like the result is replaced by it.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import few_rows, forget, released, utf8

ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_CHECKED = re.compile(rb"(gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_CARD = re.compile(rb"[0-9]{16}(?![0-9])")
KINDS = ("assign", "access", "hex", "github", "npm", "card")
BASE = 3
#: Keyword (lower case) to the rule that is tried where it begins.
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "api_key": "assign", "apikey": "assign", "akia": "access"}
KEYWORDS |= {f"gh{c}_": "checked" for c in "pousr"} | {"npm_": "checked"}
_DIGITS62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_IS_HEX, _IS_DIGIT = np.zeros(256, bool), np.zeros(256, bool)
_IS_HEX[list(b"0123456789abcdef")] = True
_IS_DIGIT[list(b"0123456789")] = True


@functools.cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, rule in KEYWORDS.items():
        found.add_word(word, (len(word), rule))
    found.make_automaton()
    return found


def checksum_fits(body: bytes, check: bytes) -> bool:
    value, digits = zlib.crc32(body), bytearray()
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(_DIGITS62[digit])
    return bytes(reversed(digits)) == check


def luhn_fits(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = (c - 48) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _runs(data: np.ndarray, member: np.ndarray, block: int) -> list[int]:
    """Starts of aligned blocks that are members throughout: a run of 2 * block - 1 covers one."""
    whole = len(data) // block * block
    return (np.flatnonzero(member[data[:whole]].reshape(-1, block).all(axis=1)) * block).tolist()


def _at_runs(text: bytes, starts: list[int], member: np.ndarray, pattern: re.Pattern) -> list[tuple[int, int]]:
    """Whole runs around the blocks, each once."""
    out, end = [], 0
    for at in starts:
        if at < end:
            continue
        while at > end and member[text[at - 1]]:
            at -= 1
        end = pattern.match(text, at).end()
        out.append((at, end))
    return out


_DIGIT_RUN = re.compile(rb"[0-9]+")


def find_secrets(text: bytes) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in bytes, sorted."""
    found: list[tuple[int, int, int]] = []
    hits = sorted((end - size + 1, rule) for end, (size, rule) in automaton().iter(text.lower().decode("latin-1")))
    done = {"assign": 0, "access": 0, "checked": 0}  # matches of one kind do not overlap
    for at, rule in hits:
        if at < done[rule]:
            continue
        if rule == "assign" and (m := _ASSIGN.match(text, at)):
            done[rule] = m.end()
            if m.end(2) - m.start(2) >= ASSIGN_MIN:
                found.append((at, 0, m.end()))
        elif rule == "access" and (m := _ACCESS.match(text, at)):
            done[rule] = m.end()
            if m.end() - at >= ACCESS_MIN:
                found.append((at, 1, m.end()))
        elif rule == "checked" and (m := _CHECKED.match(text, at)) and checksum_fits(m[2], m[3]):
            done[rule] = m.end()
            found.append((at, 4 if m[1] == b"npm" else 3, m.end()))
    data = np.frombuffer(text, np.uint8)
    for at, end in _at_runs(text, _runs(data, _IS_HEX, HEX_MIN // 2), _IS_HEX, _HEX):
        if end - at >= HEX_MIN:
            found.append((at, 2, end))
    for at, end in _at_runs(text, _runs(data, _IS_DIGIT, 8), _IS_DIGIT, _DIGIT_RUN):
        if end - at == 16 and text[at] in b"3456" and luhn_fits(text[at:end]):
            found.append((at, 5, end))
    return sorted(found)


def in_code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    places = sorted({p for a, _, b in spans for p in (a, b)})
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])  # continuation bytes do not count
    point = {p: int(before[p]) for p in places}
    return [(point[a], k, point[b]) for a, k, b in spans]


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _found(text: bytes) -> list[dict]:
    return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in in_code_points(text, find_secrets(text))]


def _spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    forget()
    yield from released(pd.Series([_found(t) for t in texts], dtype=object) for texts in parts)


def _spans_and_text(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    forget()

    def scan(texts: pd.Series) -> pd.DataFrame:
        found = [_found(t) for t in texts]
        clean = [without_spans(t.decode("utf-8", "replace"), s) if s else None for t, s in zip(texts, found)]
        return pd.DataFrame({"spans": pd.Series(found, dtype=object), "text": pd.Series(clean, dtype=object)})

    yield from released(map(scan, parts))


def scan_secrets(docs: DataFrame, text_col: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with an array of ``kind, start, end`` by start, then kind."""
    few_rows(docs.sparkSession)
    return docs.withColumn(out, F.pandas_udf(_spans, SPANS)(utf8(text_col)))


def scan_and_redact(docs: DataFrame, text_col: str = "text", out: str = "found") -> DataFrame:
    """``docs`` with a struct ``spans, text``, in one pass: the text as ``redact`` makes it, null if nothing is found."""
    few_rows(docs.sparkSession)
    return docs.withColumn(out, F.pandas_udf(_spans_and_text, f"struct<spans:{SPANS},text:string>")(utf8(text_col)))


def rendered(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def without_spans(text: str, spans: list) -> str:
    """The text with every span (overlapping ones as one) replaced by the kind in brackets."""
    parts, at = [], 0
    for s in spans:
        if s["end"] <= at:
            continue
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"[{s['kind']}]"]
        at = s["end"]
    return "".join(parts) + text[at:]


def _redacted(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if s is None or not len(s) else without_spans(t, s) for t, s in zip(texts, spans)], dtype=object)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by the kind in brackets."""
    return F.pandas_udf(_redacted, "string")(text, spans)
