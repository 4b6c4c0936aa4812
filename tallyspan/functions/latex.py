"""The search for a balanced box, which no regular expression can express; used inside Arrow UDFs."""

from __future__ import annotations

import re

# ---- boxes -------------------------------------------------------------------------------


def brace_end(text: str, start: int) -> int | None:
    """Index of the brace that closes the first one opened at or after ``start``."""
    depth = 0
    for hit in re.compile(r"[{}]").finditer(text, start):
        depth += 1 if hit.group() == "{" else -1
        if depth == 0:
            return hit.start()
    return None


def last_box(text: str | None) -> str | None:
    r"""Content of the last ``\boxed{...}`` with balanced braces; None without a closed box."""
    if text is None:
        return None
    at = text.rfind("\\boxed{")
    end = brace_end(text, at) if at >= 0 else None
    return None if end is None else text[at + len("\\boxed{") : end]


def last_box_lenient(text: str | None) -> str | None:
    r"""As ``last_box`` but ``\boxed x$`` counts up to the next dollar sign."""
    if text is None:
        return None
    spaced = text.rpartition("\\boxed ")
    if spaced[1]:
        return spaced[2].split("$")[0]
    at = text.rfind("\\boxed")
    # a bare \\fbox is found by the lenient search but has no readable content
    end = brace_end(text, at) if text.startswith("\\boxed{", max(at, 0)) else None
    if end is None:
        return None
    return text[at + len("\\boxed{") : end]


def box_content(text: str) -> str | None:
    r"""Stripped content of the last ``\boxed`` or, without one, ``\fbox``."""
    at = text.rfind("\\boxed") if "\\boxed" in text else text.rfind("\\fbox")
    if at < 0:
        return None
    opened, end = text.find("{", at), brace_end(text, at)
    return None if opened < 0 or end is None or end < opened else text[opened + 1 : end].strip()
