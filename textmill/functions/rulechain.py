"""Long ordered rule chains in one Arrow pass."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Iterable[tuple[str, str]]
_START = re.compile(r"(?:\\b)?\(?(?:\?:)?((?:[^\W_]|\\s|_| ){2,})")


def required_prefix(pattern: str) -> str:
    r"""Plain text that every match holds, or "" when none is certain.

    Only patterns that start with literal characters (after an optional \b and one opening
    bracket) and have no alternative at that level give a text; \s ends it.
    """
    found = _START.match(pattern)
    if not found:
        return ""
    depth, escaped, in_class = 0, False, False
    opened = pattern[: found.start(1)].count("(")
    for char in pattern:
        if escaped:
            escaped = False
        elif char == "\\":
            escaped = True
        elif in_class:
            in_class = char != "]"
        elif char == "[":
            in_class = True
        elif char == "(":
            depth += 1
        elif char == ")":
            depth -= 1
        elif char == "|" and depth <= opened:
            return ""
    text = found.group(1).split("\\", 1)[0]
    following = pattern[found.start(1) + len(text):][:1]
    return text[:-1] if following in ("?", "*", "{") and following else text


@lru_cache(maxsize=64)
def compile_rules(table: tuple[tuple[str, str], ...]) -> tuple[tuple[str, re.Pattern, str], ...]:
    return tuple((required_prefix(p), re.compile(p), r) for p, r in table)


def apply_rules(text: str, compiled: Sequence[tuple[str, re.Pattern, str]], masked: bool) -> str:
    """Run one table over one text.

    `masked` substitutes only where the pattern matched the text that entered the table.
    """
    entered = text
    for needed, pattern, replacement in compiled:
        if needed and needed not in text:
            continue
        if masked and not pattern.search(entered):
            continue
        text = pattern.sub(replacement, text)
    return text


def rule_chain(text: Column, tables: Sequence[Rules], mode: str = "sequential", lower: bool = False) -> Column:
    """Apply ordered rule tables one after the other to each text, if asked after lower-casing it.

    Directly on another Arrow function (`html_text`), both run in one trip to the Python worker.
    """
    if mode not in ("sequential", "masked"):
        raise ValueError(f"unknown mode {mode!r}")
    frozen = tuple(tuple(table) for table in tables)
    masked = mode == "masked"

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        compiled = [compile_rules(table) for table in frozen]

        def one(value):
            if value is None:
                return None
            value = value.lower() if lower else value
            for table in compiled:
                value = apply_rules(value, table, masked)
            return value

        return batch.map(one)

    return run(text)
