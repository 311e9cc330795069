"""Nested markup and character references: the two text rules that no regular expression can state whole.

Nesting needs a stack and the standard table of named references has some two thousand entries, so both run
as Arrow-batched scalars over a small helper.  Only values that hold the opening character are sent to
Python; all others never leave the JVM.  The helpers are nested functions on purpose: they travel to the
workers by value.  Their batches are small ones, for a row is a whole text and each of the two scalars has a
worker of its own in every task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from topicforge.functions.text import bind
from topicforge.llm.batches import small_batches

# Runs of two braces or more (templates, parameters), and the marks of tables.
BRACES = r"\{\{+|\}\}+"
TABLE_MARKS = r"\{\||\|\}"


def _nesting_remover():
    kinds = (BRACES, TABLE_MARKS)

    def without(values: pd.Series) -> pd.Series:
        import re

        braces, tables = (re.compile(k) for k in kinds)

        def one(text: str, token: re.Pattern) -> str:
            open_: list[list[int]] = []  # place and number of opening characters that wait for their end
            gone: list[tuple[int, int]] = []
            for m in token.finditer(text):
                left = m.end() - m.start()
                if text[m.start()] == "{":
                    open_.append([m.start(), left])
                    continue
                while left > 1 and open_:
                    start, n = open_[-1]
                    taken = min(n, left)
                    n, left = n - taken, left - taken
                    gone.append((start + n, m.end() - left))
                    if n > 1:
                        open_[-1][1] = n
                    else:
                        open_.pop()
            out, at = [], 0
            for lo, hi in sorted(gone):
                if hi > at:
                    out.append(text[at:max(lo, at)])
                    at = hi
            return "".join(out) + text[at:]

        return values.map(lambda t: one(one(t, braces), tables), na_action="ignore")

    return F.pandas_udf(without, StringType())


def _decoder():
    def decode(values: pd.Series) -> pd.Series:
        import html

        return values.map(html.unescape, na_action="ignore")

    return F.pandas_udf(decode, StringType())


def remove_nested(c: Column) -> Column:
    """Without templates and parameters (``{{...}}``, ``{{{...}}}``), then without tables (``{|...|}``), of any
    depth.  What is opened and never closed, or closed and never opened, stays as text."""
    small_batches()
    marked = bind(c, lambda v: F.when(F.contains(v, F.lit("{{")) | F.contains(v, F.lit("{|")), v))
    return F.coalesce(_nesting_remover()(marked), c)


def decode_references(c: Column) -> Column:
    """Named (the whole standard table) and numeric character references, each decoded once."""
    small_batches()
    return F.coalesce(_decoder()(bind(c, lambda v: F.when(F.contains(v, F.lit("&")), v))), c)
