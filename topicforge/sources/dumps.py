"""Dump sources (A1, A2).

A1 reads a page-dump XML with Spark's built-in XML source (one row per
``<page>``, split across tasks by the file splitter).  A2 finds the
statements of a SQL dump with an automaton over quotes and comments and
turns ``INSERT INTO ... VALUES (...),(...);`` into typed rows with regular
expressions: each statement is split into tuples, each tuple into fields,
all as native expressions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicforge.session import reliable_checkpoint

# Numbers and times are read as text, so that one that is none spoils its own page only and the element stays
# readable as it stands in the dump.
_TEXT = T.StructType([
    T.StructField("_VALUE", T.StringType()),
    T.StructField("_bytes", T.StringType()),
])
_REVISION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("text", _TEXT),
])
PAGE_XML_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("ns", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("redirect", T.StructType([T.StructField("_title", T.StringType())])),
    T.StructField("revision", T.ArrayType(_REVISION)),
])


def read_page_dump(spark: SparkSession, path: str) -> DataFrame:
    """A1: page_id, title, ns, redirect, revisions array<struct<rev_id, ts, text>> of the pages that
    can be read; ``page_dump_parts`` has the others too."""
    return page_dump_parts(spark, path)[0]


def page_dump_parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A1 as two tables: the pages as ``read_page_dump`` gives them, and ``raw``, as JSON, of each page element
    that is none: no page id, or a number or time that does not read as one.  An element whose markup is
    broken has nothing to show: ``{}`` (the source's own column for such records holds the file from
    its start, not the element)."""
    raw = spark.read.format("xml").option("rowTag", "page").option("mode", "PERMISSIVE").schema(PAGE_XML_SCHEMA).load(path)
    revisions = F.coalesce("revision", F.array().cast(T.ArrayType(_REVISION)))

    def wrong(value, kind: str):
        return value.isNotNull() & value.try_cast(kind).isNull()

    bad = (F.col("id").isNull() | wrong(F.col("id"), "bigint") | wrong(F.col("ns"), "int")
           | F.exists(revisions, lambda r: wrong(r["id"], "bigint") | wrong(r["timestamp"], "timestamp")))
    shown = F.to_json(F.struct(*[f.name for f in PAGE_XML_SCHEMA.fields]))
    return _pages(raw.where(~bad)), raw.where(bad).select(shown.alias("raw"))


def _pages(raw: DataFrame) -> DataFrame:
    revs = F.transform(
        F.coalesce(F.col("revision"), F.array().cast(T.ArrayType(_REVISION))),
        lambda r: F.struct(
            r["id"].cast("bigint").alias("rev_id"),
            r["timestamp"].cast("timestamp").alias("ts"),
            F.coalesce(r["text"]["_VALUE"], F.lit("")).alias("text"),
        ),
    )
    return raw.select(
        F.col("id").cast("bigint").alias("page_id"),
        "title",
        F.col("ns").cast("int").alias("ns"),
        F.col("redirect._title").alias("redirect"),
        revs.alias("revisions"),
    )


# A quoted value: escapes or doubled quotes inside.  Possessive runs: matching takes no stack per character.
SQL_QUOTED = r"'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
# One tuple: parentheses around unquoted chars or quoted strings.
SQL_TUPLE = rf"(?s)\((?:[^()']++|{SQL_QUOTED})*+\)"
# One field inside a tuple.
SQL_FIELD = rf"(?s){SQL_QUOTED}|[^,()']++"
# What may stand before a statement: white space and comments.
_LEAD = r"(?:\s++|(?:--(?=\s|$)|#)[^\n]*+(?:\n|$)|/\*(?:[^*]++|\*(?!/))*+\*/;?+)*+"


def _unescape(c):
    # Escaped backslashes part the value first, so what is left of each other escape is unambiguous.
    def part(x):
        for esc, ch in (("''", "'"), ("\\'", "'"), ('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"),
                        ("\\t", "\t"), ("\\0", "\u0000"), ("\\Z", "\u001a"), ("\\b", "\b")):
            x = F.replace(x, F.lit(esc), F.lit(ch))
        # \% and \_ keep their backslash; any other escaped character stands for itself.
        return F.regexp_replace(x, r"\\([^%_])", "$1")

    return F.array_join(F.transform(F.split(c, r"\\\\"), part), "\\")


#: States of the automaton at the start of a line, and what may come next in each (fixed by the SQL
#: dialect): outside, in a quoted value by ' or ", in a quoted name, in a comment.
_EVENTS = (r"""['"`;]|--(?=\s|$)|\#|/\*""", r"\\(?:.|$)|''|'", r'\\(?:.|$)|""|"', "``|`", r"\*/")
_OPENS = {"'": 1, '"': 2, "`": 3, "/*": 4}


def _scanner():
    """A function from a line and the state at its start to the state at its end and the places of the
    ``;`` that end statements.  A line comment ends with its line; an escaped line end stays in its value."""
    events = [re.compile(e, re.S) for e in _EVENTS]
    closes, opens = {1: "'", 2: '"', 3: "`", 4: "*/"}, dict(_OPENS)

    def scan(line: str, state: int) -> tuple[int, list[int]]:
        at, ends = 0, []
        while True:
            m = events[state].search(line, at)
            if m is None:
                return state, ends
            what, at = m.group(), m.end()
            if state:
                state = 0 if what == closes[state] else state
            elif what == ";":
                ends.append(m.start())
            elif what in opens:
                state = opens[what]
            else:
                return 0, ends

    return scan


def _runs(batches, keys: int):
    """Lines of Arrow batches by split of a file, in order: (keys, line) with the first columns as keys."""
    for b in batches:
        for *key, line in zip(*[c.to_pylist() for c in b.columns]):
            yield tuple(key[:keys]), key, line


def sql_statements(spark: SparkSession, path: str) -> DataFrame:
    """The statements of a dump, as ``value`` without their ``;``: a statement ends where ``;`` stands outside
    quotes and comments, whatever the line ends.

    Splits of a file are scanned in parallel, though whether a split begins inside a value depends on all
    before it: each split gives its map from every state at its start to the state at its end, the maps
    of a file are composed in order (one row a split), and a second pass cuts each split from the state
    found.  Only statements that cross splits are put together by a shuffle.  A file that ends inside a value or
    comment is an error."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    scan, runs = _scanner(), _runs

    def maps(batches):
        now, ends, cut = None, None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1]], pa.int64()), pa.array([ends], pa.list_(pa.int32())),
                                               pa.array([cut], pa.list_(pa.bool_()))], ["file", "start", "ends", "cut"])

        for key, _, line in runs(batches, 2):
            if key != now:
                if now is not None:
                    yield row()
                now, ends, cut = key, list(range(5)), [False] * 5
            step = {s: scan(line, s) for s in set(ends)}  # states that have met go on as one
            cut = [c or bool(step[s][1]) for s, c in zip(ends, cut)]
            ends = [step[s][0] for s in ends]
        if now is not None:
            yield row()

    def composed(part: pd.DataFrame) -> pd.DataFrame:
        part, state, opened, out = part.sort_values("start"), 0, -1, []
        for no, (file, start, ends, cut) in enumerate(zip(part["file"], part["start"], part["ends"], part["cut"])):
            out.append((file, start, no, state, opened, no + 1 == len(part) and ends[state] != 0))
            opened, state = no if cut[state] else opened, ends[state]
        return pd.DataFrame(out, columns=["file", "start", "no", "state", "opened", "broken"])

    def pieces(batches):
        now, whole, crossing, text, state, first = None, [], [], [], 0, True

        def give():
            columns = list(zip(*crossing)) or [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([*(pa.array(list(c), t) for c, t in zip(columns, kinds))], ["file", "opened", "no", "value"])
            if whole:
                n = len(whole)
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(whole, pa.string())],
                                                 ["file", "opened", "no", "value"])
            whole.clear()
            crossing.clear()

        def rest():
            # What the split leaves open: its head too, if no statement ended in it.
            crossing.append((now[0], now[2] if first else now[1], now[1], "\n".join(text)))

        for key, (file, start, no, state_at, opened), line in runs(batches, 2):
            if now is None or key != now[3]:
                if now is not None:
                    rest()
                now, text, state, first = (file, no, opened, key), [], state_at, True
            state, ends = scan(line, state)
            at = 0
            for end in ends:
                value = "\n".join([*text, line[at:end]])
                if first:
                    crossing.append((file, opened, no, value))
                else:
                    whole.append(value)
                text, first, at = [], False, end + 1
            text.append(line[at:])
            if len(whole) > 256:
                yield from give()
        if now is not None:
            rest()
            yield from give()

    table = lines.mapInArrow(maps, "file string, start bigint, ends array<int>, cut array<boolean>")
    starts = reliable_checkpoint(table.groupBy("file").applyInPandas(composed, "file string, start bigint, no bigint, state int, opened bigint, broken boolean"))
    known = starts.select("file", "start", "no", "state", "opened", F.when(F.col("broken"), F.raise_error(F.concat(
        F.lit("ends inside a value or comment: "), F.col("file")))).otherwise(F.lit(True)).alias("fine"))
    # One row a split; broadcast, so that lines keep their order.
    placed = lines.join(F.broadcast(known), ["file", "start"]).where("fine").select("file", "start", "no", "state", "opened", "value")
    cut = placed.mapInArrow(pieces, "file string, opened bigint, no bigint, value string")
    joined = cut.where("file IS NOT NULL").groupBy("file", "opened").agg(F.array_sort(F.collect_list(F.struct("no", "value"))).alias("p")).select(
        F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"))
    return joined.unionByName(cut.where("file IS NULL").select("value"))


def read_sql_dump(spark: SparkSession, path: str, table: str,
                  columns: Sequence[tuple[str, str]]) -> DataFrame:
    """A2: rows of ``table`` from a SQL dump.

    ``columns`` is the caller's (name, Spark type) list in column order;
    values are converted with ``try_cast`` so bad values become null.
    A column list and line breaks around VALUES are allowed.  A statement
    that inserts into ``table`` and is not wholly made of tuples is an
    error, and so is a file that ends inside a value or a comment."""
    into = rf"INSERT\s+(?:IGNORE\s+)?INTO\s+`?{re.escape(table)}`?[\s(]"
    head = rf"(?is)^{_LEAD}INSERT\s+(?:IGNORE\s+)?INTO\s+`?{re.escape(table)}`?\s*(?:\([^()]*\)\s*)?VALUES\s*"
    stmts = sql_statements(spark, path).where(F.col("value").rlike(rf"(?i)^{_LEAD}{into}"))
    body = F.regexp_replace(F.regexp_replace("value", head, ""), r"[;\s]+$", "")
    rest = F.regexp_replace(body, SQL_TUPLE, "")
    ok = F.col("value").rlike(head) & rest.rlike(r"^[\s,]*$")
    checked = F.when(ok, F.regexp_extract_all(body, F.lit(SQL_TUPLE), 0)).otherwise(
        F.raise_error(F.concat(F.lit(f"not a plain INSERT into {table}: "), F.substring("value", 1, 80))))
    tuples = stmts.select(F.explode(checked).alias("t"))
    fields = tuples.select(F.regexp_extract_all(F.col("t"), F.lit(SQL_FIELD), 0).alias("f"))
    out = []
    for i, (name, typ) in enumerate(columns):
        raw = F.trim(F.get(F.col("f"), i))
        quoted = F.startswith(raw, F.lit("'"))
        val = (
            F.when(raw == F.lit("NULL"), F.lit(None).cast("string"))
            .when(quoted, _unescape(F.substring(raw, F.lit(2), F.length(raw) - 2)))
            .otherwise(raw)
        )
        out.append(val.try_cast(typ).alias(name) if typ != "string" else val.alias(name))
    return fields.select(*out)
