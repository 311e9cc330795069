"""Plain-text scalar functions.

Every function returns a native Column expression, so it runs inside
whole-stage codegen; no Python runs per row.

Regular expressions are written in a portable subset (no look-around;
only ``\\n`` ends a line) so that the same pattern means the same thing
in Java's engine and in RE2.  ``java()`` adds the UNIX_LINES flag that
makes Java treat only ``\\n`` as a line terminator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicforge.constants import LEAD_SENTENCES

# Unicode whitespace as Python's str.isspace() sees it: ASCII space and
# controls, the file/group/record/unit separators, NEL and every Z* char.
WS = r"[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]"
# The same set spelled out, derived by rule (all such chars are below U+3001).
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
TRIM = r"\A" + WS + r"+|" + WS + r"+\z"
# --- fixed values (the text-cleaning rule; must equal the reference's) ---
# 1. lines starting with "Category:" are emptied, 2. "|" becomes a space,
# 3. runs of two or more whitespace characters become one space, 4. strip.
CATEGORY_LINE = r"(?m)^Category:.*$"
PIPE = "|"
WS_RUN = WS + r"{2,}"
# --- end of fixed values ---

# Sentence rule: a run of terminators, optional closing quotes/brackets,
# then whitespace.  Abbreviations are protected with \x02 first.
SENT_END = r"([.!?]+[\"'”’)\]]*)" + WS + r"+"
SENT_MARK = "\x01"
ABBR_MARK = "\x02"
DEFAULT_ABBREVIATIONS: tuple[str, ...] = (
    "Dr", "Mr", "Mrs", "Ms", "Prof", "St", "Jr", "Sr", "vs", "etc", "e.g", "i.e",
)


def java(pattern: str) -> str:
    """Portable pattern -> Java pattern (only \\n is a line terminator)."""
    return "(?d)" + pattern


def abbreviation_pattern(abbreviations: Sequence[str]) -> str:
    alts = "|".join(a.replace(".", r"\.") for a in abbreviations)
    return r"(^|[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}(])(" + alts + r")\."


def sentence_end_pattern(abbreviations: Sequence[str]) -> str:
    """Java-only one-pass form of (protect abbreviations, then SENT_END):
    a run may not start with a '.' that closes an abbreviation at a word
    start.  The bounded look-behind is only tried right after a '.'."""
    if not abbreviations:
        return SENT_END
    alts = "|".join(a.replace(".", r"\.") for a in abbreviations)
    ctx = r"(?:^|[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}(])(?:" + alts + r")\."
    return r"((?:\.(?<!" + ctx + r")|[!?])[.!?]*[\"'”’)\]]*)" + WS + r"+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(x: Column, fn) -> Column:
    """Evaluate ``x`` once and apply ``fn`` to it.  ``fn`` may use its
    argument several times (a guard and a rewrite) without copying the
    expression tree of ``x`` -- the value is bound to a lambda variable."""
    return F.get(F.transform(F.array(x), fn), 0)


def guarded(x: Column, needle: str, fn) -> Column:
    """``fn(x)`` only when ``x`` contains ``needle``: a byte search on the
    UTF-8 value skips the costly regex pass for text that cannot match."""
    return bind(x, lambda v: F.when(F.contains(v, F.lit(needle)), fn(v)).otherwise(v))


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (Spark's trim with an explicit character set; no regex)."""
    return F.trim(_col(c), F.lit(WS_CHARS))


def clean_text(c: Column | str) -> Column:
    """B2: drop ``Category:`` lines, ``|`` -> space, 2+ whitespace -> one
    space, strip.  A lone newline survives, as in the reference."""
    x = guarded(_col(c), "Category:", lambda v: F.regexp_replace(v, java(CATEGORY_LINE), ""))
    x = F.replace(x, F.lit(PIPE), F.lit(" "))
    x = F.regexp_replace(x, java(WS_RUN), " ")
    return strip_ws(x)


def mark_sentences(
    c: Column | str, abbreviations: Sequence[str] = DEFAULT_ABBREVIATIONS
) -> Column:
    """The stripped text with ``SENT_MARK`` in place of the whitespace
    between sentences: its non-empty pieces are the sentences."""
    return F.regexp_replace(strip_ws(c), java(sentence_end_pattern(abbreviations)), "$1" + SENT_MARK)


def marked_sentences(c: Column | str) -> Column:
    """What ``mark_sentences`` gives -> array<string> (non-empty pieces)."""
    return F.array_remove(F.split(_col(c), SENT_MARK), "")


def split_sentences(
    c: Column | str, abbreviations: Sequence[str] = DEFAULT_ABBREVIATIONS
) -> Column:
    """Rule-based sentence split -> array<string> (non-empty pieces).

    Split after a run of ``.!?`` (plus closing quotes/brackets) followed
    by whitespace, except after an abbreviation's dot.  One regex pass
    marks the split points, then a literal split."""
    return marked_sentences(mark_sentences(c, abbreviations))


def lead_sentences(
    c: Column | str, n: int = LEAD_SENTENCES, abbreviations: Sequence[str] = DEFAULT_ABBREVIATIONS
) -> Column:
    """The first ``n`` sentences joined by one space."""
    return F.array_join(F.slice(split_sentences(c, abbreviations), 1, n), " ")


def strip_prefix(c: Column | str, prefix: str = "Category:") -> Column:
    """``str.removeprefix``."""
    c = _col(c)
    return F.when(F.startswith(c, F.lit(prefix)), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def add_prefix(c: Column | str, prefix: str = "Category:") -> Column:
    return F.concat(F.lit(prefix), _col(c))


def normalise_topic(c: Column | str) -> Column:
    """Space spelling -> underscore spelling."""
    return F.translate(_col(c), " ", "_")


def encode_categories(arr: Column | str) -> Column:
    """Set -> comma string (sorted, distinct; the reference's set order is unspecified)."""
    return F.array_join(F.array_sort(F.array_distinct(_col(arr))), ",")


def decode_categories(c: Column | str) -> Column:
    """Comma string -> sorted distinct array."""
    return F.array_sort(F.array_distinct(F.split(_col(c), ",")))


def render_prompt(kind: str, title: Column | str | None = None,
                  summary: Column | str | None = None, text: Column | str | None = None) -> Column:
    """B12 prompt templates.

    ``classify``   lower("cat: {title}::{summary}")
    ``title``      "cat: {title}"  (not lowered)
    ``summarize``  "summarize: {text}"
    ``summary``    "summary: {text}"
    """
    if kind == "classify":
        return F.lower(F.concat(F.lit("cat: "), _col(title), F.lit("::"), _col(summary)))
    if kind == "title":
        return F.concat(F.lit("cat: "), _col(title))
    if kind == "summarize":
        return F.concat(F.lit("summarize: "), _col(text))
    if kind == "summary":
        return F.concat(F.lit("summary: "), _col(text))
    raise ValueError(f"unknown prompt kind {kind!r}")


def tokens(c: Column | str) -> Column:
    """Metric tokenizer: lower case, split on non-alphanumerics, drop empties."""
    return F.array_remove(F.split(F.lower(_col(c)), "[^a-z0-9]+"), "")


def words(c: Column | str) -> Column:
    """Whitespace word split (vocabulary / TF-IDF tokens), lower-cased."""
    return F.array_remove(F.split(F.lower(_col(c)), WS + "+"), "")
