"""DuckDB SQL for the oracle side of ``__spark_entry__.oracle_sql``.

The SQL re-derives each operator's input from the pre-registered driver
views and then computes the operator in plain SQL.  Regex patterns are
the library's own constants (written in the portable subset), so the
two engines are checked on the same rules; only the replacement syntax
differs (``$1`` in Java, ``\\1`` in RE2).
"""

from __future__ import annotations

import re

from topicforge.functions import html as H
from topicforge.functions import text as T
from topicforge.functions import wikitext as W
from topicforge.taxonomy import INTENTS, TOPICS, topics_spaced


def q(s: str) -> str:
    """SQL string literal (DuckDB strings are raw apart from doubled quotes)."""
    return "'" + s.replace("'", "''") + "'"


def lit(s: str) -> str:
    """A string literal that may hold control characters."""
    out, buf = [], ""
    for ch in s:
        if ord(ch) < 32 and ch not in "\t":
            if buf:
                out.append(q(buf))
                buf = ""
            out.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not out:
        out.append(q(buf))
    return " || ".join(out)


def repl(r: str) -> str:
    """Java replacement ($1) -> RE2 replacement (\\1)."""
    return lit(re.sub(r"\$(\d)", r"\\\1", r))


def rx(expr: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {repl(replacement)}, 'g')"


def str_list(names) -> str:
    return "[" + ", ".join(q(n) for n in names) + "]"


TOPIC_LIST = str_list(TOPICS)
SPACED_LIST = str_list(topics_spaced())


def strip_ws(x: str) -> str:
    return rx(x, T.TRIM, "")


def clean_text(x: str) -> str:
    x = rx(x, T.CATEGORY_LINE, "")
    x = rx(x, r"\|", " ")
    x = rx(x, T.WS_RUN, " ")
    return strip_ws(x)


def split_sentences(x: str) -> str:
    x = strip_ws(x)
    x = rx(x, T.abbreviation_pattern(T.DEFAULT_ABBREVIATIONS), "$1$2" + T.ABBR_MARK)
    x = rx(x, T.SENT_END, "$1" + T.SENT_MARK)
    parts = f"list_filter(string_split({x}, chr(1)), lambda s: s <> '')"
    return f"list_transform({parts}, lambda s: replace(s, chr(2), '.'))"


def lead(x: str, n: int) -> str:
    return f"array_to_string(list_slice({split_sentences(x)}, 1, {n}), ' ')"


def lead_nl(x: str, n: int) -> str:
    return f"array_to_string(list_slice({split_sentences(x)}, 1, {n}), chr(10))"


# The references that the inputs hold, written out here and not taken from the library.
REFERENCES = (
    ("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&ndash;", "\u2013"), ("&mdash;", "\u2014"),
    ("&eacute;", "\u00e9"), ("&rsquo;", "\u2019"), ("&hellip;", "\u2026"), ("&#8217;", "\u2019"),
    ("&#x27;", "'"), ("&amp;", "&"),
)


def decode_references(x: str) -> str:
    for ref, ch in REFERENCES:
        x = f"replace({x}, {q(ref)}, {q(ch)})"
    return x


def strip_markup(x: str) -> str:
    """Of text without templates and tables that nest."""
    for _, pattern, replacement in (*W.RULES_BEFORE, *W.RULES_AFTER):
        x = rx(x, pattern, replacement)
    return decode_references(x)


def clean_category(c: str) -> str:
    return rx(f"replace(replace({c}, '|', ''), ',', '')", T.TRIM, "")


def extract_clean_categories(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, {q(W.CATEGORY_LINK)}, 1), lambda c: {clean_category('c')})"


def keep(listexpr: str, names: str = SPACED_LIST) -> str:
    return f"list_filter({listexpr}, lambda c: list_contains({names}, c))"


def spaced_topic(idx: str) -> str:
    return f"{SPACED_LIST}[(({idx}) % 40) + 1]"


def category_lines(d: str) -> str:
    def link(name: str) -> str:
        return f"(chr(10) || '[[Category:' || {name} || ']]')"

    return (
        f"(CASE WHEN {d} % 6 <> 0 THEN {link(spaced_topic(f'{d}*7'))} ELSE '' END"
        f" || CASE WHEN {d} % 4 = 1 THEN {link(spaced_topic(f'{d}*7+1') + ' || ' + q('|Key'))} ELSE '' END"
        f" || {link(q('Topic ') + f' || CAST({d} % 17 AS VARCHAR)')}"
        f" || CASE WHEN {d} % 4 = 2 THEN {link(spaced_topic(f'{d}*7+3'))} ELSE '' END"
        f" || CASE WHEN {d} % 10 = 3 THEN {link(spaced_topic(f'{d}*3') + ' || ' + q(','))} ELSE '' END)"
    )


def first_words(x: str, n: int = 5) -> str:
    return (f"array_to_string(list_slice(list_filter(regexp_split_to_array({x}, {q(T.WS + '+')}),"
            f" lambda w: w <> ''), 1, {n}), ' ')")


def stored_summary(key: str, text: str) -> str:
    return (f"(CASE WHEN {key} % 3 = 0 THEN NULL WHEN {key} % 6 = 1 THEN '' "
            f"ELSE {lead(text, 1)} END)")


WIKI_PAGES = f"""wiki AS (
  SELECT doc_id AS page_id, {first_words('text')} AS title,
         text || {category_lines('doc_id')} AS text
  FROM documents)"""

# The stand-in of ``strip_markup``, its nested templates and tables left out by construction.
MARKED = f"""marked AS (
  SELECT page_id, text || chr(10) || {q("''Caf&eacute;'' ")}
         || CASE WHEN page_id % 9 > 0 THEN {q("it&rsquo;s [[A|b]] ")} ELSE {q("&#8217;&#x27;&hellip;")} END
         || {q(" <ref name=n>note</ref>[[File:f.png|thumb|a [[b]] c]]&amp;lt; end")} AS text FROM wiki)"""

DOC_PAGES = f"""docp AS (
  SELECT doc_id AS page_id, {first_words('text')} AS title,
         {stored_summary('doc_id', 'text')} AS summary, text
  FROM documents)"""

PAGE_CONTENT = f"""pc AS (
  SELECT p_partkey AS page_id, p_name AS title,
         {stored_summary('p_partkey', 'coalesce(d.text, p_name)')} AS summary,
         coalesce(d.text, p_name) AS text
  FROM part LEFT JOIN documents d ON d.doc_id = p_partkey)"""

GRAPH = """edges AS (
  SELECT 'R' || CAST(n_regionkey AS VARCHAR) AS parent, 'N' || CAST(n_nationkey AS VARCHAR) AS child FROM nation
  UNION ALL SELECT 'N' || CAST(s_nationkey AS VARCHAR), 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier
  UNION ALL SELECT 'N1', 'R1'),
roots AS (SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS root FROM region),
cpages AS (SELECT DISTINCT 'S' || CAST(l_suppkey AS VARCHAR) AS category, l_partkey AS page_id
           FROM lineitem)"""


def closure(max_depth: int = 10) -> str:
    return f"""walk(root, category, depth) AS (
  SELECT root, root, 0 FROM roots
  UNION
  SELECT w.root, e.child, w.depth + 1 FROM walk w JOIN edges e ON e.parent = w.category
  WHERE w.depth < {max_depth}),
clos AS (SELECT root, category, min(depth) AS depth FROM walk GROUP BY root, category)"""


def hits(limit: int) -> str:
    return f"""cand AS (
  SELECT c.root, p.page_id, min(c.depth) AS depth
  FROM clos c JOIN cpages p ON p.category = c.category GROUP BY c.root, p.page_id),
quota AS (
  SELECT root, page_id, depth FROM cand
  QUALIFY row_number() OVER (PARTITION BY root ORDER BY depth, page_id) <= {limit})"""


LOGITS = """sc AS (
  SELECT vec_id AS id, vec_id AS ordinal,
         CAST(embedding[1:40] AS DOUBLE[]) AS logits,
         CAST(embedding[25:64] AS DOUBLE[]) AS student,
         CASE WHEN vec_id % 5 = 0 THEN [{T}[label + 1], {T}[label + 11]] ELSE [{T}[label + 1]] END AS categories
  FROM embeddings)""".replace("{T}", TOPIC_LIST)


def html_title(x: str) -> str:
    t = decode_references(f"regexp_extract({x}, {q(H.TITLE)}, 1)")
    return f"(CASE WHEN {t} = '' THEN {q(H.NO_TITLE)} ELSE {t} END)"


def html_paragraph_list(x: str) -> str:
    body = rx(x, H.NOISE, "")
    pieces = f"list_slice(regexp_split_to_array({body}, {q(H.P_OPEN)}), 2, 1073741824)"
    inner = decode_references(rx(rx("p", H.BLOCK_END, ""), H.TAG, ""))
    return f"list_transform({pieces}, lambda p: {inner})"


def html_paragraphs(x: str) -> str:
    return f"array_to_string({html_paragraph_list(x)}, ' ')"


INTENT_ROWS = ", ".join(
    f"({rank}, {q(intent)}, {q(topic)})" for rank, (intent, topics) in enumerate(INTENTS) for topic in topics
)
INTENT_CTE = f"intent_map(intent_rank, intent, topic) AS (VALUES {INTENT_ROWS})"
