"""Wiki markup scalars.

``strip_markup`` is a documented subset of a wiki-markup renderer built
from ordered ``regexp_replace`` passes and the nesting rules of
``references.py``.  Each rule is (pattern,
replacement) in the portable regex subset described in ``text.py``;
replacements use ``$1`` group references.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicforge.functions.references import decode_references, remove_nested
from topicforge.functions.text import guarded, java, strip_ws

# --- fixed values (must equal the reference's for the same categories) ---
# Category link target: non-greedy, case-sensitive, not across lines.
CATEGORY_LINK = r"\[\[Category:(.*?)\]\]"
# Characters deleted from a category name before it is stripped.
CATEGORY_DELETE = "|,"
# --- end of fixed values ---


# Ordered (needle, pattern, replacement) passes.  A pass runs only on text containing its needle (a literal
# substring every match must contain).  Templates and tables, which nest, go between the two groups.
RULES_BEFORE = (
    ("<!--", r"(?s)<!--.*?-->", ""),                                  # comments
    ("<", r"(?is)<ref[^>]*/>", ""),                                   # self-closed refs
    ("<", r"(?is)<ref[^>]*>.*?</ref>", ""),                           # refs with body
)
RULES_AFTER = (
    # links of the File and Image kinds go with their caption, which is no part of the running text
    ("[[", r"(?i)\[\[(?:File|Image):[^\[\]]*(?:\[\[[^\[\]]*\]\][^\[\]]*)*\]\]", ""),
    ("[[", r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", "$1"),                 # [[a|b]] -> b
    ("[[", r"\[\[([^\[\]|]*)\]\]", "$1"),                             # [[a]] -> a
    ("//", r"\[(?:https?:)?//[^\s\]]+\s+([^\]]*)\]", "$1"),           # [url text] -> text
    ("//", r"\[(?:https?:)?//[^\s\]]+\]", ""),                        # [url] -> ''
    ("''", r"'{2,5}", ""),                                          # bold / italic
    ("=", r"(?m)^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", "$1"),               # headings
    ("<", r"<[^>]+>", ""),                                          # remaining tags
)


def strip_markup(c: Column | str) -> Column:
    """B1: wiki markup -> plain text: comments and notes, templates and tables of any depth, links, styles,
    headings and tags, then the character references."""
    def passes(x: Column, rules) -> Column:
        for needle, pattern, repl in rules:
            x = guarded(x, needle, lambda v, p=pattern, r=repl: F.regexp_replace(v, java(p), r))
        return x

    x = passes(F.col(c) if isinstance(c, str) else c, RULES_BEFORE)
    return decode_references(passes(remove_nested(x), RULES_AFTER))


def extract_categories(c: Column | str) -> Column:
    """Every ``[[Category:...]]`` target in order, repeats kept."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(x, F.lit(java(CATEGORY_LINK)), 1)


def clean_category(c: Column, drop_sort_key: bool = False) -> Column:
    """B4 on one element: delete ``|`` and ``,`` then strip.

    The reference keeps a sort key glued on (``Law|key`` -> ``Lawkey``);
    ``drop_sort_key=True`` cuts at the first ``|`` instead.
    """
    if drop_sort_key:
        c = F.substring_index(c, "|", 1)
    return strip_ws(F.translate(c, CATEGORY_DELETE, ""))


def clean_categories(arr: Column | str, drop_sort_key: bool = False) -> Column:
    """B4 over an array column."""
    x = F.col(arr) if isinstance(arr, str) else arr
    return F.transform(x, lambda c: clean_category(c, drop_sort_key))
