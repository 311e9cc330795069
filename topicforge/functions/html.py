"""HTML scalars (B14, B15) as native regex expressions.

The rules are a documented subset of an HTML parser: the page title, and
the text of every ``<p>`` in document order.  An unclosed ``<p>`` ends at
the next ``<p>`` or closing block tag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicforge.constants import WEB_LEAD_SENTENCES
from topicforge.functions.references import decode_references
from topicforge.functions.text import java, lead_sentences, strip_ws

# --- fixed values (must equal the reference's) ---
NO_TITLE = "No title found"
# --- end of fixed values ---

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
# Removed before paragraphs are cut out: scripts, styles, comments.
NOISE = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
P_OPEN = r"(?i)<p(?:[\t\n\f\r ][^>]*)?>"
BLOCK_END = (
    r"(?is)</(?:p|div|article|section|body|html|main|header|footer|nav|aside|"
    r"ul|ol|li|table|tr|td|th|h[1-6]|blockquote|form)[\t\n\f\r ]*>.*"
)
TAG = r"<[^>]*>"


def html_title(c: Column | str) -> Column:
    """Decoded ``<title>`` text, or ``No title found``."""
    x = F.col(c) if isinstance(c, str) else c
    t = decode_references(F.regexp_extract(x, java(TITLE), 1))
    return F.when(t == F.lit(""), F.lit(NO_TITLE)).otherwise(t)


PIECE = "\x01"
# The same cut and tag rules confined to one piece of the marker-joined text.
BLOCK_END_PIECE = BLOCK_END[:-2] + "[^\x01]*"
TAG_PIECE = r"<[^>\x01]*>"


def html_paragraphs(c: Column | str) -> Column:
    """Paragraph texts joined by one space.

    Computed without a per-paragraph lambda: the pieces after each ``<p>``
    are joined with a marker (deleted from the input first), the cut-at-block-end and tag rules run once over
    the joined text (confined to one piece by the marker), and the markers
    become spaces."""
    x = F.col(c) if isinstance(c, str) else c
    body = F.regexp_replace(F.translate(x, PIECE, ""), java(NOISE), "")
    pieces = F.array_join(F.slice(F.split(body, java(P_OPEN)), 2, 1 << 30), PIECE)
    cut = F.regexp_replace(F.regexp_replace(pieces, java(BLOCK_END_PIECE), ""), TAG_PIECE, "")
    return decode_references(F.replace(cut, F.lit(PIECE), F.lit(" ")))


def page_summary_from_html(c: Column | str, n: int = WEB_LEAD_SENTENCES) -> Column:
    """B16 summary part: first ``n`` sentences of the paragraphs, stripped."""
    return strip_ws(lead_sentences(html_paragraphs(c), n))
