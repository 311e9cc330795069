"""Operator 6: token counts with a whole-token shortcut.

Before any text is read, every vocabulary string is run through the merges by itself; those that come out
as one token are proven whole.  A pre-token (piece of text that merges cannot leave) equal to a proven
string counts one without any work; only the rest is merged, once for each different piece that a worker
remembers.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows each give a row; other
columns are ignored; a text of any length is counted whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.batches import id_text, map_batches, per_task, record, texts_of
from topicforge.llm.pretokens import Memo, Vocabulary, splitter, vocabulary


#: Symbols of a piece up to which the lowest rank is looked for among all neighbours, which is quicker there.
SHORT = 40
_NONE = (1 << 62, -1)


def merge(vocab: Vocabulary, spelled: str) -> list[int]:
    """Merge the symbols of one piece: lowest rank first, further left first among equals."""
    if len(spelled) > SHORT:
        return _merge_long(vocab, spelled)
    ids, of = list(map(vocab.ids.__getitem__, spelled)), vocab.merges.get
    best = [of(p, _NONE) for p in zip(ids, ids[1:])]
    while best and (low := min(best)) is not _NONE:
        i = best.index(low)
        ids[i:i + 2] = low[1:]
        del best[i]
        if i:
            best[i - 1] = of((ids[i - 1], ids[i]), _NONE)
        if i < len(best):
            best[i] = of((ids[i], ids[i + 1]), _NONE)
    return ids


def _merge_long(vocab: Vocabulary, spelled: str) -> list[int]:
    """The same by a heap of neighbouring pairs and a linked list, so a piece of n symbols takes n log n steps."""
    ids = [vocab.ids[c] for c in spelled]
    n, pairs = len(ids), vocab.merges
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(pairs[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
    heapq.heapify(heap)
    while heap:
        _, i, p = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or (ids[i], ids[j]) != p:
            continue  # one of the two has been merged meanwhile
        ids[i], alive[j], after[i] = pairs[p][1], False, after[j]
        if after[i] < n:
            before[after[i]] = i
        for left in (before[i], i):
            right = after[left] if left >= 0 else n
            if right < n and (q := (ids[left], ids[right])) in pairs:
                heapq.heappush(heap, (pairs[q][0], left, q))
    return [x for x, a in zip(ids, alive) if a]


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings that, as a piece of their own, encode as exactly one token.  Strings that
    are not UTF-8 by themselves cannot be a piece.  Bounded by the vocabulary."""
    v, proven = vocabulary(path), []
    for i, spelled in v.symbols.items():
        try:
            piece = bytes(ord(c) % 256 for c in spelled).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if v.spell(piece) == spelled and merge(v, spelled) == [i]:
            proven.append(piece)
    return proven


@lru_cache(maxsize=2)
def counter(path: str, proven: tuple[str, ...]) -> Callable[[str], int]:
    """A function from a text to its number of tokens.  What a piece counts is remembered, within bounds."""
    v, split = vocabulary(path), splitter(path)
    whole = frozenset(proven) | frozenset(v.special)
    merged = Memo(lambda piece: len(merge(v, v.spell(piece))), most=200_000).__getitem__
    return lambda text: sum([1 if p in whole else merged(p) for p in split(text)])


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``) for every row.  Map-only; the
    proven strings (at most the vocabulary) are broadcast."""
    proven = docs.sparkSession.sparkContext.broadcast(tuple(whole_tokens(tokenizer_path)))

    @per_task
    def start():
        count = counter(tokenizer_path, proven.value)

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            n = list(map(count, texts_of(b)))
            return record(doc_id=b.column(0), n_bytes=b.column(1), n_tokens=pa.array(n, pa.int64()))

        return each

    rows = id_text(docs, id_col, text_col).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    counted = map_batches(rows, start, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
