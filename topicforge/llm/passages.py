"""Operator 2: substring deduplication by collinear chaining.

Finds passages that a document shares, exactly or with small changes, with a document before it (by doc_id).

1. Texts that are equal word by word are one class; all but its smallest doc_id repeat that one wholly.
2. Of every class's text, the k-mers of words that are the smallest (by hash) of some window are its seeds; so
   any two texts with a run of k + window - 1 words in common share a seed there.
3. Seeds are joined by k-mer: each occurrence is matched with the first one (smallest doc_id), and the second,
   third ... occurrence inside a document also with the first document that has so many, so that runs of one
   repeated phrase ascend in both texts.  That is at most two rows an occurrence, however many documents hold
   the k-mer.
4. The matches of a document with one source are chained: the best path of matches that ascend in both texts,
   each worth a point less the cost of the gap before it, found with a Fenwick tree of best scores by source
   position.  Chains are parted where a gap is long.
5. Chains are aligned: stretches between neighbouring matches are compared word by word, by least edits where
   their lengths differ, and both ends are extended, past words that differ too, while ``percent`` percent of
   the words added agree, however the extension is cut short, until the texts end or differ by as much as
   ``LONGEST_GAP`` words.  Passages of at least ``min_words`` words, of which ``percent`` percent agree, come out.
6. What the first occurrences leave: windows of ``min_words`` words that no passage so far holds, and whose
   seeds all stand in documents before, are matched as wholes with the first document that holds the window.
   Runs of such windows are passages too; so each run of ``min_words`` words that any document before holds,
   word by word, is covered (``min_words`` of ``K`` or more).

Defined results: null and empty texts, and texts under ``min_words``, have no passages; rows that repeat a
doc_id count as one document (the first text by digest); a null doc_id is left out; other columns are ignored;
repeats inside one document are no passages; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicforge.llm.batches import free_names, id_text, map_arrow, map_batches, record, slices, texts_of
from topicforge.llm.shingles import Words
from topicforge.session import reliable_checkpoint

K, WINDOW = 6, 12
MIN_WORDS, PERCENT = 50, 80
#: The cost of a gap, a word of it in either text; the longest gap inside a passage, in words.
GAP_COST, LONGEST_GAP = 0.01, 30
#: Words beside a chain that are fetched to extend it, at first; chains that go on there are fetched anew with
#: ``MORE`` times as many, until none does.
MARGIN, MORE = 64, 8
#: Up to so many rows a list of documents or spans is broadcast to the texts; beyond, texts are shuffled to it.
BROADCAST_ROWS = 1_000_000
#: A k-mer with so many rows, estimated from one row of ``HOT_PROBE``, is hot; at most the ``MOST_HOT`` hottest
#: are treated so, which bounds what is broadcast.
HOT_ROWS, HOT_PROBE, MOST_HOT = 100_000, 64, 100_000
#: Spans of one document that travel in one row.
SPANS = 64


def least_of_windows(hashes: np.ndarray) -> np.ndarray:
    """For each window the position of its smallest hash, the first among equals: the smaller of two shorter
    windows' that overlap or touch, from single hashes on."""
    at, least, span = np.arange(len(hashes)), hashes, 1
    while span < WINDOW:
        step = min(span, WINDOW - span)
        at = np.where(least[step:] < least[:-step], at[step:], at[:-step])
        least = np.minimum(least[step:], least[:-step])
        span += step
    return at


def seeds_of(hashes: np.ndarray) -> np.ndarray:
    """Positions of the k-mers that are the smallest of some window, the first among equals."""
    if len(hashes) <= WINDOW:
        return np.array([int(hashes.argmin())]) if len(hashes) else np.zeros(0, dtype=np.int64)
    at = least_of_windows(hashes)
    return at[np.concatenate([[True], at[1:] != at[:-1]])]  # they ascend


def ordinals(keys: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each key."""
    held = np.sort(keys)
    if not (held[1:] == held[:-1]).any():
        return np.zeros(len(keys), dtype=np.int32)
    order = np.argsort(keys, kind="stable")
    held = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(keys) else order
    out = np.empty(len(keys), dtype=np.int32)
    out[order] = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
    return out


def seed_table(rows: DataFrame) -> DataFrame:
    """(doc_id, n_words, s1, s2, pos array<int>, nth array<int>, kmer array<bigint>); nth counts the k-mer's
    seeds before this one in the text."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        n, digest, pos, nth, kmer = [], [], [], [], []
        for t in texts_of(b):
            w = Words(t)
            h = w.hashes(K)
            p = seeds_of(h)
            n.append(w.n)
            digest.append(np.frombuffer(xxhash.xxh3_128_digest(w.norm), dtype=np.int64))
            pos.append(p.astype(np.int32))
            nth.append(ordinals(h[p]))
            kmer.append(h[p].view(np.int64))
        d = np.array(digest).reshape(-1, 2)
        return record(doc_id=b.column(0), n_words=pa.array(n, pa.int64()), s1=pa.array(d[:, 0]), s2=pa.array(d[:, 1]),
                      pos=pa.array(pos, pa.list_(pa.int32())), nth=pa.array(nth, pa.list_(pa.int32())), kmer=pa.array(kmer, pa.list_(pa.int64())))

    return map_batches(rows, each, "doc_id bigint, n_words bigint, s1 bigint, s2 bigint, pos array<int>, nth array<int>, kmer array<bigint>")


def seed_matches(seeds: DataFrame) -> DataFrame:
    """(doc_id, source, pos, source_pos): each occurrence of a k-mer with the first of its k-mer and number."""
    return shared_seeds(seeds).where("source < doc_id").drop("nth")


def shared_seeds(seeds: DataFrame) -> DataFrame:
    """(doc_id, source, pos, source_pos, nth): the rows of ``seed_matches``, and as number 0 each occurrence of
    a k-mer that a later document holds too, whose source is then its own document.

    Most k-mers have few rows, and one exchange brings them together.  The first occurrence of those that
    have very many is found by an aggregate, which is combined before it is shuffled, and broadcast to
    the rows.  Which k-mers those are is estimated from a share of the rows: it moves work, not results."""
    every = (seeds.select("doc_id", F.explode(F.arrays_zip("kmer", "nth", "pos")).alias("s"))
             .select("doc_id", F.col("s.kmer").alias("kmer"), F.col("s.pos").alias("pos"),
                     F.explode(F.when(F.col("s.nth") == 0, F.array("s.nth")).otherwise(F.array("s.nth", F.lit(0)))).alias("nth")))
    probe = every.where(F.pmod(F.xxhash64("doc_id", "pos"), F.lit(HOT_PROBE)) == 0)
    hot = reliable_checkpoint(probe.groupBy("kmer", "nth").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT_ROWS // HOT_PROBE)
                              .orderBy(F.desc("n"), "kmer", "nth").limit(MOST_HOT).select("kmer", "nth"))
    ends = {"first": F.min(F.struct("doc_id", "pos")), "last": F.max("doc_id")}
    equal = {name: e.over(Window.partitionBy("kmer", "nth")) for name, e in ends.items()}
    if hot.isEmpty():
        common = every.withColumns(equal)
    else:
        firsts = reliable_checkpoint(every.join(F.broadcast(hot), ["kmer", "nth"]).groupBy("kmer", "nth").agg(*[e.alias(name) for name, e in ends.items()]))
        few = every.join(F.broadcast(hot), ["kmer", "nth"], "left_anti").withColumns(equal)
        common = few.unionByName(every.join(F.broadcast(firsts), ["kmer", "nth"]))
    return (common.where((F.col("first.doc_id") < F.col("doc_id")) | ((F.col("nth") == 0) & (F.col("last") > F.col("doc_id"))))
            .select("doc_id", F.col("first.doc_id").alias("source"), "pos", F.col("first.pos").alias("source_pos"), "nth"))


class Fenwick:
    """Largest values over prefixes of 0..n-1, with who holds them."""

    def __init__(self, n: int):
        self.n, self.value, self.who = n, [float("-inf")] * (n + 1), [-1] * (n + 1)

    def best(self, end: int) -> tuple[float, int]:
        """Over positions before ``end``."""
        v, w = float("-inf"), -1
        while end > 0:
            if self.value[end] > v:
                v, w = self.value[end], self.who[end]
            end &= end - 1
        return v, w

    def put(self, at: int, value: float, who: int) -> None:
        at += 1
        while at <= self.n:
            if value > self.value[at]:
                self.value[at], self.who[at] = value, who
            at += at & -at


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Collinear chains of matches (position, source position), which come in ascending position, of equal
    ones the largest source position first (so that no two of them follow each other in a chain); the best first, each match in one chain at most, parted at long gaps."""
    score, came = [], []
    if all(p < q and a < b for (p, a), (q, b) in zip(matches, matches[1:])):
        # Each match can follow the one before it, whose score without the gap's cost is the best so far by a point.
        v = float("-inf")
        for i, (p, a) in enumerate(matches):
            gain = v - GAP_COST * (p + a)
            score.append(1.0 + max(0.0, gain))
            came.append(i - 1 if gain > 0 else -1)
            v = score[i] + GAP_COST * (p + a)
    else:
        rank = {a: k for k, a in enumerate(sorted({a for _, a in matches}))}
        tree = Fenwick(len(rank))
        for i, (p, a) in enumerate(matches):
            v, j = tree.best(rank[a])
            gain = v - GAP_COST * (p + a)
            score.append(1.0 + max(0.0, gain))
            came.append(j if gain > 0 else -1)
            tree.put(rank[a], score[i] + GAP_COST * (p + a), i)
    used, out = [False] * len(matches), []
    for i in sorted(range(len(matches)), key=lambda i: (-score[i], i)):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(matches[i])
            i = came[i]
        path.reverse()
        part: list[tuple[int, int]] = []
        for m in path:
            if part and max(m[0] - part[-1][0], m[1] - part[-1][1]) > K + LONGEST_GAP:
                out.append(part)
                part = []
            part.append(m)
        if part:
            out.append(part)
    return out


def _least_edits(a: np.ndarray, b: np.ndarray) -> int:
    """Most words of two stretches that agree in an alignment (longest common subsequence)."""
    if len(a) > len(b):
        a, b = b, a
    # What agrees at both ends is in some best alignment.
    differ = np.flatnonzero(a != b[:len(a)])
    if not len(differ):
        return len(a)
    first = int(differ[0])
    a, b = a[first:], b[first:]
    end = len(a) - 1 - int(np.flatnonzero(a != b[len(b) - len(a):]).max(initial=-1))
    same = first + end
    a, b = a[:len(a) - end], b[:len(b) - end]
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return same + int(row[-1])


def extension(equal: np.ndarray, percent: int) -> tuple[int, int]:
    """How many words to go on, given which of them agree, and how many of those agree: the end of the best
    score, where an agreeing word gains 100 - ``percent`` and another loses ``percent``; the furthest of
    equal ones.  So the share of ``percent`` holds in the extension and in each end piece of it."""
    return _extended(equal, percent)[:2]


def last_word(equal: np.ndarray, percent: int) -> int | None:
    """The word at which an extension's score has fallen from its best by what ``LONGEST_GAP`` differing words
    lose; there it is given up, whatever follows.  None if that happens nowhere."""
    return _extended(equal, percent)[2]


def _extended(equal: np.ndarray, percent: int) -> tuple[int, int, int | None]:
    """What ``extension`` and ``last_word`` give, of one score."""
    if not len(equal):
        return 0, 0, None
    score = np.cumsum(np.where(equal, 100 - percent, -percent))
    fallen = np.maximum(np.maximum.accumulate(score), 0) - score > percent * LONGEST_GAP
    at = int(fallen.argmax())
    last = at if fallen[at] else None
    score = score[:last]
    if not len(score) or score.max() < 0:
        return 0, 0, last
    run = len(score) - int(score[::-1].argmax())
    return run, int(np.count_nonzero(equal[:run])), last


def align(path: list[tuple[int, int]], doc: np.ndarray, doc_at: int, source: np.ndarray, source_at: int,
          percent: int = PERCENT, more: bool = False) -> tuple[int, int, int, int, int, bool]:
    """(start, end, source start, source end, agreeing words, unfinished) of a chain.  ``doc`` and ``source``
    are word hashes from the positions ``doc_at`` and ``source_at`` on; with ``more`` both texts may go on
    after them.  Unfinished: an end was still being extended where the words given end."""
    x, y = path[0][0] - doc_at, path[0][1] - source_at
    back = min(x, y)
    before = doc[x - back:x][::-1] == source[y - back:y][::-1]
    run, agree, last = _extended(before, percent)
    unfinished = doc_at > 0 and source_at > 0 and last is None
    start, source_start = x - run, y - run
    for p, a in path:
        p, a = p - doc_at, a - source_at
        if p < x or a < y:  # the match overlaps what is aligned already, on another diagonal
            step = max(x - p, y - a)
            if step >= K:
                continue
            p, a = p + step, a + step
            size = K - step
        else:
            size = K
        if p > x or a > y:
            gap, other = doc[x:p], source[y:a]
            agree += int(np.count_nonzero(gap == other)) if len(gap) == len(other) else _least_edits(gap, other)
        agree += size
        x, y = p + size, a + size
    on = min(len(doc) - x, len(source) - y)
    after = doc[x:x + on] == source[y:y + on]
    run, added, last = _extended(after, percent)
    unfinished = unfinished or (more and last is None)
    return start + doc_at, x + run + doc_at, source_start + source_at, y + run + source_at, agree + added, unfinished


def _chain_table(matches: DataFrame) -> DataFrame:
    """Chains of two seeds or more: doc_id, source, path (positions and source positions)."""
    dealt = matches.repartition("doc_id", "source").sortWithinPartitions("doc_id", "source", "pos", F.desc("source_pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def shut() -> list[tuple]:
            return [(at[0], at[1], [p for p, _ in c], [a for _, a in c]) for c in chains(held) if len(c) > 1]

        def rows(out: list[tuple]) -> pa.RecordBatch:
            return record(doc_id=pa.array([r[0] for r in out], pa.int64()), source=pa.array([r[1] for r in out], pa.int64()),
                          pos=pa.array([r[2] for r in out], pa.list_(pa.int32())), source_pos=pa.array([r[3] for r in out], pa.list_(pa.int32())))

        for b in batches:
            if not b.num_rows:
                continue
            out = []
            doc, source, p, a = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            starts = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (source[1:] != source[:-1])) + 1])
            ends = np.append(starts[1:], len(doc))
            # Most pairs of documents have one match, which is no chain; the first and last may go on in other batches.
            many = ends - starts > 1
            many[[0, -1]] = True
            for lo, hi in zip(starts[many].tolist(), ends[many].tolist()):
                if (pair := (int(doc[lo]), int(source[lo]))) != at:
                    if len(held) > 1:
                        out += shut()
                    at, held = pair, []
                held += zip(p[lo:hi].tolist(), a[lo:hi].tolist())
            if out:
                yield rows(out)
        if len(held) > 1 and (out := shut()):
            yield rows(out)

    return map_arrow(dealt, run, "doc_id bigint, source bigint, pos array<int>, source_pos array<int>")


def _slices(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """(chain, role, at, words binary): the word hashes of each span (doc_id, chain, role, lo, hi).  A
    document's text is read once for up to ``SPANS`` of its spans."""
    # The first holder of a common passage has a span for each document that repeats it: dealt over parts.
    many = spans.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / SPANS).alias("parts")).where("parts > 1")
    part = F.coalesce(F.pmod(F.xxhash64("chain", "role"), F.col("parts")), F.lit(0)).alias("part")
    packed = reliable_checkpoint(spans.join(many, "doc_id", "left").select("doc_id", "chain", "role", "lo", "hi", part).groupBy("doc_id", "part")
                                 .agg(F.collect_list(F.struct("chain", "role", "lo", "hi")).alias("spans")).drop("part"))
    side = F.broadcast(packed) if spans.count() <= BROADCAST_ROWS else packed.hint("shuffle_hash")

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t, spans_ in zip(texts_of(b), b.column(2).to_pylist()):
            h = (Words(t).hashes(1) >> np.uint64(32)).astype(np.uint32)
            for s in spans_:
                lo = max(0, s["lo"])
                out.append((s["chain"], s["role"], lo, h[lo:s["hi"]].tobytes()))
        return record(chain=pa.array([r[0] for r in out], pa.int64()), role=pa.array([r[1] for r in out], pa.int32()),
                      at=pa.array([r[2] for r in out], pa.int32()), words=pa.array([r[3] for r in out], pa.binary()))

    return map_batches(rows.join(side, "doc_id").select("doc_id", "text", "spans"), each, "chain bigint, role int, at int, words binary")


def _aligned(found: DataFrame, rows: DataFrame, min_words: int, percent: int) -> DataFrame:
    """Passages of the chains ``found`` (chain, doc_id, source, pos, source_pos).  Each round fetches more words
    for the chains that were still being extended, as many rounds as the longest passage's length has digits."""
    margin, out = MARGIN, None
    while True:
        done = reliable_checkpoint(_aligned_within(found, rows, min_words, percent, margin))
        part = done.where("not unfinished").drop("chain", "unfinished")
        out = part if out is None else out.unionByName(part)
        left = done.where("unfinished").select("chain")
        if left.isEmpty():
            return out
        found, margin = reliable_checkpoint(found.join(left, "chain", "left_semi")), margin * MORE


def _aligned_within(found: DataFrame, rows: DataFrame, min_words: int, percent: int, margin: int) -> DataFrame:
    """Passages of the chains with ``margin`` words at both ends, and as ``unfinished`` the chains that need more."""
    span = lambda doc, p, role: found.select(
        F.col(doc).alias("doc_id"), "chain", F.lit(role).alias("role"), (F.element_at(p, 1) - margin).alias("lo"),
        (F.element_at(p, -1) + K + margin).alias("hi"))
    none = F.lit(None)
    parts = (_slices(rows, span("doc_id", "pos", 1).unionByName(span("source", "source_pos", 2)))
             .withColumns({"doc_id": none.cast("bigint"), "source": none.cast("bigint"), "pos": none.cast("array<int>"), "source_pos": none.cast("array<int>")}))
    head = found.select("chain", F.lit(0).alias("role"), none.cast("int").alias("at"), none.cast("binary").alias("words"), "doc_id", "source", "pos", "source_pos")
    dealt = head.unionByName(parts).select("chain", "role", "at", "words", "doc_id", "source", "pos", "source_pos").repartition("chain").sortWithinPartitions("chain", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        at = None
        for batch in batches:
            out = []
            for b in slices(batch):
                for chain, role, start, words, doc, source, p, a in zip(*(c.to_pylist() for c in b.columns)):
                    if chain != at:
                        at, held = chain, {}
                    held[role] = (start, words, doc, source, p, a)
                    if role == 2 and 0 in held and 1 in held:
                        _, _, d, s, dp, sp = held[0]
                        mine, theirs = np.frombuffer(held[1][1], dtype=np.uint32), np.frombuffer(words, dtype=np.uint32)
                        more = held[1][0] + len(mine) == dp[-1] + K + margin and start + len(theirs) == sp[-1] + K + margin
                        lo, hi, slo, shi, agree, unfinished = align(list(zip(dp, sp)), mine, held[1][0], theirs, start, percent, more)
                        if unfinished or hi - lo >= min_words and 100 * agree >= percent * max(hi - lo, shi - slo):
                            out.append((d, lo, hi, s, slo, shi, agree, chain, unfinished))
            kinds = ("doc_id", "start_word", "end_word", "source_doc_id", "source_start", "source_end", "n_equal", "chain", "unfinished")
            yield record(**{k: pa.array([r[i] for r in out], pa.bool_() if k == "unfinished" else pa.int64()) for i, k in enumerate(kinds)})

    return map_arrow(dealt, run, PASSAGE + ", chain bigint, unfinished boolean")


def _with_first(asked: DataFrame, held: DataFrame, *places: str) -> DataFrame:
    """The rows ``asked`` (doc_id, key, ...) with ``first``: doc_id and ``places`` of the first of ``held`` that
    has their key.  It is found by an aggregate, which is combined before it is shuffled."""
    keys = reliable_checkpoint(asked.groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    few = keys.count() <= BROADCAST_ROWS // 4
    if few:
        held = held.join(F.broadcast(keys.select("key")), "key", "left_semi")
    firsts = reliable_checkpoint(held.groupBy("key").agg(F.min(F.struct("doc_id", *places)).alias("first")).join(keys, "key"))
    if few:
        return asked.join(F.broadcast(firsts), "key")
    hot = reliable_checkpoint(firsts.where(F.col("n") >= HOT_ROWS))
    return (asked.join(F.broadcast(hot), "key")
            .unionByName(asked.join(F.broadcast(hot.select("key")), "key", "left_anti").join(firsts.where(F.col("n") < HOT_ROWS), "key")))


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Starts and ends of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def whole_windows(pos: np.ndarray, kmer: np.ndarray, n_words: int, known: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words whether all seeds that it has by itself, whatever stands beside it,
    are at ``known`` positions."""
    reach = size - (K + WINDOW - 1) + 1
    if reach < 1:
        return np.ones(n_words - size + 1, dtype=bool)
    hashes = np.full(n_words - K + 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    hashes[pos] = kmer.view(np.uint64)
    held = np.zeros(len(hashes), dtype=bool)
    held[known] = True
    missing = np.concatenate([[0], np.cumsum(~held[least_of_windows(hashes)])])
    return missing[reach:] == missing[:-reach]


def _open_windows(reps: DataFrame, shared: DataFrame, passages: DataFrame, size: int) -> DataFrame:
    """(doc_id, s1, s2, repeats, lo, hi): the first words lo to hi - 1 of windows whose seeds all stand in other
    documents too; with ``repeats`` of those whose seeds stand in documents before and that no passage holds."""
    known = shared.where("nth = 0").groupBy("doc_id").agg(
        F.collect_list("pos").alias("shared"), F.collect_list(F.when(F.col("source") < F.col("doc_id"), F.col("pos"))).alias("before"))
    spans = passages.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))
    joined = (reps.join(known, "doc_id", "inner" if size >= K + WINDOW - 1 else "left").join(spans, "doc_id", "left")
              .select("doc_id", "s1", "s2", "n_words", "pos", "kmer", "shared", "before", "spans"))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc, s1, s2, n, pos, kmer, both, before, spans_ in zip(*(c.to_pylist() for c in b.columns)):
            at, key = np.array(pos, dtype=np.int64), np.array(kmer, dtype=np.int64)
            held = whole_windows(at, key, n, np.array(both or [], dtype=np.int64), size)
            asked = whole_windows(at, key, n, np.array(before or [], dtype=np.int64), size)
            for s in spans_ or ():
                asked[s["start_word"]:max(s["start_word"], s["end_word"] - size + 1)] = False
            out += [(doc, s1, s2, kind, lo, hi) for kind, flags in ((False, held), (True, asked)) for lo, hi in _runs(flags)]
        kinds = ("doc_id", "s1", "s2", "repeats", "lo", "hi")
        types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())
        return record(**{k: pa.array([r[i] for r in out], t) for i, (k, t) in enumerate(zip(kinds, types))})

    return map_batches(joined, each, "doc_id bigint, s1 bigint, s2 bigint, repeats boolean, lo int, hi int")


def _window_keys(rows: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    """(doc_id, pos, key): the hash of each window of ``size`` words that starts in a span (doc_id, s1, s2, lo, hi)."""
    packed = spans.groupBy("doc_id", "s1", "s2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    side = F.broadcast(packed) if spans.count() <= BROADCAST_ROWS else packed.hint("shuffle_hash")

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        doc, pos, key = [], [], []
        for d, t, s1, s2, spans_ in zip(b.column(0).to_pylist(), texts_of(b), *(b.column(k).to_pylist() for k in (2, 3, 4))):
            w = Words(t)
            if np.frombuffer(xxhash.xxh3_128_digest(w.norm), dtype=np.int64).tolist() != [s1, s2]:
                continue  # another text under the same doc_id
            h = w.hashes(size)
            at = np.concatenate([np.arange(s["lo"], s["hi"], dtype=np.int32) for s in spans_])
            doc.append(np.full(len(at), d, dtype=np.int64))
            pos.append(at)
            key.append(h[at].view(np.int64))
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=kind))
        return record(doc_id=join(doc, np.int64), pos=join(pos, np.int32), key=join(key, np.int64))

    return map_batches(rows.join(side, "doc_id").select("doc_id", "text", "s1", "s2", "spans"), each, "doc_id bigint, pos int, key bigint")


def cover(places: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """Fewest runs (start, end, source start) that cover the same words as the windows (position, source
    position), which come in ascending position."""
    open_: dict[int, list[int]] = {}
    runs = []
    for p, a in places:
        run = open_.get(a - p)
        if run is None or p > run[1]:
            run = open_[a - p] = [p, p, a]
            runs.append(run)
        run[1] = p + size
    runs.sort(key=lambda r: (r[0], -r[1]))
    out, end, i = [], -1, 0
    while i < len(runs):
        reach, best = max(end, runs[i][0]), runs[i]
        while i < len(runs) and runs[i][0] <= reach:
            best = max(best, runs[i], key=lambda r: r[1])
            i += 1
        if best[1] > end:
            out.append(tuple(best))
            end = best[1]
    return out


def _exact_runs(rows: DataFrame, reps: DataFrame, shared: DataFrame, passages: DataFrame, size: int) -> DataFrame | None:
    """Chains (doc_id, source, pos, source_pos) of windows of ``size`` words that a document before holds as
    wholes and no passage does; none if there are no such windows."""
    spans = reliable_checkpoint(_open_windows(reps, shared, passages, size))
    if spans.where("repeats").isEmpty():
        return None
    asked = reliable_checkpoint(_window_keys(rows, spans.where("repeats"), size))
    both = _with_first(asked, _window_keys(rows, spans.where("not repeats"), size), "pos")
    places = (both.where(F.col("first.doc_id") < F.col("doc_id"))
              .select("doc_id", F.col("first.doc_id").alias("source"), "pos", F.col("first.pos").alias("source_pos"))
              .repartition("doc_id", "source").sortWithinPartitions("doc_id", "source", "pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def shut() -> list[tuple]:
            return [(at[0], at[1], [lo, hi - K], [a, a + hi - lo - K]) for lo, hi, a in cover(held, size)]

        def rows(out: list[tuple]) -> pa.RecordBatch:
            return record(doc_id=pa.array([r[0] for r in out], pa.int64()), source=pa.array([r[1] for r in out], pa.int64()),
                          pos=pa.array([r[2] for r in out], pa.list_(pa.int32())), source_pos=pa.array([r[3] for r in out], pa.list_(pa.int32())))

        for b in batches:
            out = []
            for doc, source, p, a in zip(*(c.to_pylist() for c in b.columns)):
                if (doc, source) != at:
                    if held:
                        out += shut()
                    at, held = (doc, source), []
                held.append((p, a))
            if out:
                yield rows(out)
        if held:
            yield rows(shut())

    return map_arrow(places, run, "doc_id bigint, source bigint, pos array<int>, source_pos array<int>")


PASSAGE = "doc_id bigint, start_word bigint, end_word bigint, source_doc_id bigint, source_start bigint, source_end bigint, n_equal bigint"


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row for each passage that a document repeats from one before it: doc_id, start_word, end_word
    (exclusive), source_doc_id, source_start, source_end, n_equal (words that agree)."""
    rows = id_text(docs, id_col, text_col).where("doc_id is not null")
    seeds = reliable_checkpoint(seed_table(rows).where(F.col("n_words") >= min_words))
    one = seeds.groupBy("doc_id").agg(F.min(F.struct("s1", "s2", "n_words")).alias("t")).select("doc_id", "t.*")
    classes = one.groupBy("s1", "s2", "n_words").agg(F.min("doc_id").alias("rep"))
    copies = (one.join(classes, ["s1", "s2", "n_words"]).where("doc_id <> rep")
              .select("doc_id", F.lit(0).cast("bigint").alias("start_word"), F.col("n_words").alias("end_word"), F.col("rep").alias("source_doc_id"),
                      F.lit(0).cast("bigint").alias("source_start"), F.col("n_words").alias("source_end"), F.col("n_words").alias("n_equal")))
    reps = seeds.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "s1", "s2", "n_words"]).dropDuplicates(["doc_id"])
    reps = reliable_checkpoint(reps.select("doc_id", "s1", "s2", "n_words", "pos", "nth", "kmer"))
    shared = reliable_checkpoint(shared_seeds(reps))

    def numbered(chained: DataFrame) -> DataFrame:
        # A chain's number is drawn from what it is, so that a repeated task draws the same.
        return reliable_checkpoint(chained.select(F.xxhash64("doc_id", "source", "pos", "source_pos").alias("chain"), "doc_id", "source", "pos", "source_pos"))

    found = numbered(_chain_table(shared.where("source < doc_id").drop("nth")))
    near = _aligned(found, rows, min_words, percent)
    exact = _exact_runs(rows, reps, shared, near, min_words) if min_words >= K else None
    if exact is not None:
        near = near.unionByName(_aligned(numbered(exact), rows, min_words, percent))
    return copies.unionByName(near)


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size_col: str | None = None) -> DataFrame:
    """``docs`` without the words of the passages; the other columns stay, ``size_col`` gets the new length in
    characters.  A document of which nothing is left is dropped; one that has no passage is not touched."""
    doc_name, spans_name = free_names(docs, "__doc", "__spans")
    spans = reliable_checkpoint(passages.select(F.col("doc_id").alias(doc_name), "start_word", "end_word").distinct()
                                .groupBy(doc_name).agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias(spans_name)))
    side = F.broadcast(spans) if spans.count() <= BROADCAST_ROWS else spans.hint("shuffle_hash")
    joined = docs.join(side, docs[id_col].cast("bigint") == F.col(doc_name), "left").drop(doc_name)
    untouched = joined.where(F.col(spans_name).isNull()).drop(spans_name)
    hit = joined.where(F.col(spans_name).isNotNull())
    schema, text_at = docs.schema, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, keep = [], []
            for t, spans_ in zip(b.column(text_at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                new = cut_words(t or "", [(s["start_word"], s["end_word"]) for s in spans_])
                keep.append(bool(new))
                texts.append(new)
            cols = [pa.array(texts, b.schema.field(k).type) if k == text_at else b.column(k) for k in range(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1]).filter(pa.array(keep, pa.bool_()))

    cut = map_arrow(hit, run, schema)
    if size_col:
        cut = cut.withColumn(size_col, F.length(text_col).cast(schema[size_col].dataType))
    return untouched.unionByName(cut)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans (ascending by start), each with the white space after it."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, done = [], 0
    for lo, hi in spans:
        lo, hi = at[min(lo, len(at) - 1)], at[min(hi, len(at) - 1)]
        if hi <= done:
            continue
        out.append(text[done:max(lo, done)])
        done = hi
    out.append(text[done:])
    return "".join(out).strip(" \t\n\r\x0b\x0c")
