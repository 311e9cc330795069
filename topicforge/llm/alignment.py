"""Operator 13: alignment of two tokenizers by an associative monoid of fragments.

Both tokenizers encode the bytes of a space and the text.  Where tokens of both end at one byte offset, the
tokens before are cut into a group.  The alignment of a byte range is a fragment: an open head (tokens up to
its first common end, which may have begun in the range before), closed groups, and an open tail (tokens
after its last common end); without a common end all of it is head.  Fragments compose: the open tail of
the left and the open head of the right are aligned anew, which closes the groups that cross the border.
Composition is associative, so the ranges of a very long text are encoded in different tasks and their
fragments composed as a tree, ``FAN`` at a time; closed groups stay where they are, as rows with their
place, and only open ends travel up.

The two tokenizers are cut at different places, each where none of its own tokens goes on: the byte-level
one before white space that follows other characters, the piece model before a space that follows another
character.  Where both may be cut, before a space between two words, fragments are closed on both sides;
such units are remembered, within bounds, and texts of usual length are the sum of their units.

Defined results: texts null, empty, or whose joined token bytes of either tokenizer differ from the space
and the text, have no tokens: zeros and ''.  Repeated rows each give their own row and count each in the
corpus counts; special strings inside texts are plain text; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb
from tokenizers import Tokenizer

from topicforge.llm import ordered_hash
from topicforge.llm.batches import id_text, map_arrow, map_batches, per_task, record, texts_of
from topicforge.llm.byte_bpe import GAP, raw_bytes, units
from topicforge.llm.pretokens import BYTE_PIECES, Memo
from topicforge.session import reliable_checkpoint

#: Characters of a range of a long text (shorter texts are one range), and fragments composed in one step.
CHUNK, FAN = 1 << 16, 16
#: Bytes of text that a worker aligns at a time: as Python objects their tokens take some fifty times as much.
SLICE = 1 << 19
#: Rows of the table of linked pairs up to which it is broadcast, as 20 bytes a row; beyond it is joined.
PAIRS = 4_000_000
_NONE = np.zeros(0, dtype=np.int32)


class Spec(NamedTuple):
    """What both encoders need, read once from their files: small, bounded by the vocabularies."""

    json_text: str
    ranks: dict[bytes, int] | None  # set if merging by ranks gives what the file's merges give
    model: bytes
    cut_b: bool


def read_spec(json_path: str, model_path: str) -> Spec:
    with open(json_path, encoding="utf-8") as f:
        text = f.read()
    spec = json.loads(text)
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = {raw_bytes(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
    at = [vocab[raw_bytes(a + b)] for a, b in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])]
    ordered = at == sorted(set(at)) and len(at) + 256 == len(vocab) and all(bytes([b]) in vocab for b in range(256))
    if ordered:  # and every entry that can be a piece of text by itself is one token
        whole = []
        for raw, i in vocab.items():
            try:
                whole.append((raw.decode("utf-8"), i))
            except UnicodeDecodeError:
                continue
        library = _library(text)
        alone = library.encode_batch([s for s, _ in whole], add_special_tokens=False)
        ordered = not any(e.ids != [i] and len(library.pre_tokenizer.pre_tokenize_str(s)) == 1 for e, (s, i) in zip(alone, whole))
    with open(model_path, "rb") as f:
        model = f.read()
    return Spec(text, vocab if ordered else None, model, _cut_before_spaces(pb.ModelProto.FromString(model)))


def _cut_before_spaces(model: pb.ModelProto) -> bool:
    """Whether the piece model may be cut before a space that follows another character: no piece holds
    such a place, and normalisation neither changes characters nor drops spaces."""
    kind, rule = pb.ModelProto.SentencePiece, model.normalizer_spec
    names = [p.piece for p in model.pieces if p.type not in (kind.BYTE, kind.CONTROL, kind.UNKNOWN)]
    return not (any("▁" in n.lstrip("▁") for n in names) or rule.precompiled_charsmap or rule.remove_extra_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix) and rule.add_dummy_prefix


def _library(json_text: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_str(json_text)
    library.encode_special_tokens = True
    library.no_truncation()
    library.no_padding()
    return library


class Sides:
    """The two encoders and the bytes of each of their ids."""

    def __init__(self, spec: Spec):
        vocab = json.loads(spec.json_text)["model"]["vocab"]
        self.bytes_a = {i: raw_bytes(s) for s, i in vocab.items()}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=spec.model)
        model = pb.ModelProto.FromString(spec.model)
        kind = pb.ModelProto.SentencePiece
        self.bytes_b = {i: bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else p.piece.replace("▁", " ").encode("utf-8")
                        for i, p in enumerate(model.pieces)}
        self.size_a, self.size_b = (self._sizes(x) for x in (self.bytes_a, self.bytes_b))
        if spec.ranks is not None:
            one = tiktoken.Encoding("ranks", pat_str=BYTE_PIECES, mergeable_ranks=spec.ranks, special_tokens={}).encode_ordinary
            self.encode_a = lambda texts: list(map(one, texts))
        else:
            library = _library(spec.json_text)
            self.encode_a = lambda texts: [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]

    @staticmethod
    def _sizes(table: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(max(table) + 1, dtype=np.int64)
        for i, raw in table.items():
            out[i] = len(raw)
        return out

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """Of texts that begin with a space, which the model adds by itself."""
        return self.pieces.encode([t[1:] for t in texts], out_type=int, num_threads=1) if texts else []

    def spelled(self, a: list[int], b: list[int], text_a: str, text_b: str) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == text_a.encode("utf-8") and \
            b"".join(map(self.bytes_b.__getitem__, b)) == text_b.encode("utf-8")


class Open(NamedTuple):
    """Tokens of both sides whose groups are not closed, and the byte offset at which each side begins."""

    a: np.ndarray
    b: np.ndarray
    a_at: int
    b_at: int

    def __add__(self, other: Open) -> Open:
        return Open(np.concatenate([self.a, other.a]), np.concatenate([self.b, other.b]),
                    self.a_at if len(self.a) else other.a_at, self.b_at if len(self.b) else other.b_at)

    @property
    def empty(self) -> bool:
        return not (len(self.a) or len(self.b))


class Closed(NamedTuple):
    """Closed groups: their text and their links, one pair of ids (the last of each side) a group."""

    text: bytes = b""
    a: np.ndarray = _NONE
    b: np.ndarray = _NONE

    def __add__(self, other: Closed) -> Closed:
        return Closed(b";".join([t for t in (self.text, other.text) if t]), np.concatenate([self.a, other.a]), np.concatenate([self.b, other.b]))


class Fragment(NamedTuple):
    head: Open
    tail: Open | None  # None: the range has no common end


def align(x: Open, sides: Sides) -> tuple[Fragment, Closed]:
    """The fragment of tokens that lie side by side, and the groups closed inside it."""
    ends_a, ends_b = x.a_at + np.cumsum(sides.size_a[x.a]), x.b_at + np.cumsum(sides.size_b[x.b])
    common, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
    if not len(common):
        return Fragment(x, None), Closed()
    cut_a, cut_b = at_a + 1, at_b + 1
    head = Open(x.a[:cut_a[0]], x.b[:cut_b[0]], x.a_at, x.b_at)
    tail = Open(x.a[cut_a[-1]:], x.b[cut_b[-1]:], int(common[-1]), int(common[-1]))
    return Fragment(head, tail), _closed(x, cut_a, cut_b)


def _closed(x: Open, cut_a: np.ndarray, cut_b: np.ndarray) -> Closed:
    """The groups between the cuts, which are counts of tokens from the left."""
    a, b = x.a[cut_a[0]:cut_a[-1]], x.b[cut_b[0]:cut_b[-1]]
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[cut_a[1:] - cut_a[0] - 1] = last_b[cut_b[1:] - cut_b[0] - 1] = True
    return Closed(written(a, b, last_a, last_b)[0][:-1], a[last_a], b[last_b])


@lru_cache(maxsize=1)
def _names(size: int) -> tuple[list[str], np.ndarray]:
    """Every id below ``size`` with each of the signs that may follow it, and the lengths."""
    table = [f"{i}{sign}" for i in range(size) for sign in ",|;"]
    return table, np.array(list(map(len, table)), dtype=np.int64)


def written(a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The text of groups, a sign after each, and the length of it up to each token (those of side a of a
    group, then of side b, group by group).  ``last_a`` and ``last_b`` mark the last tokens of groups."""
    table, lengths = _names(1 << 16 if max(a.max(initial=0), b.max(initial=0)) < 1 << 16 else 1 << 21)
    group = np.concatenate([2 * (np.cumsum(last_a) - last_a), 2 * (np.cumsum(last_b) - last_b) + 1])
    codes = np.concatenate([3 * a.astype(np.int64) + last_a, 3 * b.astype(np.int64) + 2 * last_b])[np.argsort(group, kind="stable")]
    return "".join(map(table.__getitem__, codes.tolist())).encode(), np.cumsum(lengths[codes])


def close(x: Open) -> Closed:
    """An open stretch between two common ends, as the group that it is."""
    if x.empty:
        return Closed()
    return _closed(x, np.array([0, len(x.a)]), np.array([0, len(x.b)]))


def compose(left: Fragment, right: Fragment, sides: Sides) -> tuple[Fragment, Closed]:
    """The fragment of two ranges side by side, and the groups that their border closes."""
    if left.tail is None:
        middle, closed = align(left.head + right.head, sides)
        return Fragment(middle.head, middle.tail if right.tail is None else right.tail), closed
    middle, closed = align(left.tail + right.head, sides)
    if middle.tail is None:  # nothing closes
        return Fragment(left.head, middle.head if right.tail is None else right.tail), closed
    return Fragment(left.head, middle.tail if right.tail is None else right.tail), close(middle.head) + closed


def cuts(text: str, chunk: int, cut_b: bool) -> tuple[list[int], list[int]]:
    """Places at which the byte-level side and the piece side of a long text are cut, one of each a range;
    a place may equal the one before, if no cut is possible in the range."""
    n, a, b = len(text), [0], [0]
    for k in range(chunk, n, chunk):
        for out, find in ((a, _CUT_A), (b, _CUT_B)):
            m = find(text, max(k, out[-1])) if cut_b or out is a else None
            out.append(m.start() if m else n)
    return [*a, n], [*b, n]


_CUT_A = re.compile(r"(?<=\S)(?=[ \t\n\r\x0b\x0c])").search
_CUT_B = re.compile(r"(?<=[^ ])(?= +[^ ])").search


class Aligner:
    """Alignment of texts of usual length, as sums of the closed fragments of their units."""

    def __init__(self, spec: Spec):
        self.sides, self.cut_b = Sides(spec), spec.cut_b
        self.known = Memo(most=120_000)

    def units(self, texts: list[str]) -> list[tuple | None]:
        """(text of groups, links as pairs of 32-bit ids, tokens of both sides in one number) of each text
        that begins with a space; None if its tokens do not spell it."""
        s, flat = self.sides, itertools.chain.from_iterable
        if not texts:
            return []
        raw, all_a, all_b = [t.encode("utf-8") for t in texts], s.encode_a(texts), s.encode_b(texts)
        sizes, n_a, n_b = (np.cumsum(list(map(len, x))) for x in (raw, all_a, all_b))
        a, b = (np.array(list(flat(x)), dtype=np.int32) for x in (all_a, all_b))
        ends_a, ends_b = np.cumsum(s.size_a[a]), np.cumsum(s.size_b[b])
        # All at once: one stream of bytes in which both sides reach the end of every unit.
        if not (b"".join(map(s.bytes_a.__getitem__, a.tolist())) == b"".join(raw) == b"".join(map(s.bytes_b.__getitem__, b.tolist()))
                and n_b[0] and (ends_a[n_a - 1] == sizes).all() and (ends_b[n_b - 1] == sizes).all()):
            if len(texts) == 1:
                return [None]
            return [x for k, t in enumerate(texts) for x in (self.units([t]) if s.spelled(all_a[k], all_b[k], t, t) else [None])]
        at = np.minimum(np.searchsorted(ends_b, ends_a), len(b) - 1)
        last_a, last_b = ends_b[at] == ends_a, np.zeros(len(b), bool)
        last_b[at[last_a]] = True
        text, length = written(a, b, last_a, last_b)
        links = np.stack([a[last_a], b[last_b]], axis=1).astype("<i4").tobytes()
        to, link = length[n_a + n_b - 1].tolist(), (8 * np.cumsum(last_a)[n_a - 1]).tolist()
        return [(text[i:j - 1], links[k:m], len(x) << 32 | len(y)) for i, j, k, m, x, y in zip([0, *to], to, [0, *link], link, all_a, all_b)]

    def texts(self, texts: list[str]) -> list[tuple | None]:
        """The same of each whole text, a space before it."""
        if not self.cut_b:
            return self.units([" " + t for t in texts])
        # The piece model adds its space to no empty text: spaces at both ends stay with a unit.
        cut = [GAP.split(t) if " " in (t[:1], t[-1:]) else units(t) for t in texts]
        heads = [u.pop(0) for u in cut]
        lacking = list(self.known.renew(itertools.chain.from_iterable(cut)))
        fresh = self.units([" " + u for u in itertools.chain(heads, lacking)])
        new = dict(zip(lacking, fresh[len(heads):]))
        self.known.compute = lambda u: new[u] if u in new else self.units([" " + u])[0]
        out = []
        for head, rest in zip(fresh, cut):
            parts = [head, *map(self.known.__getitem__, rest)]
            if None in parts:
                out.append(None)
                continue
            text, links, n = zip(*parts)
            out.append((b";".join(text), b"".join(links), sum(n)))
        return out


@lru_cache(maxsize=1)
def aligner(spec_key: str) -> Aligner:
    """One a worker process; ``_specs`` has the specification by its key."""
    return Aligner(_specs[spec_key])


_specs: dict[str, Spec] = {}


def _aligner(spec) -> Aligner:
    value: Spec = spec.value
    key = hashlib.sha256(value.json_text.encode() + value.model).hexdigest()
    _specs.setdefault(key, value)
    return aligner(key)


def _whole_texts(docs: DataFrame, spec) -> DataFrame:
    """doc_id, ok, n_a, n_b, n_groups, groups_sha256 and the links (a, b) of texts of one range."""

    @per_task
    def start():
        run = _aligner(spec)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            full = [k for k, t in enumerate(texts) if t]
            done = dict(zip(full, run.texts([texts[k] for k in full])))
            got = [done.get(k) or (b"", b"", 0) for k in range(len(texts))]
            links = np.frombuffer(b"".join([g[1] for g in got]), dtype="<i4").reshape(-1, 2)
            n = [len(g[1]) // 8 for g in got]
            at = pa.array(np.cumsum([0, *n]), pa.int32())
            return pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([g[2] >> 32 for g in got], pa.int64()), pa.array([g[2] & 0xFFFFFFFF for g in got], pa.int64()),
                pa.array(n, pa.int64()), pa.array([hashlib.sha256(g[0]).hexdigest() if g[0] else "" for g in got], pa.string()),
                *(pa.ListArray.from_arrays(at, pa.array(np.ascontiguousarray(links[:, i]), pa.int32())) for i in (0, 1))], list(_DOC))

        return each

    return map_batches(docs, start, ", ".join(f"{c} {t}" for c, t in _DOC.items()), SLICE)


_DOC = {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "groups_sha256": "string", "a": "array<int>", "b": "array<int>"}

#: A row of the composition: a fragment (closed is null) or closed groups and their place ``seq``.
_ROW = {"row": pa.int64(), "seq": pa.int64(), "last": pa.int64(), "ok": pa.bool_(), "n_a": pa.int64(), "n_b": pa.int64(), "has_tail": pa.bool_(),
        "at": pa.list_(pa.int64()), "head_a": pa.list_(pa.int32()), "head_b": pa.list_(pa.int32()), "tail_a": pa.list_(pa.int32()),
        "tail_b": pa.list_(pa.int32()), "closed": pa.binary(), "a": pa.list_(pa.int32()), "b": pa.list_(pa.int32())}
_ROW_DDL = ("row bigint, seq bigint, last bigint, ok boolean, n_a bigint, n_b bigint, has_tail boolean, at array<bigint>, head_a array<int>, "
            "head_b array<int>, tail_a array<int>, tail_b array<int>, closed binary, a array<int>, b array<int>")


def _fragment_row(row: int, seq: int, last: int, ok: bool, n_a: int, n_b: int, f: Fragment) -> dict:
    tail = f.tail or Open(_NONE, _NONE, 0, 0)
    return {"row": row, "seq": seq, "last": last, "ok": ok, "n_a": n_a, "n_b": n_b, "has_tail": f.tail is not None,
            "at": [f.head.a_at, f.head.b_at, tail.a_at, tail.b_at], "head_a": f.head.a, "head_b": f.head.b, "tail_a": tail.a, "tail_b": tail.b}


def _closed_row(row: int, seq: int, c: Closed) -> dict:
    return {"row": row, "seq": seq, "closed": c.text, "a": c.a, "b": c.b}


def _record(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in _ROW.items()], list(_ROW))


def _read(r: dict) -> Fragment:
    a, b, c, d = r["at"]
    ids = lambda x: np.array(x, dtype=np.int32)
    return Fragment(Open(ids(r["head_a"]), ids(r["head_b"]), a, b), Open(ids(r["tail_a"]), ids(r["tail_b"]), c, d) if r["has_tail"] else None)


def _ranges(docs: DataFrame, chunk: int, cut_b: bool) -> DataFrame:
    """Long texts as ranges: row, seq, and of each side its text and the byte offset at which it begins."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = " " + text
            a, b = cuts(text, chunk, cut_b)
            at_a = at_b = 0
            for k in range(len(a) - 1):
                part_a, part_b = text[a[k]:a[k + 1]], text[b[k]:b[k + 1]]
                out.append((row, k, part_a, part_b, at_a, at_b))
                at_a, at_b = at_a + len(part_a.encode()), at_b + len(part_b.encode())
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)],
                                          ["row", "seq", "text_a", "text_b", "at_a", "at_b"])

    return map_batches(docs.select("row", "text"), each, "row bigint, seq bigint, text_a string, text_b string, at_a bigint, at_b bigint")


def _fragments(ranges: DataFrame, spec) -> DataFrame:
    """One fragment a range, and its closed groups at place 2 * seq."""

    @per_task
    def start():
        s = _aligner(spec).sides

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for row, seq, ta, tb, at_a, at_b in zip(*[c.to_pylist() for c in batch.columns]):
                a, b = s.encode_a([ta])[0] if ta else [], s.encode_b([tb])[0] if tb else []
                ok = s.spelled(a, b, ta, tb)
                if not ok:  # the text has no tokens then; nothing of it is composed
                    a, b = [], []
                f, closed = align(Open(np.array(a, np.int32), np.array(b, np.int32), at_a, at_b), s)
                out.append(_fragment_row(row, seq, seq, ok, len(a), len(b), f))
                if closed.text:
                    out.append(_closed_row(row, 2 * seq, closed))
            return _record(out)

        return each

    return map_batches(ranges, start, _ROW_DDL)


def _composed(fragments: DataFrame, spec, fan: int) -> DataFrame:
    """Fragments of a row composed ``fan`` at a time; groups closed by the border after range k are at 2 * k + 1."""
    dealt = fragments.withColumn("up", F.floor(F.col("seq") / fan)).repartition("row", "up").sortWithinPartitions("row", "up", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, now, out = _aligner(spec).sides, None, []
        for batch in batches:
            for r in batch.to_pylist():
                if now is not None and (now["row"], now["up"]) == (r["row"], r["up"]):
                    f, closed = compose(now["f"], _read(r), s)
                    if closed.text:
                        out.append(_closed_row(r["row"], 2 * now["last"] + 1, closed))
                    now |= {"f": f, "last": r["last"], "ok": now["ok"] and r["ok"], "n_a": now["n_a"] + r["n_a"], "n_b": now["n_b"] + r["n_b"]}
                else:
                    if now is not None:
                        out.append(_fragment_row(*(now[c] for c in ("row", "up", "last", "ok", "n_a", "n_b", "f"))))
                    now = {**{c: r[c] for c in ("row", "up", "last", "ok", "n_a", "n_b")}, "f": _read(r)}
            if out:
                yield _record(out)
                out = []
        if now is not None:
            yield _record([_fragment_row(*(now[c] for c in ("row", "up", "last", "ok", "n_a", "n_b", "f")))])

    return map_arrow(dealt, run, _ROW_DDL)


def _ends(fragments: DataFrame, spec) -> DataFrame:
    """The one fragment of a whole text: its head is the first group, its tail is empty if all is spelled."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for r in batch.to_pylist():
            f = _read(r)
            out.append({**{c: r[c] for c in ("row", "n_a", "n_b")}, "ok": r["ok"] and f.tail is not None and f.tail.empty, "seq": -1})
            out.append(_closed_row(r["row"], -1, close(f.head)))
        return _record(out)

    return map_batches(fragments, each, _ROW_DDL)


def _long_texts(docs: DataFrame, spec, chunk: int, fan: int) -> tuple[DataFrame, DataFrame]:
    """Of texts of more than one range, as tables with the columns of ``_DOC``: the documents, without
    links, and their links, a row for each range and border."""
    rows = reliable_checkpoint(docs.withColumn("row", F.monotonically_increasing_id()))
    dealt = reliable_checkpoint(_ranges(rows, chunk, spec.value.cut_b)).repartition("row", "seq")
    made = reliable_checkpoint(_fragments(dealt, spec))
    parts, up = made.where("closed IS NOT NULL"), made.where("closed IS NULL")
    ranges = up.agg(F.max("last")).first()[0] or 0
    while ranges > 0:
        made = reliable_checkpoint(_composed(up, spec, fan))
        parts, up = parts.unionByName(made.where("closed IS NOT NULL")), made.where("closed IS NULL")
        ranges //= fan
    made = reliable_checkpoint(_ends(up, spec))
    whole = made.where("closed IS NULL AND ok").select("row", "n_a", "n_b")
    parts = reliable_checkpoint(parts.unionByName(made.where("closed IS NOT NULL")).where("length(closed) > 0").select("row", "seq", "closed", "a", "b").join(whole.select("row"), "row"))
    sha = ordered_hash.hashed(parts, ["row"], "seq", "closed", b";", "groups_sha256")
    n = parts.groupBy("row").agg(F.sum(F.size("a")).cast("bigint").alias("n_groups"))
    full = whole.join(n, "row").join(sha, "row")
    out = rows.select("doc_id", "row").join(full, "row", "left").select(
        "doc_id", "row", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_groups")), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return out, parts.select("row", "a", "b")


def _counted(rows: DataFrame) -> DataFrame:
    """(a, b, n) of the pairs in the link lists a, b of rows, counted within each batch before any exchange."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (c.flatten().to_numpy().astype(np.int64) for c in batch.columns)
        code, n = np.unique(a << 32 | b, return_counts=True)
        return record(a=pa.array(code >> 32, pa.int32()), b=pa.array(code & 0xFFFFFFFF, pa.int32()), n=pa.array(n, pa.int64()))

    return map_batches(rows.select("a", "b"), each, "a int, b int, n bigint")


def _scored(rows: DataFrame, keep: list[str], pairs: DataFrame) -> DataFrame:
    """``keep`` columns of rows with link lists a, b, and n_best and count_sum of the links of each row, by
    a table of pairs that is broadcast, sorted by pair."""
    sc = rows.sparkSession.sparkContext
    t = pairs.orderBy("a", "b").toArrow()
    key = t.column("a").to_numpy().astype(np.int64) << 32 | t.column("b").to_numpy().astype(np.int64)
    table = sc.broadcast((key, t.column("n").to_numpy().astype(np.int64), t.column("best").to_numpy().astype(bool)))
    kinds = dict(rows.select(*keep).dtypes)

    @per_task
    def start():
        known, n, best = table.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            a, b = (batch.column(batch.schema.get_field_index(c)) for c in "ab")
            sizes = np.diff(a.offsets.to_numpy())
            code = a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy().astype(np.int64)
            distinct, back = np.unique(code, return_inverse=True)  # fewer and ordered reads of the table
            at = np.searchsorted(known, distinct)[back] if len(code) else np.zeros(0, np.int64)
            ends = np.cumsum([0, *sizes])
            sums = [np.concatenate([[0], np.cumsum(x[at].astype(np.int64))]) for x in (best, n)]
            made = [pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()) for s in sums]
            return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep), *made], [*keep, "n_best", "count_sum"])

        return each

    return map_batches(rows.select(*keep, "a", "b"), start, ", ".join(f"{c} {kinds[c]}" for c in keep) + ", n_best bigint, count_sum bigint")


def _scored_by_join(rows: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """key, n_best, count_sum, by a join on the pair."""
    links = rows.select(key, F.explode(F.arrays_zip("a", "b")).alias("x")).groupBy(key, "x.a", "x.b").agg(F.count("*").alias("times"))
    return links.join(pairs, ["a", "b"]).groupBy(key).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))


def cross_alignment(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                    chunk: int = CHUNK, fan: int = FAN, broadcast_pairs: int = PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair count is the highest of
    their piece id), count_sum (pair counts over its links), groups_sha256.  Pairs are counted over all
    documents.  The count table is broadcast up to ``broadcast_pairs`` rows and joined beyond."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(json_path, model_path))
    texts = id_text(docs, id_col, text_col)
    short = reliable_checkpoint(_whole_texts(texts.where(F.length("text") < chunk), spec).withColumn("row", F.monotonically_increasing_id()))
    long, long_links = _long_texts(texts.where(F.length("text") >= chunk), spec, chunk, fan)
    counts = _counted(short).unionByName(_counted(long_links))
    pairs = reliable_checkpoint(counts.groupBy("a", "b").agg(F.sum("n").alias("n")))
    top = pairs.groupBy("b").agg(F.max("n").alias("top"))
    pairs = reliable_checkpoint(pairs.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best")))
    figures = ["n_a", "n_b", "n_groups", "groups_sha256"]
    if pairs.count() <= broadcast_pairs:
        done = _scored(short, ["doc_id", *figures], pairs)
        scores = _scored(long_links, ["row"], pairs).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    else:
        done = short.join(_scored_by_join(short, "row", pairs), "row", "left").drop("a", "b")
        scores = _scored_by_join(long_links, "row", pairs)
    done = done.select("doc_id", *figures, "n_best", "count_sum").unionByName(
        long.join(scores, "row", "left").select("doc_id", *figures, "n_best", "count_sum"))
    return done.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                       *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
