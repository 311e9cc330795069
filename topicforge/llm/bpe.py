"""Operator 1: byte-pair encoding by backtracking, decoding by an offset table.

Encoding a piece: one Aho-Corasick pass finds the longest token that starts at every position.  Tokens
are laid from the left; a token is accepted if it is compatible with the one before it (merging the two
spelled together gives back exactly these two) and if the rest after it has not failed before.  Else the
next shorter token is tried, and with none left the previous token is taken back.  A sequence whose
neighbours are all compatible is the very sequence that the merges give, so the result is exact; each
position fails at most once, so time is linear in the piece.

Defined results: null and empty texts give no ids and the empty text; repeated rows each give their own
row; texts of any length are encoded whole; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from topicforge.llm.batches import id_text, map_batches, per_task, record, texts_of
from topicforge.llm.pretokens import Memo, Vocabulary, chunker, splitter, vocabulary

NEVER = 1 << 60


class Backtracking:
    """Encoder of single pieces, over the symbol strings of a vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.ids, self.spelled = vocab.ids, vocab.symbols
        self.pair = vocab.merges
        # How each token came about: (left, right, rank).  Parts must be older than the whole; then merges
        # happen in the order of their ranks and compatibility can be read off the two halves' histories.
        self.made: dict[int, tuple[int, int, int]] = {}
        for (a, b), (rank, whole) in vocab.merges.items():
            if whole not in self.made or rank < self.made[whole][2]:
                self.made[whole] = (a, b, rank)
        for a, b, rank in self.made.values():
            if max(self.made.get(a, (0, 0, -1))[2], self.made.get(b, (0, 0, -1))[2]) >= rank:
                raise ValueError("merges are not ordered: a token is merged before its parts exist")
        self.fits = Memo(self._compatible, most=200_000)
        # Only tokens that the merges produce from their own spelling take part in the automaton.
        reachable = [i for i, s in self.spelled.items() if len(s) == 1 or i in self.made and self._stands(i)]
        self.finder = ahocorasick.Automaton()
        for i in reachable:
            self.finder.add_word(self.spelled[i], (len(self.spelled[i]), i))
        self.finder.make_automaton()
        known = {self.spelled[i]: i for i in reachable}
        self.shorter = {}  # token -> longest reachable token that is a proper prefix of it
        for i in reachable:
            s = self.spelled[i]
            self.shorter[i] = next((known[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in known), None)

    def _stands(self, token: int) -> bool:
        """Whether the merges turn the token's spelling back into the token: its two parts stand and no
        merge crosses their border before the one that makes the token."""
        left, right, rank = self.made[token]
        return self._crossing(left, right) == rank and all(len(self.spelled[x]) == 1 or self._stands(x) for x in (left, right))

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that hold the token's first (side 0) or last (side 1) symbol while it is built,
        oldest first, each with the rank at which it is merged into the next."""
        out, until = [], NEVER
        while True:
            out.append((token, until))
            if token not in self.made:
                return out[::-1]
            until = self.made[token][2]
            token = self.made[token][side]

    def _crossing(self, a: int, b: int) -> int:
        """Rank of the first merge across the border of a and b; NEVER if there is none.  At equal ranks
        the merge further left comes first."""
        left, right = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            rank = self.pair.get((x, y), (NEVER, 0))[0]
            if rank < x_ends and rank <= y_ends and rank != NEVER:
                return rank
            if x_ends == y_ends == NEVER:
                return NEVER
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def _compatible(self, key: tuple[int, int]) -> bool:
        return self._crossing(*key) == NEVER

    def encode(self, piece: str) -> list[int]:
        s = self.vocab.spell(piece)
        n = len(s)
        whole = self.ids.get(s)
        if whole is not None and whole in self.shorter:
            return [whole]
        longest: list[int | None] = [None] * (n + 1)
        reach = [0] * (n + 1)
        for end, (size, token) in self.finder.iter(s):
            start = end - size + 1
            if size > reach[start]:
                reach[start], longest[start] = size, token
        out: list[int] = []
        starts: list[int] = []
        dead = bytearray(n + 1)  # positions from which the rest cannot be laid
        pos, token = 0, longest[0]
        while pos < n:
            if token is None:
                if not out:
                    raise ValueError("piece has a byte outside the vocabulary")
                dead[pos] = 1
                pos, token = starts.pop(), self.shorter[out.pop()]
                continue
            end = pos + len(self.spelled[token])
            if not dead[end] and (not out or self.fits[out[-1], token]):
                out.append(token)
                starts.append(pos)
                pos, token = end, longest[end]
            else:
                token = self.shorter[token]
        return out


class OffsetTable:
    """All token texts end to end, and where each begins; decoding gathers slices of this table."""

    def __init__(self, vocab: Vocabulary, between: bytes = b" "):
        parts = [vocab.text_of.get(i, "").encode("utf-8") + between for i in range(vocab.size)]
        self.bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.at = np.zeros(len(parts) + 1, dtype=np.int64)
        np.cumsum([len(p) for p in parts], out=self.at[1:])
        self.gap = len(between)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token texts joined by the separator, as a tokenizer file without a decoder asks for."""
        if not len(ids):
            return b""
        begin = self.at[ids]
        size = self.at[ids + 1] - begin
        ends = np.cumsum(size)
        take = np.arange(ends[-1], dtype=np.int64)
        take += np.repeat(begin - (ends - size), size)
        return self.bytes[take].tobytes()[: -self.gap or None]


@lru_cache(maxsize=2)
def encoder(path: str) -> Backtracking:
    return Backtracking(vocabulary(path))


@lru_cache(maxsize=2)
def offset_table(path: str) -> OffsetTable:
    return OffsetTable(vocabulary(path))


@lru_cache(maxsize=2)
def text_encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids as little-endian unsigned 32-bit integers.  What a chunk gives is
    remembered, within bounds."""
    one, split, cut = encoder(path), splitter(path), chunker(path)
    fixed = {s: np.array([i], dtype="<u4").tobytes() for s, i in vocabulary(path).special.items()}

    piece = Memo(lambda p: fixed.get(p) or np.array(one.encode(p), dtype="<u4").tobytes(), most=100_000).__getitem__

    def pieces(text: str) -> bytes:
        return b"".join(map(piece, split(text)))

    mark = cut("")[2]
    known = Memo(lambda chunk: pieces(mark + chunk), most=100_000).__getitem__

    def encode(text: str) -> bytes:
        head, chunks, _ = cut(text)
        ids = b"".join(map(known, chunks))
        return pieces(head) + ids if head else ids

    return encode


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   give: str = "full") -> DataFrame:
    """Encode every text and decode it again.  Returns doc_id, n_tokens and, as ``give`` says: "full"
    ids array<int> and decoded string; "digest" the SHA-256 of both (ids as little-endian unsigned 32-bit
    integers, text as UTF-8); "ids" the ids and the SHA-256 of the decoded text.  Map-only: one scan, no
    shuffle."""
    schema = {"full": "ids array<int>, decoded string", "digest": "ids_sha256 string, decoded_sha256 string",
              "ids": "ids array<int>, decoded_sha256 string"}[give]

    @per_task
    def start():
        encode, offsets = text_encoder(tokenizer_path), offset_table(tokenizer_path)

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            raw = list(map(encode, texts_of(b)))
            ids = [np.frombuffer(r, dtype="<u4") for r in raw]
            back = [offsets.decode(i) for i in ids]
            n = pa.array([len(i) for i in ids], pa.int64())
            sha = lambda parts: pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
            text = sha(back) if give != "full" else pa.array([x.decode("utf-8", "replace") for x in back], pa.string())
            first = sha(raw) if give == "digest" else pa.array([i.astype("<i4") for i in ids], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([b.column(0), n, first, text], ["doc_id", "n_tokens", *names])

        return each

    names = [part.split()[0] for part in schema.split(", ")]
    return map_batches(id_text(docs, id_col, text_col), start, f"doc_id bigint, n_tokens bigint, {schema}")
