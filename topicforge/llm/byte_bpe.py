"""Operator 11: byte-level BPE by a sentencepiece model serialised directly from the vocabulary.

A vocabulary of ranks (lines of a base64 byte string and its rank) becomes a sentencepiece BPE model
without any training: every byte is written as one letter, every entry is a piece scored by its negative
rank, normalisation is the identity and no space is added or removed.  sentencepiece then merges the
neighbours of highest score, further left first, which is the merge order of the ranks.  Texts are cut
into pre-tokens by the vocabulary's pattern and each is encoded by itself; ids decode by the inverse
mapping, from a piece's letters back to its bytes.  An entry that its own merges do not give (found by
encoding every entry once) is looked up whole, as a pre-token equal to an entry is that entry.

Defined results: null and empty texts give no ids and no bytes; special strings inside texts are plain
text; repeated rows each give their own row; texts of any length are encoded whole; other columns of the
input are not read.  A vocabulary that lacks one of the 256 bytes is refused.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as pb

from topicforge.llm.batches import id_text, map_batches, per_task, texts_of
from topicforge.llm.pretokens import Memo, byte_letters

LETTERS = byte_letters()
_TO_LETTERS = dict(enumerate(LETTERS))
_TO_BYTES = {c: b for b, c in enumerate(LETTERS)}


def letters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_TO_LETTERS)


def raw_bytes(piece: str) -> bytes:
    return bytes(map(_TO_BYTES.__getitem__, piece))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; ids that no entry has are unused pieces.
    One unknown piece, which the format asks for, follows the entries and is never produced."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks the bytes {missing[:5]}")
    if len(set(ranks.values())) != len(ranks):
        raise ValueError("two entries have one rank")
    token_of = {rank: token for token, rank in ranks.items()}
    size = max(token_of) + 1
    kinds = pb.ModelProto.SentencePiece
    model = pb.ModelProto()
    for i in range(size):
        token = token_of.get(i)
        if token is None:  # a name with a blank is no piece of letters
            model.pieces.add(piece=f"unused {i}", score=-float(size), type=kinds.UNUSED)
        else:
            model.pieces.add(piece=letters(token), score=-float(i), type=kinds.NORMAL)
    model.pieces.add(piece="unknown piece", score=0.0, type=kinds.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = size + 1
    model.trainer_spec.unk_id = size
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


#: A space beside other white space, and a space between two characters that are none.
_UNEVEN, GAP = re.compile(r" (?:\s|(?<=\s ))").search, re.compile(r"(?<=\S) (?=\S)")


def units(text: str) -> list[str]:
    """The text cut before single spaces, across which no pre-token goes on; all units but the first lack
    the space they begin with."""
    return GAP.split(text) if _UNEVEN(text) else text.split(" ")


class ByteBpe:
    """Encoder and decoder over a serialised model.  What units of text encode to is remembered, within
    bounds."""

    def __init__(self, model: bytes, pattern: str):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        used = [i for i in range(self.library.get_piece_size() - 1) if not self.library.is_unused(i)]
        names = list(map(self.library.id_to_piece, used))
        self.bytes_of = dict(zip(used, map(raw_bytes, names)))
        alone = self.library.encode(names, out_type=int, num_threads=1)
        self.whole = {piece: [i] for i, piece, ids in zip(used, names, alone) if ids != [i]}
        self.known = Memo(most=300_000)

    def encode_units(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, its pre-tokens encoded in one call of the library."""
        pieces, ends, space = [], [], LETTERS[32]
        for t in texts:
            if t.isascii() and t.isprintable():  # printable ASCII stands for itself, but for the space
                if t[1:].isalpha() and t[0] == " ":  # one word: one pre-token
                    pieces.append(space + t[1:])
                else:
                    pieces += [p.replace(" ", space) for p in self.find(t)]
            else:
                pieces += [letters(p.encode("utf-8")) for p in self.find(t)]
            ends.append(len(pieces))
        ids = self.library.encode(pieces, out_type=int, num_threads=1) if pieces else []
        if self.whole:
            ids = [self.whole.get(p, i) for p, i in zip(pieces, ids)]
        at = np.cumsum([0, *map(len, ids)])[[0, *ends]] * 4
        flat = np.array(list(itertools.chain.from_iterable(ids)), dtype="<u4").tobytes()
        return [flat[a:b] for a, b in itertools.pairwise(at.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = list(map(units, texts))
        heads = [u.pop(0) for u in cut]
        lacking = list(self.known.renew(itertools.chain.from_iterable(cut)))
        fresh = self.encode_units(heads + [" " + u for u in lacking])
        new = dict(zip(lacking, fresh[len(heads):]))
        self.known.compute = lambda u: new[u] if u in new else self.encode_units([" " + u])[0]
        return [head + b"".join(map(self.known.__getitem__, rest)) for head, rest in zip(fresh, cut)]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def byte_bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                        give: str = "full") -> DataFrame:
    """Encode every text and decode it again.  Returns doc_id, n_tokens and, as ``give`` says: "full" ids
    array<int> and decoded binary; "digest" ids_sha256 (ids as little-endian unsigned 32-bit integers) and
    decoded_sha256.  The model, bounded by the vocabulary, is serialised once and broadcast; map-only: one
    scan, no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(ranks_path)))
    schema = {"full": "ids array<int>, decoded binary", "digest": "ids_sha256 string, decoded_sha256 string"}[give]
    names = ["doc_id", "n_tokens", *(part.split()[0] for part in schema.split(", "))]

    @per_task
    def start():
        coder = coder_of(model.value, pattern)

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            raw = coder.encode(texts_of(b))
            ids = [np.frombuffer(r, dtype="<u4") for r in raw]
            back = [coder.decode(i) for i in ids]
            n = pa.array([len(i) for i in ids], pa.int64())
            if give == "digest":
                sha = [pa.array([hashlib.sha256(x).hexdigest() for x in part], pa.string()) for part in (raw, back)]
            else:
                sha = [pa.array([i.astype("<i4") for i in ids], pa.list_(pa.int32())), pa.array(back, pa.binary())]
            return pa.RecordBatch.from_arrays([b.column(0), n, *sha], names)

        return each

    return map_batches(id_text(docs, id_col, text_col), start, f"doc_id bigint, n_tokens bigint, {schema}")


@lru_cache(maxsize=2)
def coder_of(model: bytes, pattern: str) -> ByteBpe:
    """One coder a worker process, kept from task to task."""
    return ByteBpe(model, pattern)
