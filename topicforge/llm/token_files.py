"""Operator 4: token ids in binary shards, each document compressed alone with a shared dictionary.

Texts are encoded with the ``tokenizers`` library (each different piece once per worker; pieces are
merged separately by the format, so the ids are those of the whole text).  A zstandard dictionary is
trained on serialised id arrays, and every document becomes a frame of its own, so that a single short
document can be read without its neighbours.

Format.  A file is one Parquet part of the table at ``path``; its rows are shards of consecutive documents
in ascending doc_id order, with their position and id range as plain columns (so a lookup is a pushed
filter).  The column ``blob`` of a shard is, little-endian:

    magic "TIDSHRD1" | uint32 header length | header JSON (dict_sha256, width, n_docs)
    | int64 doc_id * n | uint8 id present * n | uint32 n_ids * n | uint64 frame offset * (n + 1) | frames

``width`` is the bytes of an id inside a frame.  The dictionary lies beside the shards in ``path``_dict with
its SHA-256; a reader refuses a shard that names another.  Spark's committer writes both, so a lost or
repeated task leaves no partial or double file.

Defined results: null and empty texts hold just the end id; rows without a doc_id come first; rows that
repeat a doc_id keep one entry each, ordered by content; an empty table gives no shard; other columns are
ignored; texts of any length are kept whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

from topicforge.llm.batches import id_text, map_arrow, map_batches, per_task, record, texts_of
from topicforge.llm.pretokens import Memo, splitter, vocabulary
from topicforge.session import reliable_checkpoint

MAGIC = b"TIDSHRD1"
SHARD_BYTES = 4 << 20
SHARD_DOCS = 4096
LEVEL = 3
#: The dictionary is a fitted model: it learns from the documents with the smallest hashes of doc_id, at
#: most so many, and from at most so many bytes of each.  Every document is then compressed whole with it.
DICT_DOCS, DICT_DOC_BYTES, DICT_BYTES = 768, 8192, 64 << 10
#: Bytes of texts encoded together: their pieces stay near the processor, the library gets some hundred at a time.
ENCODE_BYTES = 128 << 10


class LibraryIds:
    """Ids of texts by the library, as little-endian integers of ``width`` bytes.  A batch's new pieces
    go to the library together; the memory of pieces is bounded."""

    def __init__(self, path: str, most: int = 200_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path, v = path, vocabulary(path)
        self.width = 2 if v.size <= 1 << 16 else 4
        self.split = splitter(path)
        self.special = {s: self.pack([i]) for s, i in v.special.items()}
        self.final = np.array([bool(v.suffix) and v.text_of.get(i, "").endswith(v.suffix) for i in range(v.size)])
        self.pieces, self.most = Memo(most=most), most

    @cached_property
    def library(self) -> Tokenizer:
        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    @cached_property
    def bare(self) -> Tokenizer:
        """For pieces of words, which are normalised and split already: white space alone parts them."""
        bare = Tokenizer.from_file(self.path)
        bare.no_truncation()
        bare.no_padding()
        bare.normalizer = None
        bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        return bare

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of single pieces.  Where a vocabulary marks word ends, the pieces go to the library as one
        text of words, and the marks part its ids again."""
        if self.final.any() and pieces:
            ids = np.array(self.bare.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype=f"<u{self.width}")
            ends = np.flatnonzero(self.final[ids]) + 1
            if len(ends) == len(pieces):
                raw, at = ids.tobytes(), [0, *(ends * self.width).tolist()]
                return [raw[i:j] for i, j in zip(at, at[1:])]
        return [self.pack(e.ids) for e in self.library.encode_batch(pieces, add_special_tokens=False)]

    def encode(self, texts: list[str], end_id: int | None) -> list[bytes]:
        known, tail = self.pieces, b"" if end_id is None else self.pack([end_id])
        known.update(self.special)
        get = known.get
        found, lacking = [], []  # of each text: the ids of its pieces, where they are known; (position, piece) of the others
        for text in texts:
            pieces = self.split(text)
            found.append(list(map(get, pieces)))
            lacking.append([(k, pieces[k]) for k, x in enumerate(found[-1]) if x is None])
        fresh = list(known.renew(p for some in lacking for _, p in some))
        known.update(zip(fresh, self._pieces(fresh)))  # the long ones for now
        out = []
        for ids, some in zip(found, lacking):
            for k, p in some:
                ids[k] = known[p]
            out.append(b"".join(ids) + tail)
        for p in fresh:
            if len(p) > known.longest:
                del known[p]
        if len(known) > self.most:
            known.before = dict(known)
            known.clear()
        return out


@lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    return LibraryIds(path)


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int | None) -> DataFrame:
    """(doc_id, ids binary) of every row."""

    @per_task
    def start():
        lib = library_ids(tokenizer_path)
        return lambda b: record(doc_id=b.column(0), ids=pa.array(lib.encode(texts_of(b), end_id), pa.binary()))

    return map_batches(docs, start, "doc_id bigint, ids binary", ENCODE_BYTES)


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary; where the trainer finds too little to learn from, the samples themselves
    (raw content) serve, and without samples there is none."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    if not raw:
        return None
    d = zstandard.ZstdCompressionDict(raw)
    d.precompute_compress(level=LEVEL)  # else every document would digest the dictionary anew
    return d


def compressor(raw: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(dict_data=_dictionary(raw)) if raw else zstandard.ZstdCompressor(level=LEVEL)


def pack_shard(rows: list[tuple[int | None, int, bytes]], dict_sha256: str, width: int) -> bytes:
    head = json.dumps({"dict_sha256": dict_sha256, "width": width, "n_docs": len(rows)}).encode()
    at = np.zeros(len(rows) + 1, dtype="<u8")
    np.cumsum([len(r[2]) for r in rows], out=at[1:])
    return b"".join([
        MAGIC, len(head).to_bytes(4, "little"), head,
        np.array([r[0] or 0 for r in rows], dtype="<i8").tobytes(),
        np.array([r[0] is not None for r in rows], dtype="u1").tobytes(),
        np.array([r[1] for r in rows], dtype="<u4").tobytes(), at.tobytes(), *(r[2] for r in rows)])


class Shard:
    """A parsed shard: its documents' ids, sizes and frames, without decompressing any."""

    def __init__(self, blob: bytes, dictionaries: dict[str, bytes]):
        if blob[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        size = int.from_bytes(blob[8:12], "little")
        head = json.loads(blob[12:12 + size])
        n, self.width, pos = head["n_docs"], head["width"], 12 + size
        if head["dict_sha256"] not in dictionaries:
            raise ValueError(f"the shard needs the dictionary {head['dict_sha256']}")
        parts = []
        for kind, count in (("<i8", n), ("u1", n), ("<u4", n), ("<u8", n + 1)):
            parts.append(np.frombuffer(blob, dtype=kind, count=count, offset=pos))
            pos += parts[-1].nbytes
        self.doc_ids, self.present, self.n_ids, self.at = parts
        self.frames = memoryview(blob)[pos:]
        raw = dictionaries[head["dict_sha256"]]
        self._open = zstandard.ZstdDecompressor(dict_data=_dictionary(raw)) if raw else zstandard.ZstdDecompressor()

    def ids(self, k: int) -> np.ndarray:
        frame = self.frames[int(self.at[k]):int(self.at[k + 1])]
        return np.frombuffer(self._open.decompress(frame), dtype=f"<u{self.width}")


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None,
                      id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Encode every row and write the shards at ``path`` and the dictionary at ``path``_dict.  One pass
    over the texts encodes and compresses; only compressed frames are sorted by doc_id."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col)
    chosen = [r[0] for r in rows.select("doc_id").where("doc_id is not null").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(DICT_DOCS).collect()]
    some = encoded(rows.where(F.col("doc_id").isin(chosen)), tokenizer_path, end_id)
    samples = [bytes(r[1]) for r in some.select("doc_id", F.substring("ids", 1, DICT_DOC_BYTES).alias("ids"))
               .dropDuplicates(["doc_id"]).orderBy("doc_id").collect()] if chosen else []
    raw = train_dictionary(samples)
    sha = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(sha, bytearray(raw))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}_dict")
    shared = spark.sparkContext.broadcast(raw)
    width = 2 if vocabulary(tokenizer_path).size <= 1 << 16 else 4

    @per_task
    def compress():
        lib = library_ids(tokenizer_path)
        press = compressor(shared.value)

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = lib.encode(texts_of(b), end_id)
            return record(doc_id=b.column(0), n_ids=pa.array([len(x) // lib.width for x in ids], pa.int64()),
                          frame=pa.array(map(press.compress, ids), pa.binary()))

        return each

    frames = reliable_checkpoint(map_batches(rows, compress, "doc_id bigint, n_ids bigint, frame binary", ENCODE_BYTES))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (frames.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "n_ids", "frame")
             .withColumn("file", F.spark_partition_id()))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, int, bytes]] = []
        size = shard = file = 0

        def shut() -> pa.RecordBatch:
            of = lambda v, kind: pa.array([v], kind)
            return record(file=of(file, pa.int32()), shard=of(shard, pa.int32()), first_doc_id=of(held[0][0], pa.int64()),
                          last_doc_id=of(held[-1][0], pa.int64()), n_docs=of(len(held), pa.int64()),
                          n_ids=of(sum(r[1] for r in held), pa.int64()), blob=of(pack_shard(held, sha, width), pa.binary()))

        for b in batches:
            for doc, n, frame, file in zip(*(c.to_pylist() for c in b.columns)):
                held.append((doc, n, frame))
                size += len(frame)
                if size >= SHARD_BYTES or len(held) >= SHARD_DOCS:
                    yield shut()
                    held, size, shard = [], 0, shard + 1
        if held:
            yield shut()

    map_arrow(dealt, pack, "file int, shard int, first_doc_id bigint, last_doc_id bigint, n_docs bigint, n_ids bigint, blob binary").write.parquet(path)


def _dictionaries(spark: SparkSession, path: str) -> dict[str, bytes]:
    return {r[0]: bytes(r[1]) for r in spark.read.parquet(f"{path}_dict").collect()}


def shard_starts(shards: DataFrame) -> DataFrame:
    """(file, shard, start): ids in all shards before.  Totals by file first (as many rows as files),
    then within each file, so no task orders all shards."""
    by_file = shards.groupBy("file").agg(F.sum("n_ids").alias("n"))
    before = by_file.select("file", F.coalesce(F.sum("n").over(
        Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("file_start"))
    inside = F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("file").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (shards.select("file", "shard", inside.alias("inside")).join(before, "file")
            .select("file", "shard", (F.col("file_start") + F.col("inside")).alias("start")))


def read_token_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Every document from the files: doc_id, start (ids of all documents before it), n_tokens, and its
    ids array<int>, or with ``digest`` the CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    shards, dicts = spark.read.parquet(path), _dictionaries(spark, path)
    known = spark.sparkContext.broadcast(dicts)
    rows = shards.join(shard_starts(shards), ["file", "shard"]).select("start", "blob")

    def each(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start, blob in zip(*(c.to_pylist() for c in b.columns)):
            s = Shard(blob, known.value)
            ids = [s.ids(k) for k in range(len(s.n_ids))]
            n = s.n_ids.astype(np.int64)
            last = (pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()) if digest
                    else pa.array([i.astype("<i4") for i in ids], pa.list_(pa.int32())))
            yield record(doc_id=pa.array(s.doc_ids, pa.int64(), mask=s.present == 0), start=pa.array(start + np.cumsum(n) - n),
                         n_tokens=pa.array(n), last=last)

    out = map_arrow(rows, lambda batches: (r for b in batches for r in each(b)),
                    "doc_id bigint, start bigint, n_tokens bigint, last " + ("bigint" if digest else "array<int>"))
    return out.withColumnRenamed("last", "ids_crc32" if digest else "ids")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (one list for each row that had this id): a pushed filter finds its shard,
    the offset index its frame; nothing else is decompressed."""
    hit = spark.read.parquet(path).where((F.col("first_doc_id") <= doc_id) & (F.col("last_doc_id") >= doc_id)
                                         | F.col("first_doc_id").isNull() & (F.col("last_doc_id") >= doc_id))
    dicts, out = _dictionaries(spark, path), []
    for r in hit.orderBy("file", "shard").select("blob").toLocalIterator():
        s = Shard(bytes(r[0]), dicts)
        out += [s.ids(int(k)).tolist() for k in np.flatnonzero((s.doc_ids == doc_id) & (s.present == 1))]
    return out
