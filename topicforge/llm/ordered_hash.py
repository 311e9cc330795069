"""SHA-256 over the parts of a group in order, for groups of any size.

A hash of a sequence cannot be put together from hashes of its pieces, so each group's bytes pass through
one hash state; what is spread over the cluster is everything before: parts are sorted by range, packed
into rows of many parts, and only packed rows go, in order, to the one task that hashes them as they
stream by.  No task holds a group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.batches import map_arrow

#: Bytes of parts that one packed row takes, about.
PACK_BYTES = 1 << 16


def packed(rows: DataFrame, key: list[str], order: str, part: str, between: bytes) -> DataFrame:
    """Parts (strings or binaries) of equal ``key`` (bigints) joined by ``between`` in the order of the
    bigint ``order``, which no two parts of a key share: key, order of the first part, packed binary.  A key
    with many parts has many rows."""
    n = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, size = None, None, [], 0
        out: list[tuple] = []

        def emit() -> pa.RecordBatch:
            columns = [pa.array([r[0][i] for r in out], pa.int64()) for i in range(n)]
            made = pa.RecordBatch.from_arrays([*columns, pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.binary())], [*key, order, part])
            out.clear()
            return made

        waiting = 0
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for *k, at, text in zip(*columns):
                if (k != now or size > PACK_BYTES) and held:
                    out.append((now, first, between.join(held)))
                    waiting += size
                    held, size = [], 0
                if not held:
                    now, first = k, at
                held.append(text)
                size += len(text) + 1
                if waiting > 1 << 22 or len(out) > 1 << 14:
                    yield emit()
                    waiting = 0
        if held:
            out.append((now, first, between.join(held)))
        if out:
            yield emit()

    one = rows.select(*key, order, F.col(part).cast("binary").alias(part))
    dealt = one.repartitionByRange(*key, order).sortWithinPartitions(*key, order)
    return map_arrow(dealt, run, ", ".join(f"{c} bigint" for c in [*key, order]) + f", {part} binary")


def hashed(rows: DataFrame, key: list[str], order: str, part: str, between: bytes, name: str) -> DataFrame:
    """key and, as ``name``, the lowercase hex SHA-256 of the key's parts joined by ``between`` in order."""
    n = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []

        def emit() -> pa.RecordBatch:
            columns = [pa.array([k[i] for k, _ in done], pa.int64()) for i in range(n)]
            made = pa.RecordBatch.from_arrays([*columns, pa.array([s for _, s in done], pa.string())], [*key, name])
            done.clear()
            return made

        for b in batches:
            for *k, _, text in zip(*[c.to_pylist() for c in b.columns]):
                if k != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = k, hashlib.sha256(text)
                else:
                    state.update(between)
                    state.update(text)
            if done:
                yield emit()
        if state is not None:
            done.append((now, state.hexdigest()))
            yield emit()

    dealt = rows.select(*key, order, part).repartition(*key).sortWithinPartitions(*key, order)
    return map_arrow(dealt, run, ", ".join(f"{c} bigint" for c in key) + f", {name} string")
