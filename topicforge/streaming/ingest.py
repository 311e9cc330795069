"""Streaming corpus ingestion.

The reference grows its page table from a queue of discoveries.  Here
discoveries arrive as a Structured Streaming source, and each sink is a
``foreachBatch`` that writes the batch's result under its ``batch_id``:
a batch replayed after a failure overwrites its own output, so the end
state is exactly-once.  Offsets and state live under the query's
checkpoint location (shared storage), so a lost executor or driver
restart resumes where it stopped.

* F1 ``stream_merge_labels``: running set of roots per page.  Repeated
  discoveries end in the state of a streaming ``dropDuplicates`` and write
  nothing (no watermark is needed because there is no event time).
* F2 ``stream_upsert``: page table in hash buckets with a manifest per
  version; a batch rewrites the buckets it touches.
* F3 ``stream_quota``: per-root quota in arrival order, with what is known
  kept in keyed state.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from topicforge.operators.graph import upsert_pages
from topicforge.operators.skew import top_k_per_group
from topicforge.session import ensure_checkpoint_dir


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run, under the shared checkpoint root."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet folder as a stream; ``files_per_trigger`` bounds a micro-batch, by default it takes all
    files that have arrived."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def _run(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# ------------------------------------------------------------------ F1


def stream_merge_labels(stream: DataFrame, out: str, checkpoint: str, key: str = "page_id",
                        label: str = "root") -> None:
    """Maintain page -> sorted set of roots.  Update mode: each batch
    writes only the pages whose set it changed, under
    ``out/batch_id=<id>``; a batch of known pairs writes nothing."""
    agg = stream.select(key, label).dropDuplicates([key, label]).groupBy(key).agg(F.array_sort(F.collect_set(F.col(label))).alias("categories"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        changed = batch.persist()
        try:
            if not changed.isEmpty():
                changed.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            changed.unpersist()

    _run(agg.writeStream.outputMode("update").foreachBatch(sink), checkpoint)


def merged_labels_state(spark: SparkSession, out: str, key: str = "page_id") -> DataFrame:
    """Current state of F1: each page's set from its latest batch."""
    if not _exists(spark, out):
        return spark.createDataFrame([], f"{key} long, categories array<string>")
    rows = spark.read.parquet(out)
    return rows.groupBy(key).agg(F.max_by("categories", "batch_id").alias("categories"))


# ------------------------------------------------------------------ F2


def stream_upsert(stream: DataFrame, table: str, checkpoint: str, key: str = "page_id",
                  fields: tuple[str, ...] = ("title", "summary", "text"), order: str = "seq", buckets: int = 64) -> None:
    """Upsert each micro-batch into a table of hash buckets of ``key``.

    A batch reads and writes only the buckets it touches, under
    ``table/data/v=<batch>/bucket=<k>``; ``table/manifest/v=<batch>`` then
    says for every bucket which version holds it, and is the commit.  The
    manifest before is kept, so a replayed batch starts from the same
    buckets and writes the same version; what only older manifests name is
    removed.  ``buckets`` is fixed for a table: choose it so that a bucket
    suits a task.

    The table keeps each page's smallest ``order``: a page holds the fields
    of its first arrival whichever micro-batch brought it, so the end state
    does not depend on how arrivals fall into batches."""
    spark = stream.sparkSession
    fields = (order, *fields)

    def sink(batch: DataFrame, batch_id: int) -> None:
        incoming = batch.select(key, *fields, "categories").withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r[0] for r in incoming.select("bucket").distinct().collect()]  # at most ``buckets``
            done = [v for v in manifest_versions(spark, table) if v < batch_id]
            known = _manifest(spark, table, done[-1]) if done else {}
            rows = incoming.drop("bucket")
            paths = [f"{table}/data/v={known[k]}/bucket={k}" for k in touched if k in known]
            if paths:
                rows = spark.read.schema(rows.schema).parquet(*paths).unionByName(rows)
            if touched:
                merged = upsert_pages(rows.limit(0), rows, key, fields, order=order)
                merged = merged.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
                merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table}/data/v={batch_id}")
            new = {**known, **dict.fromkeys(touched, batch_id)}
            spark.createDataFrame(sorted(new.items()), "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(
                f"{table}/manifest/v={batch_id}")
            _drop_versions(spark, table, done, known)
        finally:
            incoming.unpersist()

    _run(stream.writeStream.foreachBatch(sink), checkpoint)


def manifest_versions(spark: SparkSession, table: str) -> list[int]:
    """Committed versions that are still there, ascending: three at most."""
    fs, p = _fs(spark, f"{table}/manifest")
    if not fs.exists(p):
        return []
    names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(p)]
    return sorted(int(n[2:]) for n, path in names if n.startswith("v=") and _exists(spark, f"{path}/_SUCCESS"))


def _manifest(spark: SparkSession, table: str, version: int) -> dict[int, int]:
    """Bucket -> version that holds it; one entry a bucket."""
    rows = spark.read.schema("bucket int, version long").parquet(f"{table}/manifest/v={version}").collect()
    return {r["bucket"]: r["version"] for r in rows}


def _drop_versions(spark: SparkSession, table: str, done: list[int], kept: dict[int, int]) -> None:
    """Remove what only manifests before the last of ``done`` name (``kept`` is that last one)."""
    for old in done[:-1]:
        gone = {(k, v) for k, v in _manifest(spark, table, old).items() if kept.get(k) != v}
        for k, v in gone:
            _delete(spark, f"{table}/data/v={v}/bucket={k}")
        _delete(spark, f"{table}/manifest/v={old}")


def upserted_table(spark: SparkSession, table: str) -> DataFrame:
    """The table as its last manifest names it."""
    done = manifest_versions(spark, table)
    if not done:
        raise ValueError(f"{table} has no committed version")
    paths = [f"{table}/data/v={v}/bucket={k}" for k, v in sorted(_manifest(spark, table, done[-1]).items())]
    return spark.read.parquet(*paths)


# ------------------------------------------------------------------ F3


def _first_pages(key: str, label: str, order: str, limit: int):
    """For one (root, salt): of the pages not known yet, the first by arrival, as long as the salt holds
    fewer than ``limit``.  Memory and state hold ``limit`` pages at most."""

    def known_and_new(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        root, salt = group
        held = list(state.get[0]) if state.exists else []
        known, room = set(held), limit - len(held)
        first: dict[int, int] = {}

        def best() -> list[tuple[int, int]]:
            return heapq.nsmallest(room, ((o, p) for p, o in first.items()))

        for part in parts:
            if room <= 0:
                continue  # all parts must be read
            for p, o in zip(part[key].tolist(), part[order].tolist()):
                if p not in known and o < first.get(p, o + 1):
                    first[p] = o
            if len(first) > 4 * limit + 1024:
                first = {p: o for o, p in best()}
        new = best() if room > 0 else []
        if new:
            state.update((held + [p for _, p in new],))
            yield pd.DataFrame({label: [root] * len(new), key: [p for _, p in new], order: [o for o, _ in new]})

    return known_and_new


def stream_quota(stream: DataFrame, out: str, checkpoint: str, limit: int, key: str = "page_id",
                 label: str = "root", order: str = "seq", salts: int = 16) -> None:
    """Accept pages per root in arrival order until each root holds ``limit`` distinct pages.

    Known pages live in Spark's keyed state, one group a root and salt of the page, so a root with very
    many arrivals is spread over ``salts`` tasks; a group gives out its first ``limit`` pages and no more,
    as no later one can be among the root's first.  Each batch ranks what the groups gave out (salted top-k)
    and keeps ``limit - held`` a root.  ``out`` gets the accepted rows under ``rows/batch_id=<id>`` and one
    row a root, what it holds, under ``held/batch_id=<id>``; a batch reads the last of these and no rows.
    A root is a string; rows with a null root or page are left out."""
    spark = stream.sparkSession
    arrivals = stream.select(F.col(label).cast("string").alias(label), F.col(key).cast("bigint").alias(key), F.col(order).cast("bigint").alias(order))
    arrivals = arrivals.where(F.col(label).isNotNull() & F.col(key).isNotNull()).withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts)).cast("int"))
    schema = f"{label} string, {key} bigint, {order} bigint"
    firsts = arrivals.groupBy(label, "_salt").applyInPandasWithState(
        _first_pages(key, label, order, limit), schema, "pages array<bigint>", "update", GroupStateTimeout.NoTimeout)

    def sink(batch: DataFrame, batch_id: int) -> None:
        new = batch.persist()
        try:
            if new.isEmpty():
                return
            ranked = top_k_per_group(new, label, [F.col(order), F.col(key)], limit)
            before = [b for b in _batches(spark, f"{out}/held") if b < batch_id]
            held = spark.createDataFrame([], f"{label} string, held bigint")
            if before:
                held = spark.read.schema(held.schema).parquet(f"{out}/held/batch_id={before[-1]}")
            ranked = ranked.join(held, label, "left")
            rows = f"{out}/rows/batch_id={batch_id}"
            ranked.where(F.col("_rank") <= F.lit(limit) - F.coalesce("held", F.lit(0))).select(label, key, order).write.mode("overwrite").parquet(rows)
            now = spark.read.schema(schema).parquet(rows).groupBy(label).agg(F.count("*").alias("held"))
            held.unionByName(now).groupBy(label).agg(F.sum("held").alias("held")).write.mode("overwrite").parquet(f"{out}/held/batch_id={batch_id}")
            for old in before[:-1]:
                _delete(spark, f"{out}/held/batch_id={old}")
        finally:
            new.unpersist()

    _run(firsts.writeStream.outputMode("update").foreachBatch(sink), checkpoint)


def _batches(spark: SparkSession, path: str) -> list[int]:
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id=") and _exists(spark, f"{path}/{n}/_SUCCESS"))


def quota_state(spark: SparkSession, out: str, key: str = "page_id", label: str = "root",
                order: str = "seq") -> DataFrame:
    """The accepted rows so far."""
    schema = f"{label} string, {key} long, {order} long"
    paths = [f"{out}/rows/batch_id={b}" for b in _batches(spark, f"{out}/rows")]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
