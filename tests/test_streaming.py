import random

from pyspark.sql import functions as F

from topicforge.operators.graph import merge_labels
from topicforge.streaming import ingest as ST


def replay(df, path, files):
    """Arrivals in ``seq`` order as so many files, one after the other."""
    n = df.count()
    for k in range(files):
        df.where((F.col("seq") >= k * n // files) & (F.col("seq") < (k + 1) * n // files)).coalesce(1).write.mode("append").parquet(path)


def discoveries(spark):
    rows = [(1, "R1", 0), (1, "R1", 1), (2, "R1", 2), (1, "R2", 3), (3, "R1", 4), (4, "R1", 5),
            (2, "R2", 6), (5, "R1", 7), (1, "R1", 8)]
    return spark.createDataFrame(rows, "page_id long, root string, seq long")


def test_merge_labels_stream_equals_batch(spark):
    d = discoveries(spark)
    base = ST.work_dir(spark, "t-merge")
    replay(d, f"{base}/in", 3)
    stream = ST.file_stream(spark, f"{base}/in", d.schema, 1)
    ST.stream_merge_labels(stream.select("page_id", "root"), f"{base}/out", f"{base}/ck")
    got = {r["page_id"]: r["categories"] for r in ST.merged_labels_state(spark, f"{base}/out").collect()}
    expect = {r["page_id"]: r["categories"] for r in merge_labels(d).collect()}
    assert got == expect
    # restart on the same checkpoint: nothing new, state unchanged
    ST.stream_merge_labels(ST.file_stream(spark, f"{base}/in", d.schema, 1).select("page_id", "root"),
                           f"{base}/out", f"{base}/ck")
    again = {r["page_id"]: r["categories"] for r in ST.merged_labels_state(spark, f"{base}/out").collect()}
    assert again == expect


def test_quota_reached_mid_batch(spark):
    d = discoveries(spark)
    base = ST.work_dir(spark, "t-quota")
    replay(d, f"{base}/in", 3)
    ST.stream_quota(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/out", f"{base}/ck", limit=3)
    got = sorted((r["root"], r["page_id"]) for r in ST.quota_state(spark, f"{base}/out").collect())
    assert got == [("R1", 1), ("R1", 2), ("R1", 3), ("R2", 1), ("R2", 2)]


def test_upsert_stream_replay_safe(spark):
    d = discoveries(spark).select("page_id", F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("title"),
                                  F.array("root").alias("categories"), "seq")
    base = ST.work_dir(spark, "t-upsert")
    replay(d, f"{base}/in", 3)
    ST.stream_upsert(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/tab", f"{base}/ck", fields=("title",))
    got = {r["page_id"]: r["categories"] for r in ST.upserted_table(spark, f"{base}/tab").collect()}
    assert got == {1: ["R1", "R2"], 2: ["R1", "R2"], 3: ["R1"], 4: ["R1"], 5: ["R1"]}


def test_replayed_batch_is_idempotent(spark):
    import glob
    import os

    d = discoveries(spark)
    base = ST.work_dir(spark, "t-replay")
    replay(d, f"{base}/in", 3)
    ST.stream_quota(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/out", f"{base}/ck", limit=3)
    before = sorted(map(tuple, ST.quota_state(spark, f"{base}/out").collect()))
    # simulate a crash after the last batch wrote its output but before it committed
    local = base.replace("file:", "")
    commits = sorted(glob.glob(f"{local}/ck/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    last = commits[-1]
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    ST.stream_quota(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/out", f"{base}/ck", limit=3)
    after = sorted(map(tuple, ST.quota_state(spark, f"{base}/out").collect()))
    assert before == after


def test_upsert_state_does_not_depend_on_batches(spark):
    rows = [(1, "Zed", "first", ["a"], 0), (1, "Abe", None, ["b"], 1), (2, None, "x", ["a"], 2), (2, "B", "y", ["c"], 3),
            (3, "C", None, ["a"], 4), (1, "Cy", "z", ["d"], 5), (3, "A", "w", ["b"], 6)]
    d = spark.createDataFrame(rows, "page_id long, title string, summary string, categories array<string>, seq long")
    expect = {1: ("Zed", "first", ["a", "b", "d"]), 2: (None, "x", ["a", "c"]), 3: ("C", None, ["a", "b"])}
    for files in (1, 2, 7):
        base = ST.work_dir(spark, f"t-upsert-{files}")
        replay(d, f"{base}/in", files)
        ST.stream_upsert(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/tab", f"{base}/ck", fields=("title", "summary"))
        got = {r["page_id"]: (r["title"], r["summary"], r["categories"]) for r in ST.upserted_table(spark, f"{base}/tab").collect()}
        assert got == expect, files


def test_repeated_discoveries_write_nothing(spark):
    d = discoveries(spark)
    base = ST.work_dir(spark, "t-repeat")
    replay(d, f"{base}/in", 1)
    for k in (1, 2):
        d.coalesce(1).write.mode("append").parquet(f"{base}/in")
    ST.stream_merge_labels(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/out", f"{base}/ck")
    assert ST._batches(spark, f"{base}/out") == [0]
    assert {r["page_id"]: r["categories"] for r in ST.merged_labels_state(spark, f"{base}/out").collect()} == {
        r["page_id"]: r["categories"] for r in merge_labels(d).collect()}


def folders(spark, path):
    fs, p = ST._fs(spark, path)
    return {f"{v.getPath().getName()}/{b.getPath().getName()}" for v in fs.listStatus(p) if v.isDirectory()
            for b in fs.listStatus(v.getPath()) if b.isDirectory()}


def test_upsert_writes_only_the_buckets_of_a_batch(spark):
    rows = [(k, f"t{k}", ["a"], k) for k in range(200)] + [(7, "later", ["b"], 200)] + [(8, "later", ["c"], 201)] + [(300, "new", ["d"], 202)]
    d = spark.createDataFrame(rows, "page_id long, title string, categories array<string>, seq long")
    base = ST.work_dir(spark, "t-buckets")
    for lo, hi in ((0, 200), (200, 201), (201, 202), (202, 203)):
        d.where(f"seq >= {lo} AND seq < {hi}").coalesce(1).write.mode("append").parquet(f"{base}/in")

    def run():
        ST.stream_upsert(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/tab", f"{base}/ck", fields=("title",), buckets=16)

    run()
    got = {r["page_id"]: (r["title"], r["categories"]) for r in ST.upserted_table(spark, f"{base}/tab").collect()}
    assert len(got) == 201 and got[7] == ("t7", ["a", "b"]) and got[8] == ("t8", ["a", "c"]) and got[300] == ("new", ["d"])
    assert ST.manifest_versions(spark, f"{base}/tab") == [2, 3]
    last, before = ST._manifest(spark, f"{base}/tab", 3), ST._manifest(spark, f"{base}/tab", 2)
    assert sum(v == 3 for v in last.values()) == 1 and sum(v == 2 for v in before.values()) == 1
    assert folders(spark, f"{base}/tab/data") == {f"v={v}/bucket={k}" for m in (last, before) for k, v in m.items()}
    replayed(f"{base}/ck")
    run()
    assert ST._manifest(spark, f"{base}/tab", 3) == last
    assert {r["page_id"]: (r["title"], r["categories"]) for r in ST.upserted_table(spark, f"{base}/tab").collect()} == got


def replayed(checkpoint):
    """As after a crash once the last batch wrote its output and before it was committed."""
    import glob
    import os

    last = max(glob.glob(f"{checkpoint.replace('file:', '')}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_quota_does_not_depend_on_batches_or_salts(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(60) if rng.random() < 0.5 else rng.randrange(5), rng.choice(["hot", "hot", "hot", "R2", "R3"]), k) for k in range(400)]
    rows += [(None, "hot", 400), (1, None, 401)]
    d = spark.createDataFrame(rows, "page_id long, root string, seq long")
    first = {}
    for p, r, s in rows:
        if p is not None and r is not None:
            first.setdefault((r, p), s)
    expect = sorted((r, p, s) for root in ("hot", "R2", "R3") for (r, p), s in sorted(((k, s) for k, s in first.items() if k[0] == root), key=lambda x: x[1])[:12])
    for files, salts in ((1, 1), (5, 4)):
        base = ST.work_dir(spark, f"t-quota-{files}")
        replay(d, f"{base}/in", files)
        ST.stream_quota(ST.file_stream(spark, f"{base}/in", d.schema, 1), f"{base}/out", f"{base}/ck", limit=12, salts=salts)
        assert sorted(map(tuple, ST.quota_state(spark, f"{base}/out").collect())) == expect, files
        assert len(ST._batches(spark, f"{base}/out/held")) <= 2
