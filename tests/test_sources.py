import json
import os
import tempfile

from pyspark.sql import functions as F

from topicforge.operators.curate import latest_revision
from topicforge.operators.splits import train_test_split
from topicforge.plans.extract import run_extract
from topicforge.sources import dumps, files

DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="en">
  <siteinfo><sitename>Test</sitename></siteinfo>
  <page>
    <title>Law page</title>
    <ns>0</ns>
    <id>10</id>
    <revision>
      <id>2</id>
      <timestamp>2020-01-02T00:00:00Z</timestamp>
      <text bytes="60" xml:space="preserve">New text. More.
[[Category:Law]]</text>
    </revision>
    <revision>
      <id>1</id>
      <timestamp>2019-01-01T00:00:00Z</timestamp>
      <text>Old text.
[[Category:Science]]</text>
    </revision>
  </page>
  <page>
    <title>Redirected</title>
    <ns>0</ns>
    <id>11</id>
    <redirect title="Law page" />
    <revision>
      <id>3</id>
      <timestamp>2020-01-01T00:00:00Z</timestamp>
      <text bytes="0" xml:space="preserve" />
    </revision>
  </page>
</mediawiki>
"""


def test_read_page_dump_and_latest(spark, tmp_path):
    p = tmp_path / "dump.xml"
    p.write_text(DUMP)
    pages = dumps.read_page_dump(spark, str(p))
    rows = {r["page_id"]: r for r in pages.collect()}
    assert set(rows) == {10, 11}
    assert rows[11]["redirect"] == "Law page"
    assert len(rows[10]["revisions"]) == 2
    latest = {r["page_id"]: r["text"] for r in latest_revision(pages, "latest").collect()}
    first = {r["page_id"]: r["text"] for r in latest_revision(pages, "first").collect()}
    assert latest[10].startswith("New text") and first[10].startswith("New text")
    assert latest[11] == ""
    out = {r["page_id"]: r for r in run_extract(pages).collect()}
    assert list(out) == [10] and out[10]["categories"] == ["Law"] and out[10]["text"] == "New text. More."


SQL = (
    "-- dump\n"
    "INSERT INTO `categorylinks` VALUES (1,'Law','it''s',-5),(2,'A, (b)','x\\'y',NULL),"
    "(3,'back\\\\slash','',7);\n"
    "INSERT INTO `other` VALUES (9,'no',1,1);\n"
    "INSERT INTO `categorylinks` VALUES (4,'Nl\\nhere','z',0);\n"
)


def test_read_sql_dump(spark, tmp_path):
    p = tmp_path / "d.sql"
    p.write_text(SQL)
    cols = [("id", "bigint"), ("cat", "string"), ("note", "string"), ("n", "int")]
    rows = {r["id"]: r for r in dumps.read_sql_dump(spark, str(p), "categorylinks", cols).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[1]["n"] == -5
    assert rows[2]["cat"] == "A, (b)" and rows[2]["note"] == "x'y" and rows[2]["n"] is None
    assert rows[3]["cat"] == "back\\slash" and rows[3]["note"] == ""
    assert rows[4]["cat"] == "Nl\nhere"


def test_extract_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'T "q"', ["Law", "Science"], "Line one.\nLine, two.")],
                               "page_id long, title string, categories array<string>, text string")
    out = str(tmp_path / "csv")
    files.write_extract_csv(df, out)
    back = files.read_extract_csv(spark, out).first()
    assert back["Page ID"] == 1 and back["Page Title"] == 'T "q"'
    assert back["Categories"] == "Law,Science" and back["Page Text"] == "Line one.\nLine, two."


def test_dataset_round_trip_and_slice(spark, tmp_path):
    df = spark.range(0, 200).select(F.col("id").alias("page_id"), F.lit("t").alias("title"))
    ds = train_test_split(df, "page_id", 0.1)
    out = str(tmp_path / "ds")
    files.write_dataset(ds, out)
    train = files.read_dataset(spark, out, "train")
    test = files.read_dataset(spark, out, "test")
    assert train.count() + test.count() == 200
    first = files.read_dataset(spark, out, "train", percent=10)
    n = train.count()
    ids = sorted(r["page_id"] for r in first.collect())
    assert len(ids) == round(n * 0.1)
    assert ids == sorted(r["page_id"] for r in train.orderBy("page_id").limit(len(ids)).collect())


def test_html_error_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>x</p>", 200), (2, "v", "", 404)],
                               "page_id long, url string, html string, status int")
    ok, bad = files.read_html_pages(df)
    assert [r["page_id"] for r in ok.collect()] == [1]
    assert [r["page_id"] for r in bad.collect()] == [2]


def test_large_percent_slice_uses_dense_ordinal(spark):
    from topicforge.operators.splits import dense_ordinal, percent_slice

    n = 200_000  # wide rows in several partitions, where counts and rows could be planned apart
    df = spark.range(0, n, 1, 7).select((F.col("id") * 3).alias("k"), F.repeat(F.md5(F.col("id").cast("string")), 8).alias("wide"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("16", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            half = percent_slice(df, "k", 50).agg(F.count("*"), F.countDistinct("k"), F.max("k")).first()
            assert tuple(half) == (n // 2, n // 2, 3 * (n // 2 - 1))
            assert percent_slice(df, "k", 0.001).count() == 2
            o = dense_ordinal(df, "k").agg(F.count("*"), F.countDistinct("ordinal"), F.max(F.abs(F.col("ordinal") * 3 - F.col("k")))).first()
            assert tuple(o) == (n, n, 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sql_dump_long_values_forms_and_errors(spark, tmp_path):
    import pytest

    big, escapes = "x" * 1_000_000, "\\'" * 200_000
    (tmp_path / "a.sql").write_text(
        "/* head */;\n-- c\nINSERT INTO `t` (`a`, `b`)\nVALUES\n(1,'" + big + "'),\n(2,'" + escapes + "');\n"
        "insert into t values (3,'a\\0b\\Zc\\%d\\\\n');\nINSERT INTO `t2` VALUES (9,'no');\n")
    rows = {r["a"]: r["b"] for r in dumps.read_sql_dump(spark, str(tmp_path / "a.sql"), "t", [("a", "int"), ("b", "string")]).collect()}
    assert rows == {1: big, 2: "'" * 200_000, 3: "a\0b\x1ac\\%d\\n"}
    (tmp_path / "b.sql").write_text("INSERT INTO `t` SELECT * FROM u;\n")
    with pytest.raises(Exception, match="not a plain INSERT"):
        dumps.read_sql_dump(spark, str(tmp_path / "b.sql"), "t", [("a", "int")]).collect()


MIXED = (
    "LOCK TABLES `t` WRITE;INSERT INTO `t` VALUES (1,'a;b'),(2,'c;\nd');\r\n"
    "-- it's a comment; with a quote\r\n/* ; ' */ INSERT INTO `t` VALUES\r\n(3,'e\\'f;\\\\');INSERT INTO `u` VALUES (9,'no;');\r\n"
    "# another ' one\nINSERT INTO `t` VALUES (4,'x--y'),(5,'/* no comment */'),(6,'line\r\nend\\\nsame');\n"
    "INSERT INTO `t` VALUES (7,'\"'),(8,'`;`'),(9,'it''s; fine'); INSERT INTO `t` VALUES (10,'')")


def test_sql_statements_end_outside_quotes_only(spark, tmp_path):
    import pytest

    (tmp_path / "m.sql").write_bytes(MIXED.encode())
    want = {1: "a;b", 2: "c;\nd", 3: "e'f;\\", 4: "x--y", 5: "/* no comment */", 6: "line\r\nend\nsame", 7: '"', 8: "`;`", 9: "it's; fine", 10: ""}
    columns = [("a", "int"), ("b", "string")]
    read = lambda: {r["a"]: r["b"] for r in dumps.read_sql_dump(spark, str(tmp_path / "m.sql"), "t", columns).collect()}
    assert read() == want
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("7b", "23b", "90b"):  # values, comments and statements that cross splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            assert read() == want, size
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    (tmp_path / "open.sql").write_text("INSERT INTO `t` VALUES (1,'a);\n")
    with pytest.raises(Exception, match="ends inside"):
        dumps.read_sql_dump(spark, str(tmp_path / "open.sql"), "t", columns).collect()
    (tmp_path / "none.sql").write_text("")
    assert dumps.read_sql_dump(spark, str(tmp_path / "none.sql"), "t", columns).count() == 0


def test_pages_that_cannot_be_read_are_kept_aside(spark, tmp_path):
    page = "<page><title>T{0}</title><ns>0</ns><id>{1}</id><revision><id>{0}</id><timestamp>{2}</timestamp><text>x {0}</text></revision></page>\n"
    day = "2020-01-02T00:00:00Z"
    no_id = "<page><title>none</title><ns>0</ns></page>\n"
    (tmp_path / "p.xml").write_text("<mediawiki>" + page.format(1, 1, day) + page.format(2, "two", day) + page.format(3, 3, day) + no_id
                                    + page.format(4, 4, "then") + page.format(5, 5, day) + "</mediawiki>")
    good, bad = dumps.page_dump_parts(spark, str(tmp_path / "p.xml"))
    assert {r["page_id"]: (r["ns"], r["revisions"][0]["rev_id"], r["revisions"][0]["text"], str(r["revisions"][0]["ts"])[:10]) for r in good.collect()} == {
        k: (0, k, f"x {k}", "2020-01-02") for k in (1, 3, 5)}
    raw = {json.loads(r["raw"])["title"]: json.loads(r["raw"]) for r in bad.collect()}
    assert set(raw) == {"T2", "T4", "none"} and raw["T2"]["id"] == "two" and raw["T2"]["revision"][0]["text"]["_VALUE"] == "x 2"
    assert {r["page_id"] for r in dumps.read_page_dump(spark, str(tmp_path / "p.xml")).collect()} == {1, 3, 5}


def test_first_rows_by_selection(spark, monkeypatch):
    import random

    from topicforge.operators import splits as SP

    rng = random.Random(1)
    wide = [rng.choice([-2**63, 2**63 - 1, 0, 5, 5, 5, rng.randrange(-2**62, 2**62)]) for _ in range(300)] + [None] * 4
    for bins in (4096, 3):
        monkeypatch.setattr(SP, "BINS", bins)
        df = spark.createDataFrame([(v, i // 3, "x") for i, v in enumerate(wide)], "key long, row int, k string").repartition(5)
        order = sorted(wide, key=lambda v: (v is not None, v or 0))
        for k in (0, 1, 4, 5, 60, 150, 200, 303, 304, 900):
            got = [r["key"] for r in SP.first_rows(df, "key", k).collect()]
            assert sorted(got, key=lambda v: (v is not None, v or 0)) == order[:k], k
    # the boundary's rows are the same on any partitioning; equal rows are taken as often as is due
    some = sorted(map(tuple, SP.first_rows(df, "key", 150).collect()), key=str)
    assert some == sorted(map(tuple, SP.first_rows(df.coalesce(1), "key", 150).collect()), key=str)
    same = spark.createDataFrame([(7, "a")] * 20, "key int, k string")
    assert SP.first_rows(same, "key", 6).count() == 6 and SP.first_rows(same.limit(0), "key", 6).count() == 0
