from pyspark.sql import functions as F

from topicforge.functions import wikitext as W
from topicforge.operators.curate import keep_topics


def cats(spark, text, drop_sort_key=False):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(W.clean_categories(W.extract_categories("t"), drop_sort_key).alias("c")).first()["c"]


def test_extract_categories_cases(spark):
    assert cats(spark, "x [[Category:Law]] y") == ["Law"]
    assert cats(spark, "[[Category:Law|key]]") == ["Lawkey"]          # reference quirk
    assert cats(spark, "[[Category:Law|key]]", drop_sort_key=True) == ["Law"]
    assert cats(spark, "[[Category:A,B]]") == ["AB"]
    assert cats(spark, "[[category:Law]]") == []                      # case-sensitive prefix
    assert cats(spark, "[[Category:La\nw]]") == []                    # not across newlines
    assert cats(spark, "[[Category:Law]][[Category:Law]]") == ["Law", "Law"]
    assert cats(spark, "no links") == []
    assert cats(spark, "[[Category: Padded ]]") == ["Padded"]


def test_keep_topics_drops_empty_rows(spark):
    df = spark.createDataFrame([(1, ["Law", "Law", "Nope"]), (2, ["Nope"]), (3, [])], "id int, categories array<string>")
    out = {r["id"]: r["categories"] for r in keep_topics(df).collect()}
    assert out == {1: ["Law", "Law"]}


def test_strip_markup(spark):
    src = ("'''Bold''' and ''it'' [[Link|shown]] [[Plain]] {{tmpl|{{inner}}}} "
           "<ref>cite</ref>[http://x.org site] &amp; &lt;b&gt;<!-- c -->\n== Head ==\n"
           "[[File:a.png|thumb|[[nested]] cap]]end")
    df = spark.createDataFrame([(src,)], "t string")
    got = df.select(W.strip_markup("t").alias("s")).first()["s"]
    assert got == "Bold and it shown Plain  site & <b>\nHead\nend"


# (markup, what is left), written by hand
NESTED = [
    ("a{{1{{2{{3{{4{{5{{6}}}}}}}}}}}}b", "ab"),
    ("a{{x|{{{1}}}}}b", "ab"),
    ("open {{ never closed {{t}} end", "open {{ never closed  end"),
    ("closed }} only", "closed }} only"),
    ("x{|\n|a\n{|\n|in\n|}\n|}y", "xy"),
    ("x{|\n|{{t|{{u}}}}\n|}y", "xy"),
    ("{single} { { }", "{single} { { }"),
    ("&eacute;&#8217;&#x27;&rsquo;&hellip;&nbsp;&amp;lt;&bogus;", "\u00e9\u2019'\u2019\u2026\u00a0&lt;&bogus;"),
    ("", ""),
    (None, None),
]


def test_nested_markup_and_references(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(NESTED)], "k int, t string")
    got = {r["k"]: r["s"] for r in df.select("k", W.strip_markup("t").alias("s")).collect()}
    assert [got[k] for k in range(len(NESTED))] == [left for _, left in NESTED]


def test_a_long_deep_template_is_removed(spark):
    text = "a" + "{{x" * 5000 + "}}" * 5000 + "b"
    assert spark.createDataFrame([(text,)], "t string").select(W.strip_markup("t").alias("s")).first()["s"] == "ab"


def test_html_references_and_markers(spark):
    from topicforge.functions import html as H

    page = "<title>Caf&eacute; &#8217;&#x27;</title><p>one \x01&rsquo;</p><p>two&hellip;"
    r = spark.createDataFrame([(page,)], "t string").select(H.html_title("t").alias("a"), H.html_paragraphs("t").alias("b")).first()
    assert r["a"] == "Caf\u00e9 \u2019'" and r["b"] == "one \u2019 two\u2026"


def test_extract_progress(spark):
    from topicforge.operators.curate import extract_progress

    df = spark.createDataFrame([(1, ["Law"]), (2, []), (3, ["Law", "Life"])], "id int, categories array<string>")
    r = extract_progress(df).first()
    assert (r["pages"], r["hits"]) == (3, 2)


def test_texts_go_to_the_markup_helpers_in_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
        rows = spark.range(0, 3000, 1, 1).select("id", F.concat(F.lit("{{t|{{u}}}}a&amp;"), F.col("id").cast("string")).alias("text"))
        got = rows.select("id", W.strip_markup(F.col("text")).alias("text"))
        assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1024
        assert {r["id"]: r["text"] for r in got.collect()} == {i: f"a&{i}" for i in range(3000)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
