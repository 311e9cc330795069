"""Operator inputs derived from the driver tables.

The driver data has no encyclopedia, so each operator's input is
derived from a driver table by plain DataFrame expressions; the
operators themselves are unchanged.  Everything here is a narrow
projection or a small join, so its cost grows linearly with the tables.

The derivation rules (mirrored in the SQL oracle):

* wiki text  = documents.text + category-link lines picked from the
  taxonomy by ``doc_id``; some with a sort key, some with a comma, one
  outside the taxonomy, some pages with no taxonomy link at all.
* title      = first five words of the text.
* summary    = null when ``id % 3 = 0``, empty when ``id % 6 = 1``,
  otherwise the first sentence.
* category graph: roots ``R<region>`` -> ``N<nation>`` -> ``S<supplier>``
  plus the edge ``N1 -> R1`` (a cycle); pages are the distinct
  ``(S<l_suppkey>, l_partkey)`` of lineitem lines numbered 1.
* logits     = the first 40 embedding dims (teacher) / dims 25-64
  (student); true topics = topic ``label`` plus topic ``label + 10``
  when ``vec_id % 5 = 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicforge.functions.text import WS, java, lead_sentences
from topicforge.session import read_table
from topicforge.taxonomy import NUM_TOPICS, topic_array


def _spaced_topic(idx: Column) -> Column:
    return F.get(topic_array(spaced=True), F.pmod(idx, F.lit(NUM_TOPICS)).cast("int"))


def category_lines(doc_id: Column) -> Column:
    """The appended ``[[Category:...]]`` lines for one page."""
    def link(name: Column) -> Column:
        return F.concat(F.lit("\n[[Category:"), name, F.lit("]]"))

    none = F.lit("")
    return F.concat(
        F.when(doc_id % 6 != 0, link(_spaced_topic(doc_id * 7))).otherwise(none),
        F.when(doc_id % 4 == 1, link(F.concat(_spaced_topic(doc_id * 7 + 1), F.lit("|Key")))).otherwise(none),
        link(F.concat(F.lit("Topic "), (doc_id % 17).cast("string"))),
        F.when(doc_id % 4 == 2, link(_spaced_topic(doc_id * 7 + 3))).otherwise(none),
        F.when(doc_id % 10 == 3, link(F.concat(_spaced_topic(doc_id * 3), F.lit(",")))).otherwise(none),
    )


NON_WS = "[^" + WS[1:]


def first_words(text: Column, n: int = 5) -> Column:
    """The first ``n`` whitespace-separated words, joined by one space
    (an anchored match: only the words needed are scanned)."""
    head = F.regexp_extract(text, java("^" + WS + "*(" + NON_WS + "+(?:" + WS + "+" + NON_WS + f"+){{0,{n - 1}}})"), 1)
    return F.regexp_replace(head, java(WS + "+"), " ")


def stored_summary(key: Column, text: Column) -> Column:
    return (
        F.when(key % 3 == 0, F.lit(None).cast("string"))
        .when(key % 6 == 1, F.lit(""))
        .otherwise(lead_sentences(text, 1))
    )


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, title, ns, text (wiki text) -- one row per document."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("page_id"),
        first_words(F.col("text")).alias("title"),
        F.lit(0).alias("ns"),
        F.concat(F.col("text"), category_lines(F.col("doc_id"))).alias("text"),
    )


def nested_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, text: the wiki text with templates and a table nested
    ``page_id % 9`` deep, a note, links and character references."""
    depth = F.col("page_id").cast("int") % 9
    nested = F.concat(F.repeat(F.lit("{{t|x {{{1|}}} "), depth), F.lit("{{in}}"), F.repeat(F.lit("}}"), depth))
    table = F.concat(F.repeat(F.lit("{|\n| a "), depth), F.repeat(F.lit("\n|}"), depth))
    marked = F.concat(
        F.col("text"), F.lit("\n''Caf&eacute;'' "), F.when(depth > 0, F.lit("it&rsquo;s [[A|b]] ")).otherwise(F.lit("&#8217;&#x27;&hellip;")),
        nested, table, F.lit(" <ref name=n>note {{x}}</ref>[[File:f.png|thumb|a [[b]] c]]&amp;lt; end"))
    return wiki_pages(spark, sf_dir).select("page_id", marked.alias("text"))


def page_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump-shaped pages: one revision holding the wiki text."""
    w = wiki_pages(spark, sf_dir)
    rev = F.struct(
        (F.col("page_id") * 10 + 1).alias("rev_id"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.col("text").alias("text"),
    )
    return w.select("page_id", "title", "ns", F.array(rev).alias("revisions"))


def category_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    supplier = read_table(spark, sf_dir, "supplier")
    e1 = nation.select(
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("parent"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("child"),
    )
    e2 = supplier.select(
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("parent"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("child"),
    )
    cycle = spark.createDataFrame([("N1", "R1")], "parent string, child string")
    return e1.unionByName(e2).unionByName(cycle)


def category_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = read_table(spark, sf_dir, "region")
    return region.select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("root"))


def category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return (
        li.select(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("category"),
            F.col("l_partkey").alias("page_id"),
        )
        .distinct()
    )


def category_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category-member listing: (category, ns, pageid, title) with
    ns MAIN for pages and CATEGORY for subcategories."""
    edges = category_edges(spark, sf_dir)
    pages = category_pages(spark, sf_dir)
    sub = edges.select(
        F.concat(F.lit("Category:"), F.col("parent")).alias("category"),
        F.lit("CATEGORY").alias("ns"),
        F.lit(None).cast("long").alias("pageid"),
        F.concat(F.lit("Category:"), F.col("child")).alias("title"),
    )
    main = pages.select(
        F.concat(F.lit("Category:"), F.col("category")).alias("category"),
        F.lit("MAIN").alias("ns"),
        F.col("page_id").alias("pageid"),
        F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"),
    )
    return sub.unionByName(main)


def page_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, title, summary (stored, may be null/empty), text for every part."""
    part = read_table(spark, sf_dir, "part")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    j = part.join(docs, part.p_partkey == docs.doc_id, "left")
    text = F.coalesce(F.col("text"), F.col("p_name"))
    return j.select(
        F.col("p_partkey").alias("page_id"),
        F.col("p_name").alias("title"),
        stored_summary(F.col("p_partkey"), text).alias("summary"),
        text.alias("text"),
    )


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as curated pages: page_id, title, summary, text."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("page_id"),
        first_words(F.col("text")).alias("title"),
        stored_summary(F.col("doc_id"), F.col("text")).alias("summary"),
        F.col("text"),
    )


def scored_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, ordinal, logits array<double>[40], student array<double>[40], categories array<string>."""
    e = read_table(spark, sf_dir, "embeddings")
    from topicforge.taxonomy import topic_array as names

    first = F.get(names(), F.col("label"))
    second = F.get(names(), F.col("label") + 10)
    cats = F.when(F.col("vec_id") % 5 == 0, F.array(first, second)).otherwise(F.array(first))
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("vec_id").alias("ordinal"),
        F.slice("embedding", 1, 40).cast("array<double>").alias("logits"),
        F.slice("embedding", 25, 40).cast("array<double>").alias("student"),
        cats.alias("categories"),
    )


def summary_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, system, prediction, reference: lead-1, lead-3 and the extractive
    summary of every document against its whole text, a sentence a line."""
    from topicforge.functions.text import bind
    from topicforge.operators.summary import sentences_and_summary

    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    j = sentences_and_summary(d, "id", "text", sep="\n")

    def rows(sents: Column) -> Column:
        predictions = {"lead1": F.array_join(F.slice(sents, 1, 1), "\n"), "lead3": F.array_join(F.slice(sents, 1, 3), "\n"), "summarise": F.col("summary")}
        return F.struct(F.array_join(sents, "\n").alias("reference"),
                        F.array(*[F.struct(F.lit(k).alias("system"), v.alias("prediction")) for k, v in predictions.items()]).alias("p"))

    made = j.select("id", bind(F.col("sents"), rows).alias("x"))
    return made.select("id", F.col("x.reference").alias("reference"), F.explode("x.p").alias("p")).select("id", "p.system", "p.prediction", "reference")
