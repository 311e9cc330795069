"""

Each query derives its operator input from the driver tables (see
``topicforge.plans.standins``), runs the library operator over the whole
table, and returns a DataFrame whose columns are aliased to the same
names as the DuckDB oracle SQL.  Arrays are returned as joined strings
and doubles are rounded to 6 places so both engines hash alike.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import sql_oracle as S  # noqa: E402
from topicforge.functions import text as TX  # noqa: E402
from topicforge.functions import wikitext as WK  # noqa: E402
from topicforge.functions import arrays as AR  # noqa: E402
from topicforge.functions import html as HT  # noqa: E402
from topicforge.operators import abbreviations as AB  # noqa: E402
from topicforge.operators import curate  # noqa: E402
from topicforge.operators import encode as EN  # noqa: E402
from topicforge.operators import graph as GR  # noqa: E402
from topicforge.operators import distill as DI  # noqa: E402
from topicforge.operators import rouge as RG  # noqa: E402
from topicforge.operators import scoring as SC  # noqa: E402
from topicforge.operators import model as MO  # noqa: E402
from topicforge.operators import summary as SU  # noqa: E402
from topicforge.plans import evaluate as EV  # noqa: E402
from topicforge.plans import intent as IN  # noqa: E402
from topicforge.sources import dumps, files  # noqa: E402
from topicforge.streaming import ingest as ST  # noqa: E402
from topicforge.taxonomy import TOPICS  # noqa: E402
from topicforge.plans import dataset as DS  # noqa: E402
from topicforge.operators import splits as SP  # noqa: E402
from topicforge.plans import extract as EX  # noqa: E402
from topicforge.plans import standins as SI  # noqa: E402
from topicforge.session import read_table  # noqa: E402

# The training-data operators are an optional part: without them the other queries still work.
try:
    from topicforge.llm import queries as LLM
except ImportError:
    LLM = None
try:
    import corpus_pipeline as PIPELINE
except ImportError:
    PIPELINE = None

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full dump-extract pipeline (C9) at sf0.001."""
    return q_run_extract(spark, SMOKE_DIR)


# ---------------------------------------------------------------- step 1: extract


def _page_topics(spark, sf_dir):
    return EX.page_topics(SI.wiki_pages(spark, sf_dir))


def q_topic_counts(spark, sf_dir):
    return curate.topic_counts(_page_topics(spark, sf_dir))


def q_extract_categories(spark, sf_dir):
    w = SI.wiki_pages(spark, sf_dir)
    cats = WK.clean_categories(WK.extract_categories(F.col("text")))
    return w.select(
        "page_id",
        F.array_join(cats, ",").alias("categories"),
        F.size(cats).cast("bigint").alias("n_categories"),
    )


def q_keep_topics(spark, sf_dir):
    w = SI.wiki_pages(spark, sf_dir).select(
        "page_id", WK.clean_categories(WK.extract_categories(F.col("text"))).alias("categories"))
    kept = curate.keep_topics(w, "categories")
    return kept.select("page_id", F.array_join("categories", ",").alias("categories"))


def q_clean_text(spark, sf_dir):
    w = SI.wiki_pages(spark, sf_dir)
    return w.select("page_id", TX.clean_text(F.col("text")).alias("text"))


def q_lead_sentences(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", TX.lead_sentences(F.col("text"), 5).alias("lead"))


def q_abbreviation_scores(spark, sf_dir):
    a = AB.abbreviation_scores(read_table(spark, sf_dir, "documents"))
    return a.select("word", "n_period", "n_plain", _r6("score").alias("score"))


def q_run_extract(spark, sf_dir):
    out = EX.run_extract(SI.page_dump(spark, sf_dir))
    return out.select("page_id", "title", F.array_join("categories", ",").alias("categories"), "text")


def q_strip_markup(spark, sf_dir):
    w = SI.nested_markup(spark, sf_dir)
    return w.select("page_id", WK.strip_markup(F.col("text")).alias("text"))


def q_extract_progress(spark, sf_dir):
    return curate.extract_progress(_page_topics(spark, sf_dir))


# ---------------------------------------------------------------- step 2: scalars, splits


def _kept_normalised(spark, sf_dir):
    pt = _page_topics(spark, sf_dir)
    return pt.select("page_id", F.transform("categories", TX.normalise_topic).alias("cats"))


def q_page_summary(spark, sf_dir):
    p = SI.doc_pages(spark, sf_dir)
    return p.select("page_id", curate.page_summary("summary", "text", 5).alias("summary"))


def q_members_by_namespace(spark, sf_dir):
    listing = SI.category_members(spark, sf_dir)
    sides = [curate.members_by_namespace(listing, ns).select(
        F.lit(ns).alias("ns"), TX.strip_prefix("category").alias("category"), TX.strip_prefix("title").alias("member"))
        for ns in ("CATEGORY", "MAIN")]
    return sides[0].unionByName(sides[1])


def q_encode_categories(spark, sf_dir):
    k = _kept_normalised(spark, sf_dir)
    return k.select("page_id", TX.encode_categories("cats").alias("categories"))


def q_render_prompt(spark, sf_dir):
    p = SI.doc_pages(spark, sf_dir).withColumn("summary", curate.page_summary("summary", "text", 5))
    return p.select(
        "page_id",
        TX.render_prompt("classify", title="title", summary="summary").alias("classify"),
        TX.render_prompt("title", title="title").alias("title_only"),
        TX.render_prompt("summarize", text="text").alias("summarize"),
    )


def _long_docs(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_id"))
    j = d.join(lab, d.doc_id == lab.l_id, "left")
    return j.select(
        "doc_id",
        F.col("text").alias("chapter"),
        F.when(F.col("l_id").isNotNull(), TX.lead_sentences("text", 1)).alias("summary_text"),
        F.col("n_chars").alias("summary_length"),
    )


def q_filter_long_docs(spark, sf_dir):
    f = curate.filter_long_docs(_long_docs(spark, sf_dir), 1024)
    return f.select("doc_id", "summary_length", "summary_text")


def q_html_title(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", HT.html_title("html").alias("title"))


def q_html_paragraphs(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", HT.html_paragraphs("html").alias("paragraphs"))


def q_page_card(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", HT.html_title("html").alias("title"),
                    HT.page_summary_from_html("html", 10).alias("summary"))


def q_topic_ids(spark, sf_dir):
    w = SI.wiki_pages(spark, sf_dir).select(
        "page_id",
        F.transform(WK.clean_categories(WK.extract_categories(F.col("text"))), TX.normalise_topic).alias("cats"))
    t = EN.topic_ids(w, "page_id", "cats")
    return t.select("page_id", "topic", F.coalesce("topic_id", F.lit(-1)).alias("topic_id"))


def q_multi_hot(spark, sf_dir):
    k = EN.add_multi_hot(_kept_normalised(spark, sf_dir), "cats", "labels")
    return k.select("page_id", F.array_join(F.col("labels").cast("array<string>"), "").alias("labels"))


def _split_docs(spark, sf_dir):
    return SP.train_test_split(SI.doc_pages(spark, sf_dir), "page_id", 0.1)


def q_train_test_split(spark, sf_dir):
    return _split_docs(spark, sf_dir).select("page_id", "split")


def q_split_sizes(spark, sf_dir):
    return SP.split_sizes(_split_docs(spark, sf_dir))


def q_percent_slice(spark, sf_dir):
    train = _split_docs(spark, sf_dir).where(F.col("split") == "train")
    return curate.select_features(SP.percent_slice(train, "page_id", 10), ["page_id", "title"])


def q_assign_batches(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    return SP.assign_batches(e, "vec_id", 8).select("vec_id", "batch")


def q_latest_revision(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return curate.latest_by_key(ev, "user_id", ["ts", "event_id"], ["event_id", "event_type"])


# ---------------------------------------------------------------- step 3: graph, dataset


def quota_for(spark, sf_dir) -> int:
    """Per-root quota, derived from the data: one tenth of the part count
    (200 at sf0.01, 2,000 -- the reference's quota -- at sf0.1)."""
    return max(1, read_table(spark, sf_dir, "part").count() // 10)


def _graph(spark, sf_dir):
    return SI.category_edges(spark, sf_dir), SI.category_roots(spark, sf_dir), SI.category_pages(spark, sf_dir)


def q_category_closure(spark, sf_dir):
    edges, roots, _ = _graph(spark, sf_dir)
    return GR.category_closure(edges, roots, 10)


def _candidates(spark, sf_dir):
    edges, roots, members = _graph(spark, sf_dir)
    return GR.root_pages(GR.category_closure(edges, roots, 10), members)


def q_quota_pages(spark, sf_dir):
    return GR.quota_pages(_candidates(spark, sf_dir), quota_for(spark, sf_dir))


def _hits(spark, sf_dir):
    return GR.quota_pages(_candidates(spark, sf_dir), quota_for(spark, sf_dir))


def q_merge_labels(spark, sf_dir):
    m = GR.merge_labels(_hits(spark, sf_dir))
    return m.select("page_id", F.array_join("categories", ",").alias("categories"))


def q_upsert_pages(spark, sf_dir):
    hits = _hits(spark, sf_dir)
    content = SI.page_content(spark, sf_dir)
    old = GR.merge_labels(hits.where(F.col("root").isin("R0", "R1", "R2"))).join(content, "page_id")
    new = (GR.merge_labels(hits.where(F.col("root").isin("R2", "R3", "R4"))).join(content, "page_id")
           .withColumn("title", F.concat("title", F.lit(" (new)"))))
    up = GR.upsert_pages(old, new)
    return up.select("page_id", "title", "summary", F.array_join("categories", ",").alias("categories"))


def q_visit_counts(spark, sf_dir):
    edges, roots, members = _graph(spark, sf_dir)
    memberships = GR.category_closure(edges, roots, 10).join(members, "category")
    return GR.visit_counts(memberships)


def q_page_categories(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), F.col("p_name").alias("title"))
    return GR.page_categories(part, SI.category_pages(spark, sf_dir)).select("page_id", "title", "category")


def build_dataset_frame(spark, sf_dir):
    edges, roots, members = _graph(spark, sf_dir)
    return DS.build_dataset(edges, members, SI.page_content(spark, sf_dir), roots,
                            limit=quota_for(spark, sf_dir))


def q_build_dataset(spark, sf_dir):
    ds = build_dataset_frame(spark, sf_dir)
    return ds.select("page_id", "title", "summary", F.array_join("categories", ",").alias("categories"), "split")


# ---------------------------------------------------------------- step 4: scoring, metrics


def _r6(c):
    return F.round(c, 6)


def _scored(spark, sf_dir):
    """Stand-in model output with labels, predictions, top-3 and batches."""
    sc = SI.scored_logits(spark, sf_dir)
    sc = EN.add_multi_hot(sc, "categories", "labels")
    sc = SC.add_predictions(sc, "logits")
    sc = SC.top_topics(sc, "logits", 3)
    return SP.assign_batches(sc, "ordinal", 8)


def q_top_topics(spark, sf_dir):
    t = _scored(spark, sf_dir)
    return t.select("id", F.array_join("top_topics", ",").alias("top3"), _r6("p_top1").alias("p_top1"))


def q_binarise(spark, sf_dir):
    t = _scored(spark, sf_dir)
    return t.select("id", F.array_join(F.col("preds").cast("array<string>"), "").alias("preds"))


def q_argmax(spark, sf_dir):
    t = SI.scored_logits(spark, sf_dir)
    return t.select("id", AR.argmax("logits").alias("argmax"))


def q_subset_accuracy(spark, sf_dir):
    a = SC.accuracy_report(_scored(spark, sf_dir))
    return a.select(_r6("accuracy").alias("accuracy"), _r6("batch_mean_accuracy").alias("batch_mean_accuracy"))


def q_bce_loss(spark, sf_dir):
    a = SC.loss_report(_scored(spark, sf_dir))
    return a.select(_r6("loss").alias("loss"), _r6("batch_mean_loss").alias("batch_mean_loss"))


def q_validate_top3(spark, sf_dir):
    v = SC.validate_top3(_scored(spark, sf_dir))
    return v.select("total", "good", "bad", _r6("bad_ratio").alias("bad_ratio"), _r6("ref_ratio").alias("ref_ratio"))


def q_bad_rows(spark, sf_dir):
    return SC.bad_rows(_scored(spark, sf_dir), "id")


def q_intent_vote(spark, sf_dir):
    t = _scored(spark, sf_dir)
    return t.select("id", SC.intent_vote("top_topics").alias("intent"))


def _pairs(spark, sf_dir):
    return SI.summary_pairs(spark, sf_dir)


def _rouge_query(n):
    def q(spark, sf_dir):
        r = RG.rouge_n(_pairs(spark, sf_dir), n)
        return r.select("id", "system", _r6("precision").alias("precision"), _r6("recall").alias("recall"),
                        _r6("f1").alias("f1"))
    return q


def _rouge_l_query(summary_level):
    def q(spark, sf_dir):
        r = RG.rouge_l(_pairs(spark, sf_dir), summary_level=summary_level)
        return r.select("id", "system", _r6("precision").alias("precision"), _r6("recall").alias("recall"),
                        _r6("f1").alias("f1"))
    return q


def q_distillation_loss(spark, sf_dir):
    t = _scored(spark, sf_dir).withColumn(
        "hard", SC.row_bce(F.col("student"), F.col("labels")) / F.size("student"))
    d = DI.distillation_loss(t, teacher="logits", student="student", student_loss="hard",
                             temperature=4.0, alpha=0.5)
    return d.select(_r6("kl").alias("kl"), _r6("loss").alias("loss"))


def q_compare_models(spark, sf_dir):
    t = SI.scored_logits(spark, sf_dir)
    teacher = t.select("id", AR.argmax("logits").alias("pred"))
    student = t.select("id", AR.argmax("student").alias("pred"))
    m = SC.model_agreement(teacher, student)
    return m.select("n", "agree", _r6("agreement").alias("agreement"))


def q_evaluate_summaries(spark, sf_dir):
    e = RG.evaluate_summaries(_pairs(spark, sf_dir), with_lcs=False)
    return e.select("system", "pairs", _r6("rouge1").alias("rouge1"), _r6("rouge2").alias("rouge2"))


def q_rouge_table(spark, sf_dir):
    e = RG.evaluate_summaries(_pairs(spark, sf_dir), with_lcs=True)
    return e.select("system", "pairs", *[_r6(c).alias(c) for c in ("rouge1", "rouge2", "rougeL", "rougeLsum")])


# ---------------------------------------------------------------- step 5: vocabulary, encoding, summaries

VOCAB_SIZE = 1000
MAX_LENGTH = 512


def q_build_vocab(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return EN.build_vocab(d, "text", VOCAB_SIZE)


def q_encode_tokens(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    vocab = EN.build_vocab(d, "text", VOCAB_SIZE)
    enc = EN.encode_tokens(d, "doc_id", "text", vocab, MAX_LENGTH, vocab_rows=VOCAB_SIZE)
    return enc.select(
        "doc_id",
        F.array_join(F.col("input_ids").cast("array<string>"), ",").alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_tokens"),
    )


def q_summarise(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return SU.summarise(d, "doc_id", "text", 120)


# ---------------------------------------------------------------- step 6: models (rows-only checks)

BINARY = ("quality", "toxic")
FIT = {"num_features": 1 << 16, "max_iter": 30}


def _labelled_docs(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id").withColumn("labels", F.array("quality", "toxic"))
    return SP.train_test_split(j, "doc_id", 0.1)


def _with_ordinal(ds):
    test = SP.dense_ordinal(ds.where(F.col("split") == "test"), "doc_id", "ordinal")
    return test


def q_fit_topic_classifier(spark, sf_dir):
    ds = _labelled_docs(spark, sf_dir)
    model = EV.train(ds, "text", "labels", BINARY, **FIT)
    return EV.evaluate(_with_ordinal(ds), model, "text", "labels", "ordinal").select(
        "metric", _r6("value").alias("value"))


def q_score_topics(spark, sf_dir):
    ds = _labelled_docs(spark, sf_dir)
    model = EV.train(ds, "text", "labels", BINARY, **FIT)
    s = MO.score_topics(read_table(spark, sf_dir, "documents"), model, "logits")
    return s.select("doc_id", F.array_join(F.transform("logits", lambda z: F.round(z, 4).cast("string")), ",")
                    .alias("logits"))


def q_fit_student(spark, sf_dir):
    ds = _labelled_docs(spark, sf_dir)
    teacher = EV.train(ds, "text", "labels", BINARY, **FIT)
    train = MO.score_topics(ds.where(F.col("split") == "train"), teacher, "teacher")
    student = MO.fit_student(train, "text", "labels", "teacher", BINARY, alpha=0.5, temperature=1.0,
                             num_features=1 << 12, max_iter=30)
    t = MO.score_topics(read_table(spark, sf_dir, "documents"), teacher, "teacher")
    st = MO.score_topics(t, student, "student")
    both = SC.add_predictions(SC.add_predictions(st, "teacher", out="teacher_pred"), "student", out="student_pred")
    return both.select(
        "doc_id",
        F.array_join(F.col("teacher_pred").cast("array<string>"), "").alias("teacher_pred"),
        F.array_join(F.col("student_pred").cast("array<string>"), "").alias("student_pred"),
    )


def _topic_dataset(spark, sf_dir):
    """Document prompts with the wiki stand-in topics as labels."""
    docs = SI.doc_pages(spark, sf_dir).withColumn("summary", curate.page_summary("summary", "text", 5))
    topics = _kept_normalised(spark, sf_dir)
    return docs.join(topics, "page_id").select(
        "page_id", TX.render_prompt("classify", title="title", summary="summary").alias("prompt"),
        AR.multi_hot("cats").alias("labels"), F.col("cats").alias("categories"))


TOPIC_FIT = {"max_iter": 20, "reg": 1e-3, "strategy": "matrix"}


def topic_model(spark, sf_dir):
    """40-topic classifier trained on all document prompts."""
    return MO.fit_topic_classifier(_topic_dataset(spark, sf_dir), "prompt", "labels", TOPICS, **TOPIC_FIT)


def q_train_evaluate_topics(spark, sf_dir):
    """L3: the 40 topics fitted on the train split; accuracy, loss and top-3 validation on the test split."""
    ds = SP.train_test_split(_topic_dataset(spark, sf_dir), "page_id", 0.1)
    model = EV.train(ds, "prompt", "labels", TOPICS, **TOPIC_FIT)
    test = SP.dense_ordinal(ds.where(F.col("split") == "test"), "page_id", "ordinal")
    return EV.evaluate(test, model, "prompt", "labels", "ordinal", categories="categories").select(
        "metric", _r6("value").alias("value"))


def q_page_intent(spark, sf_dir):
    model = topic_model(spark, sf_dir)
    out = IN.page_intent(read_table(spark, sf_dir, "pages"), model)
    return out.select("page_id", "title", F.array_join("top_topics", ",").alias("top3"), "intent")


# ---------------------------------------------------------------- step 7: streaming

STREAM_QUOTA = 100


def _discoveries(spark, sf_dir):
    """Discovery stream stand-in: page = user_id, root = event_type, arrival = event_id."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("page_id"), F.col("event_type").alias("root"),
                     F.col("event_id").alias("seq"))


# Arrivals come as so many folders of files, one micro-batch each.
BATCHES, BATCH_FILES = 4, 2


def _replayed(spark, sf_dir, name, df):
    """The rows as files that arrive in the order of ``seq``, and the stream that takes them in micro-batches."""
    base = ST.work_dir(spark, name)
    lo, hi = df.agg(F.min("seq"), F.max("seq")).first()
    slot = F.floor((F.col("seq") - F.lit(lo)) * BATCHES / F.lit((hi or 0) - (lo or 0) + 1))
    for k in range(BATCHES):
        df.where(slot == k).repartition(BATCH_FILES).write.mode("append").parquet(f"{base}/input")
    return base, ST.file_stream(spark, f"{base}/input", df.schema, BATCH_FILES)


def q_read_sql_dump(spark, sf_dir):
    """Every part as an INSERT statement of a dump in the shared folder, read back."""
    quoted = lambda c: F.concat(F.lit("'"), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("'"))
    path = ST.work_dir(spark, "sql-dump")
    part = read_table(spark, sf_dir, "part")
    part.select(F.concat(F.lit("INSERT INTO `part` (`id`, `name`, `type`, `size`) VALUES\n("), F.col("p_partkey").cast("string"), F.lit(","),
                         quoted("p_name"), F.lit(","), quoted("p_type"), F.lit(","), F.col("p_size").cast("string"), F.lit(");")).alias("value")).write.text(path)
    return dumps.read_sql_dump(spark, path, "part", [("id", "bigint"), ("name", "string"), ("type", "string"), ("size", "int")])


def q_read_page_dump(spark, sf_dir):
    """Every document as a page element of a dump in the shared folder, some with a page id that is no number, read
    back as pages and as rejected elements.  Texts are compared by their ASCII letters and digits."""
    allowed = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]", "")
    key = F.col("doc_id").cast("string")
    path = ST.work_dir(spark, "page-dump")
    read_table(spark, sf_dir, "documents").select(
        F.concat(F.lit("Page "), key).alias("title"), F.lit(0).alias("ns"), F.concat(F.when(F.col("doc_id") % 50 == 3, "x").otherwise(""), key).alias("id"),
        F.struct(F.col("doc_id").alias("id"), F.struct(allowed.alias("_VALUE"), F.length("text").alias("_bytes")).alias("text")).alias("revision"),
    ).write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(path)
    pages, rejected = dumps.page_dump_parts(spark, path)
    letters = lambda c: F.md5(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    good = pages.select(F.lit("page").alias("kind"), "page_id", "title", letters(F.get("revisions", F.lit(0))["text"]).alias("text_md5"))
    raw = lambda path: F.get_json_object("raw", f"$.{path}")
    return good.unionByName(rejected.select(
        F.lit("rejected").alias("kind"), F.substring(raw("id"), 2, 30).cast("bigint").alias("page_id"), raw("title").alias("title"),
        letters(F.coalesce(raw("revision[0].text._VALUE"), F.lit(""))).alias("text_md5")))


def q_read_html_pages(spark, sf_dir):
    """Fetched pages parted by status; the statuses are a stand-in."""
    pages = read_table(spark, sf_dir, "pages").withColumn("status", F.when(F.col("page_id") % 7 == 2, 404).when(F.col("page_id") % 11 != 5, 200))
    ok, bad = files.read_html_pages(pages)
    return ok.select("page_id", "status", F.md5("html").alias("html_md5"), F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("page_id", "status", F.md5("html").alias("html_md5"), "error"))


def q_extract_csv(spark, sf_dir):
    """The extract written as CSV to the shared folder and read back."""
    path = ST.work_dir(spark, "extract-csv")
    files.write_extract_csv(EX.run_extract(SI.page_dump(spark, sf_dir)), path)
    return files.read_extract_csv(spark, path).select(
        F.col("Page ID").alias("page_id"), F.col("Page Title").alias("title"), F.col("Categories").alias("categories"), F.col("Page Text").alias("text"))


def q_dataset_files(spark, sf_dir):
    """The split documents written as a dataset, its training half read back and cut to the first 50 %."""
    path = ST.work_dir(spark, "dataset")
    files.write_dataset(SP.train_test_split(SI.doc_pages(spark, sf_dir), "page_id").select("page_id", "title", "split"), path)
    return files.read_dataset(spark, path, "train", percent=50).select("page_id", "title")


def q_stream_merge_labels(spark, sf_dir):
    base, stream = _replayed(spark, sf_dir, "merge", _discoveries(spark, sf_dir))
    ST.stream_merge_labels(stream.select("page_id", "root"), f"{base}/out", f"{base}/ckpt")
    st = ST.merged_labels_state(spark, f"{base}/out")
    return st.select("page_id", F.array_join("categories", ",").alias("categories"))


def q_stream_upsert(spark, sf_dir):
    d = _discoveries(spark, sf_dir).select(
        "page_id", F.concat(F.lit("User "), F.col("page_id").cast("string"), F.lit(" #"), F.col("seq").cast("string")).alias("title"),
        F.array("root").alias("categories"), "seq")
    base, stream = _replayed(spark, sf_dir, "upsert", d)
    ST.stream_upsert(stream, f"{base}/table", f"{base}/ckpt", fields=("title",))
    t = ST.upserted_table(spark, f"{base}/table")
    return t.select("page_id", "title", F.array_join("categories", ",").alias("categories"))


def q_stream_quota(spark, sf_dir):
    base, stream = _replayed(spark, sf_dir, "quota", _discoveries(spark, sf_dir))
    ST.stream_quota(stream, f"{base}/out", f"{base}/ckpt", STREAM_QUOTA)
    return ST.quota_state(spark, f"{base}/out")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **(LLM.QUERIES if LLM else {}),
        **({"pipeline": PIPELINE.run} if PIPELINE else {}),
        "stream_merge_labels": q_stream_merge_labels,
        "read_sql_dump": q_read_sql_dump,
        "read_page_dump": q_read_page_dump,
        "abbreviation_scores": q_abbreviation_scores,
        "read_html_pages": q_read_html_pages,
        "extract_csv": q_extract_csv,
        "dataset_files": q_dataset_files,
        "stream_upsert": q_stream_upsert,
        "stream_quota": q_stream_quota,
        "fit_topic_classifier": q_fit_topic_classifier,
        "score_topics": q_score_topics,
        "fit_student": q_fit_student,
        "train_evaluate_topics": q_train_evaluate_topics,
        "page_intent": q_page_intent,
        "build_vocab": q_build_vocab,
        "encode_tokens": q_encode_tokens,
        "summarise": q_summarise,
        "top_topics": q_top_topics,
        "binarise": q_binarise,
        "argmax": q_argmax,
        "subset_accuracy": q_subset_accuracy,
        "bce_loss": q_bce_loss,
        "validate_top3": q_validate_top3,
        "bad_rows": q_bad_rows,
        "intent_vote": q_intent_vote,
        "rouge_1": _rouge_query(1),
        "rouge_2": _rouge_query(2),
        "rouge_l": _rouge_l_query(False),
        "rouge_lsum": _rouge_l_query(True),
        "distillation_loss": q_distillation_loss,
        "compare_models": q_compare_models,
        "evaluate_summaries": q_evaluate_summaries,
        "rouge_table": q_rouge_table,
        "category_closure": q_category_closure,
        "quota_pages": q_quota_pages,
        "merge_labels": q_merge_labels,
        "upsert_pages": q_upsert_pages,
        "visit_counts": q_visit_counts,
        "page_categories": q_page_categories,
        "build_dataset": q_build_dataset,
        "page_summary": q_page_summary,
        "members_by_namespace": q_members_by_namespace,
        "encode_categories": q_encode_categories,
        "render_prompt": q_render_prompt,
        "filter_long_docs": q_filter_long_docs,
        "html_title": q_html_title,
        "html_paragraphs": q_html_paragraphs,
        "page_card": q_page_card,
        "topic_ids": q_topic_ids,
        "multi_hot": q_multi_hot,
        "train_test_split": q_train_test_split,
        "split_sizes": q_split_sizes,
        "percent_slice": q_percent_slice,
        "assign_batches": q_assign_batches,
        "latest_revision": q_latest_revision,
        "topic_counts": q_topic_counts,
        "extract_categories": q_extract_categories,
        "keep_topics": q_keep_topics,
        "clean_text": q_clean_text,
        "lead_sentences": q_lead_sentences,
        "run_extract": q_run_extract,
        "strip_markup": q_strip_markup,
        "extract_progress": q_extract_progress,
    }


# ---------------------------------------------------------------- oracle SQL

_KEPT = S.keep(S.extract_clean_categories("text"))


_NORM = f"list_transform({_KEPT}, lambda c: replace(c, ' ', '_'))"
_BUCKET = "(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8))::BIGINT)"
_SPLIT_DOCS = f"""{S.DOC_PAGES},
sp AS (SELECT *, CASE WHEN {_BUCKET} < 429496730 THEN 'test' ELSE 'train' END AS split FROM docp)"""


_QUOTA = "(SELECT count(*) // 10 FROM part)"
_HITS = f"""{S.GRAPH},
{S.closure(10)},
{S.hits(_QUOTA)}"""
_MERGED = f"""{_HITS},
merged AS (SELECT page_id, list_sort(list(DISTINCT root)) AS cats FROM quota GROUP BY page_id)"""


_LABELS = f"list_transform({S.TOPIC_LIST}, lambda t: CAST(list_contains(categories, t) AS INTEGER))"
_PREDS = "list_transform(logits, lambda z: CAST(1 / (1 + exp(-z)) > 0.5 AS INTEGER))"
_ROWBCE = "list_sum(list_transform({z}, lambda v, i: greatest(v, 0) - v * labels[i] + ln(1 + exp(-abs(v)))))"
_SCORED = f"""{S.LOGITS},
sl AS (SELECT *, {_LABELS} AS labels, {_PREDS} AS preds, ordinal // 8 AS batch FROM sc),
u AS (SELECT id, unnest(logits) AS z, unnest(range(0, len(logits))) AS i FROM sc),
mx AS (SELECT id, max(z) AS m FROM u GROUP BY id),
rk AS (SELECT u.id, u.z, u.i, mx.m, row_number() OVER (PARTITION BY u.id ORDER BY u.z DESC, u.i) AS r
       FROM u JOIN mx ON mx.id = u.id),
top AS (SELECT id, list({S.TOPIC_LIST}[i + 1] ORDER BY r) FILTER (WHERE r <= 3) AS top3,
               1.0 / sum(exp(z - m)) AS p_top1 FROM rk GROUP BY id),
full_ AS (SELECT sl.*, top.top3, top.p_top1 FROM sl JOIN top ON top.id = sl.id)"""


def _lse(x):
    return f"(list_max({x}) + ln(list_sum(list_transform({x}, lambda v: exp(v - list_max({x}))))))"


def _words(x):
    return f"list_filter(regexp_split_to_array(lower({x}), {S.q(TX.WS + '+')}), lambda w: w <> '')"


_VOCAB = f"""wc AS (SELECT unnest({_words('text')}) AS word FROM documents),
cnt AS (SELECT word, count(*) AS n FROM wc GROUP BY word),
vocab AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) + 1 AS INTEGER) AS id, n
          FROM cnt ORDER BY n DESC, word LIMIT {1000})"""

_SUMMARY = f"""ss AS (SELECT doc_id AS k, {S.split_sentences('text')} AS s FROM documents),
st0 AS (SELECT k, unnest(s) AS sentence, unnest(range(0, len(s))) AS sidx FROM ss),
st AS (SELECT k, sidx, sentence, len({_words('sentence')}) AS n_tokens FROM st0),
toks AS (SELECT k, sidx, unnest({_words('sentence')}) AS word FROM st),
dfc AS (SELECT word, count(DISTINCT k) AS df FROM toks GROUP BY word),
idf AS (SELECT word, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0 AS idf FROM dfc),
tf AS (SELECT k, word, count(*) AS tf FROM toks GROUP BY k, word),
ps AS (SELECT t.k, t.sidx, round(avg(tf.tf * idf.idf), 9) AS score
       FROM toks t JOIN tf ON tf.k = t.k AND tf.word = t.word JOIN idf ON idf.word = t.word GROUP BY t.k, t.sidx),
scd AS (SELECT st.*, coalesce(ps.score, 0.0) AS score FROM st LEFT JOIN ps ON ps.k = st.k AND ps.sidx = st.sidx),
rk AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, sidx) AS r FROM scd),
cum AS (SELECT *, sum(n_tokens) OVER (PARTITION BY k ORDER BY r ROWS UNBOUNDED PRECEDING) AS c FROM rk WHERE r <= 120),
keep AS (SELECT k, sidx, CASE WHEN c > 120 THEN array_to_string(list_slice(regexp_split_to_array(sentence, {S.q(TX.WS + '+')}), 1, 120), ' ')
                ELSE sentence END AS sentence FROM cum WHERE c <= 120 OR r = 1)"""


def _tok(x):
    return f"list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda t: t <> '')"


# Lead-1, lead-3 and the summary of each document against its whole text, one sentence a line.
_PAIRS = f"""{_SUMMARY},
sm AS (SELECT k, string_agg(sentence, chr(10) ORDER BY sidx) AS summary FROM keep GROUP BY k),
docs AS (SELECT ss.k AS id, s, coalesce(summary, '') AS summary, {_tok("array_to_string(s, chr(10))")} AS rt FROM ss LEFT JOIN sm ON sm.k = ss.k),
pairs AS (
  SELECT id, 'lead1' AS system, {_tok("array_to_string(s[1:1], chr(10))")} AS pt FROM docs
  UNION ALL SELECT id, 'lead3', {_tok("array_to_string(s[1:3], chr(10))")} FROM docs
  UNION ALL SELECT id, 'summarise', {_tok("summary")} FROM docs)"""


def _grams(x, n):
    gram = " || ' ' || ".join(f"{x}[i + {k}]" for k in range(n))
    return f"unnest(list_transform(range(1, len({x}) - {n - 2}), lambda i: {gram}))"


def _rouge_cte(n, name):
    return f"""{name}_p AS (SELECT id, system, g, count(*) AS c FROM (SELECT id, system, {_grams('pt', n)} AS g FROM pairs) GROUP BY ALL),
{name}_r AS (SELECT id, g, count(*) AS c FROM (SELECT id, {_grams('rt', n)} AS g FROM docs) GROUP BY ALL),
{name}_h AS (SELECT p.id, p.system, sum(least(p.c, r.c)) AS hits FROM {name}_p p JOIN {name}_r r ON r.id = p.id AND r.g = p.g GROUP BY ALL),
{name} AS (
  SELECT p.id, p.system, coalesce(h.hits, 0) / greatest(len(p.pt) - {n - 1}, 1) AS precision,
         coalesce(h.hits, 0) / greatest(len(d.rt) - {n - 1}, 1) AS recall
  FROM pairs p JOIN docs d ON d.id = p.id LEFT JOIN {name}_h h ON h.id = p.id AND h.system = p.system),
{name}_f AS (SELECT id, system, precision, recall,
  CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM {name})"""


def oracle_sql() -> dict[str, str]:
    return {
        **(LLM.ORACLE_SQL if LLM else {}),
        **({"pipeline": PIPELINE.ORACLE_SQL} if PIPELINE and PIPELINE.ORACLE_SQL else {}),
        "abbreviation_scores": r"""WITH t AS (SELECT unnest(regexp_split_to_array(text, '[\t\n\x0b\f\r \x1c-\x1f\x85\p{Z}]+')) AS t FROM documents),
m AS (SELECT regexp_extract(t, '^["''(\[“‘]*(\p{L}+(?:\.\p{L}+)*)(\.?)[,;:!?"'')\]”’]*$', ['word', 'dot']) AS m FROM t
      WHERE regexp_matches(t, '^["''(\[“‘]*(\p{L}+(?:\.\p{L}+)*)(\.?)[,;:!?"'')\]”’]*$')),
w AS (SELECT m.word AS word, count(*) FILTER (WHERE m.dot = '.') AS a, count(*) FILTER (WHERE m.dot <> '.') AS b FROM m GROUP BY m.word),
p AS (SELECT sum(a) / sum(a + b) AS p FROM w),
s AS (SELECT word, a, b, length(replace(word, '.', '')) AS k, length(word) AS l,
        2 * (a * ln(0.99) + b * ln(0.01) - a * ln(p) - b * ln(greatest(1 - p, 1e-12))) AS ratio FROM w, p WHERE a > 0)
SELECT word, a AS n_period, b AS n_plain, round(ratio * exp(-k) * (l - k + 1) * pow(CAST(k AS DOUBLE), -b), 6) AS score FROM s""",
        "read_page_dump": r"""SELECT CASE WHEN doc_id % 50 = 3 THEN 'rejected' ELSE 'page' END AS kind, doc_id AS page_id,
       'Page ' || CAST(doc_id AS VARCHAR) AS title, md5(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]', '', 'g')) AS text_md5 FROM documents""",
        "read_html_pages": f"""SELECT page_id, s AS status, md5(html) AS html_md5, CASE WHEN s IS DISTINCT FROM 200 THEN '{files.FETCH_ERROR}' END AS error
FROM (SELECT *, CAST(CASE WHEN page_id % 7 = 2 THEN 404 WHEN page_id % 11 <> 5 THEN 200 END AS INTEGER) AS s FROM pages)""",
        "read_sql_dump": "SELECT p_partkey AS id, p_name AS name, p_type AS type, p_size AS size FROM part",
        "extract_csv": f"""WITH {S.WIKI_PAGES}
SELECT page_id, title, array_to_string({_KEPT}, ',') AS categories,
       {S.lead(S.clean_text(S.strip_markup('text')), 5)} AS text
FROM wiki WHERE len({_KEPT}) > 0""",
        "dataset_files": f"""WITH {_SPLIT_DOCS},
tr AS (SELECT * FROM sp WHERE split = 'train')
SELECT page_id, title FROM tr ORDER BY page_id
LIMIT (SELECT CAST(round_even(count(*) * 50 / 100.0, 0) AS BIGINT) FROM tr)""",
        "stream_merge_labels": """SELECT user_id AS page_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS categories
FROM events GROUP BY user_id""",
        "stream_upsert": """SELECT user_id AS page_id, 'User ' || CAST(user_id AS VARCHAR) || ' #' || CAST(min(event_id) AS VARCHAR) AS title,
       array_to_string(list_sort(list(DISTINCT event_type)), ',') AS categories FROM events GROUP BY user_id""",
        "stream_quota": f"""WITH f AS (SELECT event_type AS root, user_id AS page_id, min(event_id) AS seq FROM events GROUP BY 1, 2)
SELECT root, page_id, seq FROM f QUALIFY row_number() OVER (PARTITION BY root ORDER BY seq, page_id) <= {STREAM_QUOTA}""",
        "build_vocab": f"""WITH {_VOCAB} SELECT word, id, n FROM vocab""",
        "encode_tokens": f"""WITH {_VOCAB},
tk AS (SELECT doc_id, list_slice({_words('text')}, 1, {MAX_LENGTH}) AS w FROM documents),
ex AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM tk),
ids AS (SELECT ex.doc_id, list(coalesce(v.id, 1) ORDER BY ex.pos) AS ids FROM ex LEFT JOIN vocab v ON v.word = ex.word GROUP BY ex.doc_id),
full_ AS (SELECT d.doc_id, coalesce(ids.ids, []) AS ids FROM documents d LEFT JOIN ids ON ids.doc_id = d.doc_id)
SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(0, {MAX_LENGTH} - len(ids)), lambda x: 0)), ',') AS input_ids,
       CAST(len(ids) AS BIGINT) AS n_tokens FROM full_""",
        "summarise": f"""WITH {_SUMMARY}
SELECT d.doc_id, coalesce(string_agg(keep.sentence, ' ' ORDER BY keep.sidx), '') AS summary
FROM documents d LEFT JOIN keep ON keep.k = d.doc_id GROUP BY d.doc_id""",
        "top_topics": f"""WITH {_SCORED} SELECT id, array_to_string(top3, ',') AS top3, round(p_top1, 6) AS p_top1 FROM full_""",
        "binarise": f"""WITH {_SCORED} SELECT id, array_to_string(preds, '') AS preds FROM sl""",
        "argmax": f"""WITH {S.LOGITS} SELECT id, CAST(list_position(logits, list_max(logits)) - 1 AS INTEGER) AS argmax FROM sc""",
        "subset_accuracy": f"""WITH {_SCORED},
m AS (SELECT batch, CAST(preds = labels AS DOUBLE) AS ok FROM sl),
b AS (SELECT batch, avg(ok) AS acc FROM m GROUP BY batch)
SELECT round((SELECT avg(ok) FROM m), 6) AS accuracy, round((SELECT avg(acc) FROM b), 6) AS batch_mean_accuracy""",
        "bce_loss": f"""WITH {_SCORED},
m AS (SELECT batch, {_ROWBCE.format(z='logits')} AS l, len(logits) AS w FROM sl),
b AS (SELECT batch, sum(l) / sum(w) AS bl FROM m GROUP BY batch)
SELECT round((SELECT sum(l) / sum(w) FROM m), 6) AS loss, round((SELECT avg(bl) FROM b), 6) AS batch_mean_loss""",
        "validate_top3": f"""WITH {_SCORED},
g AS (SELECT len(list_filter(categories, lambda c: NOT list_contains(top3, c))) = 0 AS good FROM full_)
SELECT count(*) AS total, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE NOT good) AS bad,
       round(count(*) FILTER (WHERE NOT good) / count(*), 6) AS bad_ratio,
       round(CASE WHEN count(*) FILTER (WHERE good) = 0 THEN NULL
             ELSE count(*) FILTER (WHERE NOT good) / count(*) FILTER (WHERE good) / 100.0 END, 6) AS ref_ratio FROM g""",
        "bad_rows": f"""WITH {_SCORED}
SELECT id, array_to_string(categories, ',') AS true_topics, array_to_string(top3, ',') AS predicted
FROM full_ WHERE len(list_filter(categories, lambda c: NOT list_contains(top3, c))) > 0""",
        "intent_vote": f"""WITH {_SCORED}, {S.INTENT_CTE},
ex AS (SELECT id, unnest(top3) AS topic FROM full_),
v AS (SELECT ex.id, im.intent, im.intent_rank, count(*) AS n FROM ex JOIN intent_map im ON im.topic = ex.topic
      GROUP BY ex.id, im.intent, im.intent_rank),
best AS (SELECT id, intent FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, intent_rank) = 1)
SELECT f.id, coalesce(best.intent, 'Information') AS intent FROM full_ f LEFT JOIN best ON best.id = f.id""",
        "rouge_1": f"""WITH {_PAIRS}, {_rouge_cte(1, 'r1')}
SELECT id, system, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM r1_f""",
        "rouge_2": f"""WITH {_PAIRS}, {_rouge_cte(2, 'r2')}
SELECT id, system, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM r2_f""",
        "distillation_loss": f"""WITH {_SCORED},
t AS (SELECT list_transform(logits, lambda v: v / 4.0) AS tl, list_transform(student, lambda v: v / 4.0) AS sl_,
             {_ROWBCE.format(z='student')} / len(student) AS hard FROM sl),
k AS (SELECT hard, tl, sl_, {_lse('tl')} AS lt, {_lse('sl_')} AS ls FROM t),
r AS (SELECT hard, list_sum(list_transform(tl, lambda a, i: exp(a - lt) * ((a - lt) - (sl_[i] - ls)))) AS kl FROM k)
SELECT round(sum(kl) / count(*), 6) AS kl, round(0.5 * avg(hard) + 0.5 * 16.0 * (sum(kl) / count(*)), 6) AS loss FROM r""",
        "compare_models": f"""WITH {S.LOGITS},
a AS (SELECT list_position(logits, list_max(logits)) AS t, list_position(student, list_max(student)) AS s FROM sc)
SELECT count(*) AS n, count(*) FILTER (WHERE t = s) AS agree,
       round(count(*) FILTER (WHERE t = s) / count(*), 6) AS agreement FROM a""",
        "evaluate_summaries": f"""WITH {_PAIRS}, {_rouge_cte(1, 'r1')}, {_rouge_cte(2, 'r2')}
SELECT r1_f.system, count(*) AS pairs, round(avg(r1_f.f1), 6) AS rouge1, round(avg(r2_f.f1), 6) AS rouge2
FROM r1_f JOIN r2_f ON r1_f.id = r2_f.id AND r1_f.system = r2_f.system GROUP BY r1_f.system""",
        "category_closure": f"""WITH RECURSIVE {S.GRAPH},
{S.closure(10)}
SELECT root, category, depth FROM clos""",
        "quota_pages": f"""WITH RECURSIVE {_HITS} SELECT root, page_id, depth FROM quota""",
        "merge_labels": f"""WITH RECURSIVE {_MERGED} SELECT page_id, array_to_string(cats, ',') AS categories FROM merged""",
        "upsert_pages": f"""WITH RECURSIVE {_HITS}, {S.PAGE_CONTENT},
old AS (SELECT page_id, list_sort(list(DISTINCT root)) AS cats FROM quota WHERE root IN ('R0','R1','R2') GROUP BY page_id),
new AS (SELECT page_id, list_sort(list(DISTINCT root)) AS cats FROM quota WHERE root IN ('R2','R3','R4') GROUP BY page_id)
SELECT coalesce(o.page_id, n.page_id) AS page_id,
       CASE WHEN o.page_id IS NOT NULL THEN pc.title ELSE pc.title || ' (new)' END AS title,
       pc.summary AS summary,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(o.cats, []), coalesce(n.cats, [])))), ',') AS categories
FROM old o FULL OUTER JOIN new n ON o.page_id = n.page_id
JOIN pc ON pc.page_id = coalesce(o.page_id, n.page_id)""",
        "visit_counts": f"""WITH RECURSIVE {S.GRAPH},
{S.closure(10)}
SELECT p.page_id, count(*) AS n_visits, count(DISTINCT c.root) AS n_roots
FROM clos c JOIN cpages p ON p.category = c.category GROUP BY p.page_id""",
        "page_categories": f"""WITH {S.GRAPH}
SELECT p_partkey AS page_id, p_name AS title, category FROM part JOIN cpages ON cpages.page_id = p_partkey""",
        "build_dataset": f"""WITH RECURSIVE {_MERGED}, {S.PAGE_CONTENT}
SELECT m.page_id, pc.title, {S.lead("coalesce(nullif(pc.summary, ''), pc.text)", 5)} AS summary,
       array_to_string(m.cats, ',') AS categories,
       CASE WHEN ((('0x' || substr(md5(CAST(m.page_id AS VARCHAR)), 1, 8))::BIGINT) ) < 429496730 THEN 'test' ELSE 'train' END AS split
FROM merged m JOIN pc ON pc.page_id = m.page_id""",
        "page_summary": f"""WITH {S.DOC_PAGES}
SELECT page_id, {S.lead("coalesce(nullif(summary, ''), text)", 5)} AS summary FROM docp""",
        "members_by_namespace": f"""WITH {S.GRAPH}
SELECT 'CATEGORY' AS ns, parent AS category, child AS member FROM edges
UNION ALL SELECT 'MAIN', category, 'Page ' || CAST(page_id AS VARCHAR) FROM cpages""",
        "encode_categories": f"""WITH {S.WIKI_PAGES}
SELECT page_id, array_to_string(list_sort(list_distinct({_NORM})), ',') AS categories FROM wiki""",
        "render_prompt": f"""WITH {S.DOC_PAGES},
p AS (SELECT page_id, title, {S.lead("coalesce(nullif(summary, ''), text)", 5)} AS summary, text FROM docp)
SELECT page_id, lower('cat: ' || title || '::' || summary) AS classify, 'cat: ' || title AS title_only,
       'summarize: ' || text AS summarize FROM p""",
        "filter_long_docs": f"""SELECT d.doc_id, d.n_chars AS summary_length, {S.lead('d.text', 1)} AS summary_text
FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE d.n_chars <= 1024 AND d.text IS NOT NULL""",
        "html_title": f"""SELECT page_id, {S.html_title('html')} AS title FROM pages""",
        "html_paragraphs": f"""SELECT page_id, {S.html_paragraphs('html')} AS paragraphs FROM pages""",
        "page_card": f"""SELECT page_id, {S.html_title('html')} AS title,
       {S.strip_ws(S.lead(S.html_paragraphs('html'), 10))} AS summary FROM pages""",
        "topic_ids": f"""WITH {S.WIKI_PAGES},
t AS (SELECT page_id, unnest(list_transform({S.extract_clean_categories('text')}, lambda c: replace(c, ' ', '_'))) AS topic FROM wiki)
SELECT page_id, topic, CAST(coalesce(list_position({S.TOPIC_LIST}, topic), 0) - 1 AS INTEGER) AS topic_id FROM t""",
        "multi_hot": f"""WITH {S.WIKI_PAGES},
k AS (SELECT page_id, {_NORM} AS cats FROM wiki)
SELECT page_id, array_to_string(list_transform({S.TOPIC_LIST}, lambda t: CAST(list_contains(cats, t) AS INTEGER)), '') AS labels FROM k""",
        "train_test_split": f"""WITH {_SPLIT_DOCS} SELECT page_id, split FROM sp""",
        "split_sizes": f"""WITH {_SPLIT_DOCS} SELECT split, count(*) AS n FROM sp GROUP BY split""",
        "percent_slice": f"""WITH {_SPLIT_DOCS},
tr AS (SELECT * FROM sp WHERE split = 'train')
SELECT page_id, title FROM tr ORDER BY page_id
LIMIT (SELECT CAST(round_even(count(*) * 10 / 100.0, 0) AS BIGINT) FROM tr)""",
        "assign_batches": """SELECT vec_id, CAST(floor(vec_id / 8) AS BIGINT) AS batch FROM embeddings""",
        "latest_revision": """SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "topic_counts": f"""WITH {S.WIKI_PAGES},
t AS (SELECT unnest({_KEPT}) AS topic FROM wiki)
SELECT topic, count(*) AS n FROM t GROUP BY topic HAVING count(*) >= 2""",
        "extract_categories": f"""WITH {S.WIKI_PAGES}
SELECT page_id, array_to_string({S.extract_clean_categories('text')}, ',') AS categories,
       CAST(len({S.extract_clean_categories('text')}) AS BIGINT) AS n_categories FROM wiki""",
        "keep_topics": f"""WITH {S.WIKI_PAGES}
SELECT page_id, array_to_string({_KEPT}, ',') AS categories FROM wiki WHERE len({_KEPT}) > 0""",
        "clean_text": f"""WITH {S.WIKI_PAGES}
SELECT page_id, {S.clean_text('text')} AS text FROM wiki""",
        "lead_sentences": f"""SELECT doc_id, {S.lead('text', 5)} AS lead FROM documents""",
        "run_extract": f"""WITH {S.WIKI_PAGES}
SELECT page_id, title, array_to_string({_KEPT}, ',') AS categories,
       {S.lead(S.clean_text(S.strip_markup('text')), 5)} AS text
FROM wiki WHERE len({_KEPT}) > 0""",
        "strip_markup": f"""WITH {S.WIKI_PAGES}, {S.MARKED}
SELECT page_id, {S.strip_markup('text')} AS text FROM marked""",
        "extract_progress": f"""WITH {S.WIKI_PAGES}
SELECT count(*) AS pages, count(*) FILTER (WHERE len({_KEPT}) > 0) AS hits FROM wiki""",
    }
