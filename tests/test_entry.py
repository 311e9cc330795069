import __spark_entry__ as E
from conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["page_id", "title", "categories", "text"]
    assert df.count() > 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_results_invariant_to_partitioning(spark):
    base = sorted(map(tuple, E.q_build_dataset(spark, SF_SMALL).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = sorted(map(tuple, E.q_build_dataset(spark, SF_SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert base == again


def test_small_queries_run(spark):
    for key in ("topic_counts", "html_title", "rouge_1", "summarise", "intent_vote"):
        assert E.queries()[key](spark, SF_SMALL).count() >= 0
