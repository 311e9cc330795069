from topicforge.operators import encode as EN


def test_vocab_order_and_encoding(spark):
    docs = spark.createDataFrame(
        [(1, "b a a c"), (2, "a b d"), (3, ""), (4, None), (5, "zz " * 10)],
        "doc_id long, text string")
    vocab = {r["word"]: (r["id"], r["n"]) for r in EN.build_vocab(docs, "text", 3).collect()}
    # counts: a=3, b=2, zz=10 -> ids by (count desc, word asc), starting at 2
    assert vocab == {"zz": (2, 10), "a": (3, 3), "b": (4, 2)}
    enc = {r["doc_id"]: r for r in EN.encode_tokens(docs, "doc_id", "text", EN.build_vocab(docs, "text", 3), 4,
                                                      vocab_rows=3).collect()}
    assert enc[1]["input_ids"] == [4, 3, 3, 1] and enc[1]["attention_mask"] == [1, 1, 1, 1]
    assert enc[2]["input_ids"] == [3, 4, 1, 0] and enc[2]["attention_mask"] == [1, 1, 1, 0]
    assert enc[3]["input_ids"] == [0, 0, 0, 0] and enc[4]["attention_mask"] == [0, 0, 0, 0]
    assert enc[5]["input_ids"] == [2, 2, 2, 2]                     # truncated to max_length


def test_salted_vocab_join_matches_broadcast(spark):
    docs = spark.createDataFrame([(i, "the cat the dog " * 3) for i in range(20)], "doc_id long, text string")
    vocab = EN.build_vocab(docs, "text", 10)
    a = sorted(map(tuple, EN.encode_tokens(docs, "doc_id", "text", vocab, 8, vocab_rows=3).collect()))
    import topicforge.operators.skew as SK
    old = SK.BROADCAST_MAX_ROWS
    try:
        b = sorted(map(tuple, EN.encode_tokens(docs, "doc_id", "text", vocab, 8, vocab_rows=10**9).collect()))
    finally:
        SK.BROADCAST_MAX_ROWS = old
    assert a == b
