"""Small cases of every training-data operator: nulls, empty and long texts, ties, repeated rows, empty tables and
columns with clashing names, each against brute force, an exact round trip or the library."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from topicforge.llm import (bpe, components, jaccard, line_crf, mixing, passages, pretokens, quality_model, queries, token_counts,
                            token_files, topk, toxicity)
from topicforge.llm.pretokens import splitter, vocabulary

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["", None, "Hello  World\n\t x", "a<|endoftext|>b <|startoftext|>C", "ΑΣ ΣΑΣ İstanbul 'S it's", "日本語 🙂🙃 ''s'sun", "a\x1cb \x85 c",
          "x" * 3000, "᫄aู é é", " lead and trail ", "aaaa" * 50]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def docs(spark, rows):
    """(id, text) rows, with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", i, 1.5) for i, t in rows], "doc_id long, text string, bucket string, label long, score double")


def empty(spark):
    return docs(spark, []).limit(0)


def texts():
    rng = random.Random(5)
    more = ["".join(rng.choice("abeinrst  '1!é日\n") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return list(enumerate([*TRICKY, *more, "same text", "same text"]))


def test_encoding_is_the_librarys_and_decodes(spark):
    lib, rows = Tokenizer.from_file(WORD), texts()
    want = {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    got = bpe.bpe_round_trip(docs(spark, rows), WORD).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == want[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.decoded == lib.decode(r.ids, skip_special_tokens=False)
    digest = bpe.bpe_round_trip(docs(spark, rows[:4]), WORD, give="digest").collect()
    assert all(r.ids_sha256 == hashlib.sha256(np.array(want[r.doc_id], "<u4").tobytes()).hexdigest() for r in digest)
    assert bpe.bpe_round_trip(empty(spark), WORD).count() == 0


def test_token_counts_are_the_librarys(spark):
    lib, rows = Tokenizer.from_file(BYTE), texts()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs(spark, rows), BYTE, 20).collect()}
    assert got == {i: (len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 20) for i, t in rows}
    assert token_counts.token_counts(empty(spark), BYTE, 20).count() == 0
    v = vocabulary(BYTE)
    assert len(token_counts.merge(v, v.spell("internationalisation"))) == len(lib.encode("internationalisation").ids)


def watched(monkeypatch, module):
    """What texts the pieces of a module are split from."""
    calls = []
    monkeypatch.setattr(module, "splitter", lambda path: lambda text: calls.append(text) or splitter(path)(text))
    return calls


def some_texts(rng):
    return [words(rng, 40), words(rng, 30) + " 'tis, 12 <|endoftext|> z\u0323 \u023a", "", "\u65e5\u672c " + "long" * 40]


def test_texts_are_encoded_from_one_split(monkeypatch):
    lib, some, calls = Tokenizer.from_file(WORD), some_texts(random.Random(8)), watched(monkeypatch, token_files)
    coder = token_files.LibraryIds(WORD, most=5)
    for _ in range(2):
        got = coder.encode(some, 1)
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == [[*lib.encode(t).ids, 1] for t in some]
        assert len(coder.pieces) <= 5 and calls == some
        calls.clear()


def test_word_pieces_are_the_librarys():
    lib, rng, split = Tokenizer.from_file(WORD), random.Random(11), splitter(WORD)
    some = ["don't 'tis x' it's. a. b1 c9' d\u0301 e-f ab,cd ef!! gh\x1cij kl\x85mn \u2019s 'S", "\u65e5\u672c\u3002 \u03a3\u03a3. \u01c5 a\u00b2 \u00aa",
            *("".join(rng.choice("abs't. 1,\n\x1d\u00e9\u00b2\u2019\u65e5") for _ in range(50)) for _ in range(300))]
    back = {c: b for b, c in enumerate(pretokens.byte_letters())}
    for text in some:
        want = lib.pre_tokenizer.pre_tokenize_str(lib.normalizer.normalize_str(text))
        assert split(text) == [bytes(map(back.__getitem__, p)).decode() for p, _ in want]


def test_a_batch_does_not_read_the_whole_memory():
    """Few new pieces beside many known ones: what a batch looks at follows its texts, not the memory."""
    class Watched(pretokens.Memo):
        def __iter__(self):
            raise AssertionError("the whole memory was read")

    known = Watched(most=1000)
    known.update((str(k), k) for k in range(500))
    known.before = {"old": 1}
    assert known.renew(["1", "old", "new", "new"]) == {"new"} and known["old"] == 1
    lib, coder = Tokenizer.from_file(WORD), token_files.LibraryIds(WORD)
    coder.pieces = Watched(most=coder.most)
    for text in some_texts(random.Random(12)):
        assert coder.encode([text, text], None) == [np.array(lib.encode(text).ids, "<u2").tobytes()] * 2


def test_pieces_near_and_far_are_those_of_the_general_expression():
    rng, near = random.Random(9), [*map(chr, (*range(0x378), *range(0x2000, 0x2065)))]
    for pattern in (pretokens.WORD_PIECES, pretokens.BYTE_PIECES):
        find, general = pretokens.finder(pattern), regex.compile(pattern).findall
        for k in range(400):
            text = "".join(rng.choice(near if rng.random() < 0.5 else "ab1 \n'st") for _ in range(60)) + "\u65e5" * (k % 4 == 0)
            assert find(text) == general(text)


def test_texts_are_counted_from_one_split(monkeypatch):
    lib, some, calls = Tokenizer.from_file(BYTE), some_texts(random.Random(8)), watched(monkeypatch, token_counts)
    count = token_counts.counter.__wrapped__(BYTE, tuple(token_counts.whole_tokens(BYTE)))
    assert list(map(count, some)) == [len(lib.encode(t).ids) for t in some] and calls == some


def test_pieces_merge_alike_by_scan_and_by_heap():
    rng, v = random.Random(10), vocabulary(BYTE)
    for n in (*range(60), 500):
        spelled = v.spell("".join(rng.choice("aeinrsté") for _ in range(n)))
        assert token_counts.merge(v, spelled) == token_counts._merge_long(v, spelled)


def test_token_files_round_trip(spark, tmp_path):
    lib, rows = Tokenizer.from_file(WORD), [*texts(), (3, "again"), (None, "no id")]
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs(spark, rows), path, WORD, 1, files=3)
    got = sorted(token_files.read_token_files(spark, path, digest=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = {(i, zlib.crc32(np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())) for i, t in rows}
    assert {(r.doc_id, r.ids_crc32) for r in got} == want
    assert sorted(token_files.read_document(spark, path, 3)) == sorted([*lib.encode(t).ids, 1] for t in (rows[3][1], "again"))
    none = str(tmp_path / "none")
    token_files.write_token_files(empty(spark), none, WORD, 1)
    assert token_files.read_token_files(spark, none).count() == 0


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                top[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_jaccard_components_against_brute_force(spark):
    rng = random.Random(9)
    rows, line = [], words(rng, 12)
    for family in range(6):
        base = words(rng, 60).split()
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = words(rng, 1)
            if rng.random() < 0.3:
                del w[rng.randrange(len(w))]
            rows.append(" ".join(w) + ("\n" + line if rng.random() < 0.5 else ""))
    rows += [line, line.upper(), f"{line} one", f"two {line}", "", None, " \t", "few words", "few words", "Few  Words", "alone"]
    rows = list(enumerate(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, rows)).collect()}
    assert got == brute_components(rows)
    kept = jaccard.one_of_each(docs(spark, [*rows, rows[0]]))
    assert kept.columns == docs(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in got.items() if i == c)
    assert jaccard.jaccard_components(empty(spark)).count() == 0


def test_whole_sets_travel_once_and_columns_alone(spark, monkeypatch):
    as_bytes = lambda *h: np.array(h, dtype=np.uint64).tobytes()
    sets = spark.createDataFrame([(1, as_bytes(1, 2, 3)), (2, as_bytes(1, 2, 3, 4)), (3, as_bytes(7, 8))], "doc_id long, cols binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    families = spark.createDataFrame([(1, 1, 1, 3), (2, 1, 2, 4), (3, 1, 3, 2)], "doc_id long, family long, component long, n long")
    plan = lambda df: df._jdf.queryExecution().toString()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (jaccard.BROADCAST_IDS, 0):
            monkeypatch.setattr(jaccard, "BROADCAST_IDS", most)
            over, within = jaccard.overlaps(pairs, sets, 75), jaccard.family_links(families, sets, 75)
            assert [tuple(r) for r in over.collect()] == [(1, 2, 75.0)]
            assert [tuple(r) for r in within.collect()] == [(1, 2)]
            for df in (over, within):
                assert ("SortMergeJoin [doc_id" in plan(df)) == (most == 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    reps = spark.createDataFrame([(1, 9, [5, 6, 7]), (2, 9, [6, 7]), (3, 9, [8])], "row long, n long, kept array<long>")
    got = jaccard.shared_columns(reps)
    assert {r.row: (sorted(r.hs), r.k) for r in got.collect()} == {1: ([6, 7], 2), 2: ([6, 7], 2)}


def test_texts_that_repeat_a_doc_id_keep_their_own_columns(spark):
    one, two = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(1, one), (1, two), (2, f"{one} x"), (3, f"{two} y"), (4, "alone")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs(spark, rows)).collect()}
    assert got == {1: (26, 1), 2: (27, 1), 3: (27, 1), 4: (1, 4)}


def test_block_product_counts_overlaps():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, 80)).astype(np.uint64) for _ in range(9)]
    brute = lambda a, b: np.array([[len(np.intersect1d(x, y)) for y in b] for x in a])
    assert (jaccard.block_product(sets, 4) == brute(sets[:4], sets[4:])).all()
    full = jaccard.block_product(sets, 9)
    assert (full[~np.eye(9, dtype=bool)] == brute(sets, sets)[~np.eye(9, dtype=bool)]).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    assert {r.node: r.component for r in components.components(links).collect()} == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_repeated_passages(spark):
    rng = random.Random(4)
    p = words(rng, 70).split()
    fuzzy = list(p)
    fuzzy[20] = "changed"
    del fuzzy[45]
    own = [words(rng, 40) for _ in range(9)]
    rows = [(1, f"{own[0]} {' '.join(p)} {own[1]}"), (2, f"{own[2]}\n{' '.join(p).upper()}\n{own[3]}"), (3, f"{own[4]} {' '.join(fuzzy)} {own[5]}"),
            (4, own[6] + own[7]), (5, f"{own[0]} {' '.join(p)} {own[1]}"), (6, ""), (7, None), (8, f"{own[8]} {' '.join(p[:30])}")]
    got = {r.doc_id: (r.start_word, r.end_word, r.source_doc_id, r.n_equal) for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert got[2] == (40, 110, 1, 70) and got[5] == (0, 150, 1, 150)
    assert got[3][:3] == (40, 109, 1) and got[3][3] == 68
    assert set(got) == {2, 3, 5}
    cut = passages.cut_passages(docs(spark, rows), passages.repeated_passages(docs(spark, rows)))
    left = {r.doc_id: r.text for r in cut.collect()}
    assert set(left) == {1, 2, 3, 4, 6, 7, 8} and left[1] == rows[0][1] and left[7] is None
    assert left[2].split() == (own[2] + " " + own[3]).split()
    assert passages.repeated_passages(empty(spark)).count() == 0


def test_runs_of_one_word_are_passages(spark):
    head = [" ".join(f"{name}{i}" for i in range(20)) for name in "ab"]
    rows = [(1, f"{head[0]} {'buy ' * 120}"), (2, f"{head[1]} {'buy ' * 90}")]
    got = {(r.doc_id, r.start_word, r.end_word) for r in passages.repeated_passages(docs(spark, rows)).collect()}
    assert (2, 20, 110) in got
    assert {r[0] for r in got} == {2}


def uncovered(rows, got, size=50):
    """Windows of words that a document before holds, word by word, and of which a word is in no passage."""
    seen, out = set(), []
    for d, t in sorted(rows):
        w = (t or "").lower().split()
        cut = {k for r in got if r.doc_id == d for k in range(r.start_word, r.end_word)}
        mine = [tuple(w[k:k + size]) for k in range(len(w) - size + 1)]
        out += [(d, k) for k, x in enumerate(mine) if x in seen and not cut.issuperset(range(k, k + size))]
        seen.update(mine)
    return out


def test_passages_whose_pieces_stand_in_documents_before(spark):
    rng = random.Random(9)
    p, own = words(rng, 60).split(), [words(rng, 40) for _ in range(8)]
    long = words(rng, 400).split()
    rows = [(k + 1, f"{own[2 * k]} {' '.join(x)} {own[2 * k + 1]}") for k, x in enumerate((p[:40], p[20:], p, p))]
    # pieces of one long text, at random, before it and its repeat; runs of a word longer than in each text before
    rows += [(10 + k, " ".join(long[a:a + rng.randint(20, 90)]) + " " + words(rng, 30)) for k in range(25) for a in [rng.randrange(350)]]
    rows += [(40, " ".join(long)), (41, words(rng, 9) + " " + " ".join(long)), (50, "buy " * 60 + own[0]), (51, own[1] + " buy" * 170 + " " + own[2])]
    got = passages.repeated_passages(docs(spark, rows)).collect()
    assert (4, 40, 100, 3, 40, 100, 60) in {tuple(r) for r in got}
    assert uncovered(rows, got) == []
    assert all(r.source_doc_id < r.doc_id and r.end_word <= len(dict(rows)[r.doc_id].split()) for r in got)


def test_passages_go_on_past_changes_near_their_ends(spark):
    equal = np.array([1, 1, 0, 1, 1, 1, 1, 0, 1, 0, 0, 1], dtype=bool)
    assert passages.extension(equal, 80) == (7, 6) and passages.extension(equal, 100) == (2, 2)
    assert passages.extension(equal[:0], 80) == (0, 0) and passages.extension(~equal[:2], 80) == (0, 0)
    rng = random.Random(11)
    p, own = words(rng, 55).split(), [words(rng, 20) for _ in range(4)]
    changed = list(p)
    changed[5] = changed[49] = "changed"
    rows = [(1, f"{own[0]} {' '.join(p)} {own[1]}"), (2, f"{own[2]} {' '.join(changed)} {own[3]}")]
    assert [tuple(r) for r in passages.repeated_passages(docs(spark, rows)).collect()] == [(2, 20, 75, 1, 20, 75, 53)]


def test_passages_go_on_as_far_as_the_texts_agree(spark):
    rng = random.Random(22)
    p, own = words(rng, 900).split(), [words(rng, 40) for _ in range(4)]
    changed = [f"changed{k}" if k >= 100 and k % 6 == 5 else w for k, w in enumerate(p)]
    rows = [(1, f"{own[0]} {' '.join(p)} {own[1]}"), (2, f"{own[2]} {' '.join(changed)} {own[3]}")]
    got = passages.repeated_passages(docs(spark, rows)).collect()
    assert any(r.start_word == 40 and r.end_word >= 935 and r.doc_id == 2 for r in got)
    equal = np.array([True] * 100 + [False] * 31 + [True] * 500)
    assert passages.last_word(equal, 80) == 130 and passages.last_word(equal[:130], 80) is None
    assert passages.extension(equal, 80) == (100, 100)


def test_windows_are_covered_by_few_runs():
    assert passages.cover([(0, 9), (1, 10), (2, 11)], 5) == [(0, 7, 9)]
    assert passages.cover([(k, 0) for k in range(11)], 5) == [(0, 5, 0), (5, 10, 0), (10, 15, 0)]
    assert passages.cover([(0, 0), (20, 0)], 5) == [(0, 5, 0), (20, 25, 0)]


def test_hot_seeds_have_the_same_matches(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(d, [k * 3 for k in range(40)], [0] * 40, [rng.choice([1, 2, 3, 100 + k]) for k in range(40)]) for d in range(60)]
    for _, _, nth, kmer in rows:
        nth[:] = passages.ordinals(np.array(kmer)).tolist()
    seeds = spark.createDataFrame(rows, "doc_id long, pos array<int>, nth array<int>, kmer array<long>")
    plain = sorted(map(tuple, passages.seed_matches(seeds).collect()))
    monkeypatch.setattr(passages, "HOT_ROWS", 2)
    monkeypatch.setattr(passages, "HOT_PROBE", 2)
    assert plain and sorted(map(tuple, passages.seed_matches(seeds).collect())) == plain


def test_ordinals_count_equal_keys_before():
    assert passages.ordinals(np.array([7, 3, 7, 7, 3], dtype=np.uint64)).tolist() == [0, 0, 1, 2, 1]
    assert passages.ordinals(np.zeros(0, dtype=np.uint64)).tolist() == []


def test_least_of_windows_is_the_first_among_equals():
    rng = np.random.default_rng(5)
    for n in (passages.WINDOW, passages.WINDOW + 1, 300):
        hashes = rng.integers(0, 40, n).astype(np.uint64)
        view = np.lib.stride_tricks.sliding_window_view(hashes, passages.WINDOW)
        at = view.argmin(axis=1) + np.arange(len(view))
        assert passages.least_of_windows(hashes).tolist() == at.tolist()
        if n > passages.WINDOW:
            assert passages.seeds_of(hashes).tolist() == np.unique(at).tolist()


def test_least_edits_against_the_whole_table():
    rng = np.random.default_rng(6)
    for _ in range(300):
        a, b = (rng.integers(0, 4, rng.integers(0, 9)) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert passages._least_edits(a, b) == table[-1, -1]


def test_ascending_matches_are_chained_without_a_tree(monkeypatch):
    rng = random.Random(11)
    groups = []
    for _ in range(40):
        p = a = 0
        group = []
        for _ in range(rng.randint(2, 25)):
            p, a = p + rng.choice([1, 7, 20, 90]), a + rng.choice([1, 7, 20, 150])
            group.append((p, a))
        groups.append(group)
    got = [passages.chains(g) for g in groups]
    # a repeated source position far off, which no chain takes, sends the same matches through the tree
    for g, found in zip(groups, got):
        far = [(g[-1][0] + 10_000, 0), (g[-1][0] + 20_000, 0)]
        assert sorted(c for c in passages.chains(g + far) if c[0][0] < 10_000) == sorted(found)

    def no_tree(n):
        raise AssertionError("ascending matches need no tree")

    monkeypatch.setattr(passages, "Fenwick", no_tree)
    assert [passages.chains(g) for g in groups] == got


def test_chains_of_pairs_that_span_batches(spark):
    rng = random.Random(12)
    pairs = {(d, s): sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.choice([1, 1, 2, 9]))}, key=lambda m: (m[0], -m[1]))
             for d in range(20, 40) for s in range(rng.randint(1, 4))}
    matches = spark.createDataFrame([(d, s, p, a) for (d, s), ms in pairs.items() for p, a in ms], "doc_id long, source long, pos int, source_pos int")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = sorted((r.doc_id, r.source, r.pos, r.source_pos) for r in passages._chain_table(matches).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert got == sorted((d, s, [p for p, _ in c], [a for _, a in c]) for (d, s), ms in pairs.items() for c in passages.chains(ms) if len(c) > 1)


def test_chains_take_the_best_collinear_path():
    assert passages.chains([(0, 0), (5, 5), (6, 40), (10, 10)])[0] == [(0, 0), (5, 5), (10, 10)]
    assert passages.chains([(0, 0), (200, 200)]) == [[(0, 0)], [(200, 200)]] or len(passages.chains([(0, 0), (200, 200)])) == 2
    assert passages.cut_words("a b  c d", [(1, 3)]) == "a d"


def test_mix_budgets_and_selection(spark):
    sizes = spark.createDataFrame([("a", "x", 100), ("a", "y", 1000), ("b", "x", 50), ("b", "y", 5000)], "d string, s string, tokens long")
    weights = spark.createDataFrame([("a", 3), ("a/x", 9)], "path string, weight long")
    got = {(r.d, r.s): r.budget for r in mixing.leaf_budgets(sizes, ["d", "s"], weights, 50, 1).collect()}
    # 3075 in all: a can take 1100 of its 2306, so b gets 1975, of which b/x takes its 50
    assert got == {("a", "x"): 100, ("a", "y"): 1000, ("b", "x"): 50, ("b", "y"): 1925}
    levels = {"bucket": F.col("bucket")}
    none = spark.createDataFrame([], "path string, weight long")
    rows = [(k, words(random.Random(k), 10)) for k in range(50)] + [(60, ""), (61, None)]
    taken, cuts = mixing.mix(docs(spark, rows), levels, none, 150, 2)
    r = taken.agg(F.sum(F.col("n_tokens") * F.col("epochs")), F.min("epochs")).first()
    assert tuple(r) == (750, 1) and cuts.count() == 1
    full = mixing.mixed_documents(docs(spark, rows), levels, none, 150, 2)
    assert full.columns == docs(spark, rows).columns and full.where("doc_id < 50").count() == 75
    assert mixing.mix(empty(spark), levels, none)[0].count() == 0


def brute_shares(budget, children):
    """{name: tokens} of (name, weight, cap): a level of water found by trying every child's own, then single tokens."""
    open_, got = {n: (w, c) for n, w, c in children if w and c}, {n: 0 for n, _, _ in children}
    budget = min(budget, sum(c for _, c in open_.values()))
    while full := [n for n, (w, c) in open_.items() if c * sum(x for x, _ in open_.values()) <= budget * w]:
        for n in full:
            got[n] = open_[n][1]
            budget -= open_.pop(n)[1]
    whole = sum(w for w, _ in open_.values())
    for n, (w, _) in open_.items():
        got[n] = budget * w // whole
    for n in sorted(open_, key=lambda n: (-(budget * open_[n][0] % whole), n))[:budget - sum(got[n] for n in open_)]:
        got[n] += 1
    return got


def test_mix_budgets_against_brute_force(spark):
    rng = random.Random(11)
    for trial in range(4):
        sizes = {(d, s): rng.choice([0, 1, 7, 50, rng.randint(1, 2000)]) for d in "abc" for s in "uvwxyz" if rng.random() < 0.9}
        weights = {p: rng.choice([0, 1, 1, 2, 3, 9]) for p in [*"abc", *(f"{d}/{s}" for d in "abc" for s in "uvw")]}
        percent, epochs = rng.choice([30, 80, 150]), rng.choice([1, 2])
        cap = {k: t * epochs * (weights.get(k[0], 1) > 0 and weights.get("/".join(k), 1) > 0) for k, t in sizes.items()}
        top = brute_shares(sum(sizes.values()) * percent // 100, [(d, weights.get(d, 1), sum(c for k, c in cap.items() if k[0] == d)) for d in {k[0] for k in sizes}])
        want = {}
        for d in top:
            family = brute_shares(top[d], [(s, weights.get(f"{e}/{s}", 1), cap[e, s]) for e, s in sizes if e == d])
            assert sum(family.values()) == top[d]
            want.update({(d, s): b for s, b in family.items()})
        got = mixing.leaf_budgets(spark.createDataFrame([(*k, t) for k, t in sizes.items()], "d string, s string, tokens long"), ["d", "s"],
                                  spark.createDataFrame(list(weights.items()), "path string, weight long"), percent, epochs)
        assert {(r.d, r.s): r.budget for r in got.collect()} == want, trial


def test_mix_remainders_zero_and_negative_weights(spark):
    none = spark.createDataFrame([], "path string, weight long")
    equal = spark.createDataFrame([("x", 30), ("y", 30), ("z", 40)], "s string, tokens long")
    assert {r.s: r.budget for r in mixing.leaf_budgets(equal, ["s"], none, 50, 1).collect()} == {"x": 17, "y": 17, "z": 16}
    out = spark.createDataFrame([("x", 0)], "path string, weight long")
    assert {r.s: r.budget for r in mixing.leaf_budgets(equal, ["s"], out, 50, 1).collect()} == {"x": 0, "y": 25, "z": 25}
    with pytest.raises(Exception, match="negative weight of x"):
        mixing.leaf_budgets(equal, ["s"], out.selectExpr("path", "weight - 1 AS weight"), 50, 1).collect()


def test_mix_prefix_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, words(rng, rng.randint(0, 30))) for k in range(150)] + [(7, "same row"), (7, "same row"), (8, "other text"), (None, "no id"), (151, None), (152, "long " * 400)]
    levels, none = {"a": F.lit("x"), "b": F.when(F.col("doc_id") % 3 > 0, F.col("doc_id") % 3)}, spark.createDataFrame([], "path string, weight long")
    for digits, ordered in ((3, 10_000), (1, 2)):
        monkeypatch.setattr(mixing, "DIGITS", digits)
        monkeypatch.setattr(mixing, "ORDERED", ordered)
        got, cuts = mixing.mix(docs(spark, rows), levels, none, 70, 2)
        budget = {r["__level1"]: r.budget for r in cuts.collect()}
        want = []
        for leaf in budget:
            mine = [(i, t or "") for i, t in rows if ("" if not (i or 0) % 3 else str(i % 3)) == leaf]
            whole, part = divmod(budget[leaf], sum(len(t.split()) for _, t in mine))
            order = sorted((hashlib.md5(f"mix-1:{whole}:{'' if i is None else i}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest(), i, t) for i, t in mine)
            for key, i, t in order:
                before = sum(len(u.split()) for other, _, u in order if other < key)
                if epochs := whole + (before < part):
                    want.append((i, leaf, len(t.split()), epochs))
        assert sorted(((r.doc_id, r.b, r.n_tokens, r.epochs) for r in got.collect()), key=str) == sorted(want, key=str)


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.normal(size=(400, 8)), 3)
    v[7] = v[8] = v[9]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(500, None), (501, [1.0] * 7 + [None]), (502, [float("nan")] * 8), (503, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = np.floor(1024 * v).astype(int)
    for q in range(0, 400, 20):
        s = sorted((-int(whole[q] @ whole[i]), i) for i in range(400) if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -x) for k, (x, i) in enumerate(s)]
    assert len(got) == 20
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_top_k_of_repeated_rows_and_ids(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(60, 4)).round(2).tolist()
    rows = list(enumerate(v)) + [(3, v[3])] * 3 + [(0, v[0])] * 2 + [(0, [1.0, 1.0, -1.0, 0.0])] + [(7, [9.0, 9.0, 9.0, 9.0])] * 9
    df = spark.createDataFrame([(i, x, 1, "b") for i, x in rows], "vec_id long, embedding array<double>, copies int, block string")
    whole = [(i, np.floor(1024 * np.array(x)).astype(int)) for i, x in rows]
    want = set()
    for i, q in {(i, tuple(x)) for i, x in whole if i % 20 == 0}:
        best = sorted((-int(np.array(q) @ x), j) for j, x in whole if j != i)[:6]
        want |= {(i, q, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=6)
    keys = {(r.vec_id, r.key): tuple(r.v) for r in topk.whole_vectors(df, F.lit(True), "vec_id", "embedding", 1024, 6).withColumn("key", F.xxhash64("v")).collect()}
    rows_got = [(r.query_id, keys[r.query_id, r.query_key], r["rank"], r.vec_id, r.score) for r in got.collect()]
    assert len(rows_got) == len(want) and set(rows_got) == want
    with pytest.raises(Exception, match="different lengths"):
        topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_sorted_lists_end_by_bounds():
    rng = np.random.default_rng(9)
    near = rng.integers(-1000, 1000, size=(20, 6))
    vectors = np.concatenate([near + 4000, rng.integers(-1000, 1000, size=(5000, 6)), np.zeros((30, 6), dtype=int)])
    ids = rng.permutation(len(vectors))
    lists = topk.SortedLists(ids, np.ones(len(ids), dtype=int), vectors)
    for query in [near[0] + 4000, -near[1] - 4000, rng.integers(-9, 9, size=6), np.array([5, 0, 0, 0, 0, 0]), np.zeros(6, dtype=int)]:
        before = lists.read
        got = lists.search(query, -1, 10)
        want = sorted(zip((-(vectors @ query)).tolist(), ids.tolist()))[:10]
        assert list(zip((-got[1]).tolist(), got[0].tolist())) == want
        assert lists.read - before <= vectors.size
    only = topk.SortedLists(ids, np.ones(len(ids), dtype=int), vectors)
    only.search(np.full(6, 4000), -1, 10)
    assert only.read < vectors.size // 4  # a clear lead ends the reading early


def labelled(spark, rng):
    rows = [(k, words(rng, 60) + (" ### $$$ ||| " * 30 if k % 3 == 0 else "")) for k in range(120)]
    return docs(spark, [*rows, (900, ""), (901, None)]), spark.createDataFrame([(k, int(k % 3 != 0)) for k, _ in rows], "doc_id long, quality int")


def test_quality_scores(spark):
    d, labels = labelled(spark, random.Random(1))
    out = quality_model.score_quality(d, quality_model.fit_quality(d, labels)).collect()
    assert len(out) == 122 and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.doc_id % 3 != 0) for r in out if r.doc_id < 900)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    none = quality_model.score_quality(d, quality_model.fit_quality(d, labels.limit(0))).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert quality_model.score_quality(empty(spark), quality_model.fit_quality(empty(spark), labels)).count() == 0


def test_reduced_quality_scores_are_those_of_averaged_vectors():
    rng, gen = random.Random(6), np.random.default_rng(6)
    vectors, layer, bias = gen.normal(size=(quality_model.BUCKETS, 3)), gen.normal(size=(2, 3)), gen.normal(size=2)
    score = quality_model._scorer((vectors @ (layer[1] - layer[0]), bias[1] - bias[0]))

    def pair(a, b):
        a, b = zlib.crc32(a.encode()), zlib.crc32(b.encode())
        mixed = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % 2**64 >> 29
        return quality_model.REPEAT if a == b else mixed % (quality_model.BUCKETS - 1) + 1

    for text in ["", "one", "same same same", "日本語 été", "a b\n\nc", words(rng, 30), words(rng, 5000), *(words(rng, n) for n in range(2, 12))]:
        ws = text.split()
        features = [f for w in ws for f in quality_model.word_features(w)] + [pair(a, b) for a, b in zip(ws, ws[1:])]
        z = layer @ (vectors[features].mean(axis=0) if features else np.zeros(3)) + bias
        assert score(text) == pytest.approx(np.exp(z[1]) / np.exp(z).sum(), abs=1e-9)


def brute_line_counts(text):
    ws, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    windows = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    twice = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:k] for k, line in enumerate(lines))
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(twice), len(ws) < 50 or 100 * len(twice) > 50 * len(ws))


def test_line_counts_against_brute_force(spark):
    d, labels = labelled(spark, random.Random(2))
    rng = random.Random(12)
    bits = ["a", "bb", "a", "c#", "*$%", "日本", "x\x1cy", "\u00a0", "<b>"]
    texts_ = ["", None, "\n\n", " a \n a \n a ", "a b c a b c", "a\r\na\r\na", "same line\n" * 40, words(rng, 3000) + "\n" + words(rng, 20)]
    texts_ += ["".join(rng.choice(bits) + rng.choice([" ", " ", "\n", "\t", "  ", "\r\n", "\x0b"]) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    rows = list(enumerate(texts_)) + [(5, texts_[5])]
    got = line_crf.mark_lines(docs(spark, rows), line_crf.fit_lines(d, labels)).collect()
    want = [(i, *brute_line_counts(t or "")) for i, t in rows]
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted(want)
    assert not any(r.kept for r in got if r.base_failed)


def test_line_marks_and_counts(spark):
    d, labels = labelled(spark, random.Random(2))
    field = line_crf.fit_lines(d, labels)
    out = {r.doc_id: r for r in line_crf.mark_lines(d, field).collect()}
    assert all(out[k].kept == (k % 3 != 0) for k in range(120))
    assert out[900].base_failed and not out[901].kept and out[900].n_words == 0
    x = line_crf.Document("a b c\n\na b c\nd # é* a b c")
    assert (x.n_words, x.word_chars, x.n_symbols, x.dup_lines, x.n_repeat_words) == (12, 13, 2, 1, 9)
    assert line_crf.mark_lines(empty(spark), field).count() == 0


def test_viterbi_is_the_best_marking():
    field, rng = line_crf.Field(), np.random.default_rng(1)
    field.emit, field.move, field.first = rng.normal(size=field.emit.shape), rng.normal(size=(2, 2)), rng.normal(size=2)
    field.emit[0] = 0
    lines = [[0, 3], [0, 9, 12], [0], [0, 20, 5], [0, 7]]

    def score(marks):
        s = field.first[marks[0]] + sum(field.emit[m, f].sum() for m, f in zip(marks, lines))
        return s + sum(field.move[a, b] for a, b in zip(marks, marks[1:]))

    every = [[(n >> k) & 1 for k in range(5)] for n in range(32)]
    assert score(field.decoder()(lines)) == pytest.approx(max(map(score, every)))


def test_toxicity_sees_through_disguise(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(240):
        bad = k % 3 == 0
        rows.append((k, words(rng, 30) + (" you scoundrel " if bad else " you neighbour ") + words(rng, 20)))
        labels.append((k, int(bad)))
    rows += [(900, "x you sc0undr3l y"), (901, "you s c o u n d r e l"), (902, "you scoooundrel"), (903, "you s.c.o.u.n.d.r.e.l"), (904, "you neighbour"), (905, ""), (906, None)]
    d, lab = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(d, lab).collect()}
    assert [got[k] for k in range(240)] == [y for _, y in labels]
    assert [got[k] for k in range(900, 907)] == [1, 1, 1, 1, 0, 0, 0]
    assert toxicity.toxicity(empty(spark), lab).count() == 0


def test_long_and_unevenly_spaced_disguises_are_restored_whole():
    plain = toxicity.Restorer(np.zeros((toxicity.SYMBOLS,) * 3))
    _, spaced = toxicity._readers(np.zeros((toxicity.SYMBOLS,) * 3), None)
    for n in (31, 32, 33, 63, 64, 65, 129, 400):
        word = "".join("abcdefgh"[k * k % 7 + k % 2] for k in range(n))
        word = "".join(c for k, c in enumerate(word) if not k or word[k - 1] != c)
        assert word in toxicity.words_of(".".join(word), plain)
        assert f"={word}" in spaced[" ".join(word)]
    for gap in ("  ", "\t", "\n", " \r\n ", "\u00a0"):
        assert list(toxicity.stretches("you " + gap.join("scoundrel") + " there"))[0] == "s c o u n d r e l"
    assert "s c o u n d r e l" in toxicity.stretches("y o u  s c o u n d r e l")
    assert toxicity.words_of("@$$", plain) == ["as"] and toxicity.words_of("455", plain) == ["as"]
    assert toxicity.words_of("5", plain) == [] and toxicity.words_of("...", plain) == []
    assert plain.restore("a" * 20_000) == "a" * 20_000 and len(plain.restore("ab" * 100_000)) == 200_000


def test_registered_names():
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    d = "/root/testdata/sf0.001"
    before = P.table(spark, d, "documents")
    kept = P.reliable_checkpoint(P.quality(spark, before, d))
    bad = P.table(spark, d, "labels").where("quality = 0").join(before, "doc_id")
    assert kept.columns == before.columns and kept.join(bad, "doc_id").count() == 0
    assert P.table(spark, d, "labels").where("quality = 1").join(before, "doc_id").join(kept, "doc_id", "left_anti").count() == 0
    one = P.reliable_checkpoint(P.near_duplicates(spark, kept, d))
    want = brute_components([(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()])
    assert sorted(r.doc_id for r in one.select("doc_id").collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    assert P.run(spark, d).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


#: Names that the operators use inside, as columns of the input.
CLASHES = ["__gone", "__twice", "__n", "__doc", "__spans", "__row", "__level0", "count", "budget"]


def clashing(spark, rows):
    df = docs(spark, rows)
    for k, name in enumerate(CLASHES):
        df = df.withColumn(name, F.lit(k))
    return df.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("host7")})


def test_names_of_columns_cannot_clash(spark):
    rng = random.Random(21)
    a, b, c = words(rng, 80), words(rng, 40), words(rng, 90)
    rows = [(1, a), (2, a), (3, f"{b} {a} {b[::-1]}"), (4, c), (4, "second text of four"), (None, c), (5, None), (6, "")]
    df = clashing(spark, rows)
    one = jaccard.one_of_each(df)
    assert one.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in one.collect()), key=str) == sorted(
        [(1, a), (3, rows[2][1]), (4, min(c, "second text of four")), (None, c), (5, None), (6, "")], key=str)
    assert all(r[name] == k for r in one.collect() for k, name in enumerate(CLASHES))
    cut = passages.cut_passages(df, spark.createDataFrame([(3, 40, 120)], "doc_id long, start_word long, end_word long"))
    assert cut.columns == df.columns and {r.doc_id: r.text for r in cut.where("doc_id = 3").collect()} == {3: f"{b} {b[::-1]}"}
    assert cut.count() == len(rows) and all(r[name] == k for r in cut.collect() for k, name in enumerate(CLASHES))


def test_pipeline_takes_nulls_repeats_clashing_names_and_empty_tables(spark):
    import corpus_pipeline as P

    d, rng = "/root/testdata/sf0.001", random.Random(22)
    a = words(rng, 120)
    rows = [(10**9 + k, words(rng, 60)) for k in range(5)] + [(10**9 + 9, a), (10**9 + 10, a), (None, "no id"), (10**9 + 11, None), (10**9 + 12, "")]
    odd = clashing(spark, rows)
    whole = P.table(spark, d, "documents").unionByName(odd, allowMissingColumns=True)
    for start in (whole, odd.limit(0)):
        at = P.reliable_checkpoint(start)
        for name, stage in P.STAGES:
            after = P.reliable_checkpoint(stage(spark, at, d))
            assert (after.columns == at.columns) == (name != "token_ids")
            at = after
        assert (at.count() > 0) == (start is whole)
