"""Operators 11 to 13: equal to the libraries or to brute force on small cases with nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from test_operators import docs, empty, texts, words
from tokenizers import Tokenizer

from topicforge.llm import alignment, batches, byte_bpe, ordered_hash, prefix_trie, queries

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_byte_bpe_is_the_librarys_and_decodes(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*texts(), (900, "a  b \n c d\n  e\u0085 f  g"), (901, "▁ \x00\x01 <0x41> <unk>"), (902, "word " * 30_000), (903, "q" * 20_000), (3, "again"), (None, "no id")]
    got = byte_bpe.byte_bpe_round_trip(docs(spark, rows), RANKS, public_tokenizers.PATTERN).collect()
    want = sorted((i is not None, i or 0, lib.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids, bytes(r.decoded)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    some = docs(spark, rows[:12])
    digest = byte_bpe.byte_bpe_round_trip(some, RANKS, public_tokenizers.PATTERN, give="digest").collect()
    for r in digest:
        t = rows[r.doc_id][1] or ""
        assert (r.ids_sha256, r.decoded_sha256) == (sha(np.array(lib.encode_ordinary(t), "<u4").tobytes()), sha(t.encode()))
    assert byte_bpe.byte_bpe_round_trip(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_takes_entries_that_no_merges_give_whole():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"cd": 300, b"xyz": 301}
    coder = byte_bpe.ByteBpe(byte_bpe.serialise(ranks), public_tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in ("xyz", "xyz abcd xyzab", "abab 7 cdcd\n\nxyz", ""):
        ids = np.frombuffer(coder.encode([t])[0], "<u4")
        assert ids.tolist() == lib.encode_ordinary(t) and coder.decode(ids) == t.encode()
    with pytest.raises(ValueError):
        byte_bpe.serialise({b"a": 0})
    with pytest.raises(ValueError):
        byte_bpe.serialise({bytes([b]): b for b in range(256)} | {b"ab": 7})


def test_what_a_coder_remembers_changes_nothing():
    coder = byte_bpe.ByteBpe(byte_bpe.serialise(byte_bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    some = [t or "" for _, t in texts()]
    want = coder.encode(some)
    coder.known.most = 3
    assert coder.encode(some) == want and [coder.encode([t])[0] for t in some] == want


def brute_trie(sequences):
    """Nodes of {conv_id: [(role, text), ...]}, straight from the definition."""
    members = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[tuple(sequences[c][:d])].append(c)
    n_words = lambda node: len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * n_words(node) + sum(saved[x] for x in children[node])
    return sorted((m[0], len(node), -1 if not node else members[node[:-1]][0], len(m), len(children[node]), leaves[node], saved[node],
                   sha(",".join(str(c) for c in m if len(sequences[c]) == len(node)).encode())) for node, m in members.items())


def rows_of(nodes):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in nodes.collect())


def talks(rng, n):
    """Conversations that share beginnings at every depth; some are equal, some beginnings of others."""
    lines = [(rng.choice(["user", "assistant", None, ""]), rng.choice([words(rng, rng.randint(1, 6)), "", None, " \t"])) for _ in range(4)]
    out = {}
    for c in range(n):
        base = list(out[rng.choice(list(out))]) if out and rng.random() < 0.8 else []
        out[c * 3] = base[:rng.randint(0, len(base))] + [rng.choice(lines) for _ in range(rng.choice([0, 1, 1, 2, 5]))]
    return {c: s for c, s in out.items() if s}


def table_of(spark, sequences):
    rows = [(c, None if k == 0 else k * 2, role, text, "x", 7) for c, s in sequences.items() for k, (role, text) in enumerate(s)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, k string, depth int")


def plain(sequences):
    return {c: [(r or "", t or "") for r, t in s] for c, s in sequences.items()}


def test_prefix_trie_against_brute_force(spark, monkeypatch):
    for seed in range(3):
        s = talks(random.Random(seed), 60)
        assert rows_of(prefix_trie.prefix_trie(table_of(spark, s))) == brute_trie(plain(s))
    long = [("u", f"w {k % 7}") for k in range(90)]
    s = {1: long, 2: long[:50], 3: long[:50] + [("u", "other")], 4: long, 5: [("a", "")], **{k: long[:1] for k in range(6, 30)}}
    want = brute_trie(plain(s))
    assert rows_of(prefix_trie.prefix_trie(table_of(spark, s))) == want
    monkeypatch.setattr(prefix_trie, "SPAN", 3)
    monkeypatch.setattr(ordered_hash, "PACK_BYTES", 8)
    assert rows_of(prefix_trie.prefix_trie(table_of(spark, s))) == want
    monkeypatch.setattr(prefix_trie, "BLOCK", 1)
    assert rows_of(prefix_trie.prefix_trie(table_of(spark, s))) == want
    assert prefix_trie.prefix_trie(table_of(spark, s).limit(0)).count() == 0


def test_prefix_trie_orders_ties_and_leaves_out_rows_without_id(spark):
    rows = [(1, 1, "a", "x y"), (1, 1, "b", "z"), (2, 1, "b", "z"), (2, 1, "a", "x y"), (None, 1, "a", "x"), (3, 1, "a", "x y"), (3, 1, "a", "x y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = rows_of(prefix_trie.prefix_trie(df))
    order = sorted([("a", "x y"), ("b", "z")], key=lambda t: hashlib.md5(f"{len(t[0])}:{t[0]}{t[1]}".encode()).hexdigest())
    assert got == brute_trie({1: order, 2: order, 3: [("a", "x y")] * 2})


def test_op12_rebuilds_conversations(spark):
    s = {k // 3: v for k, v in talks(random.Random(5), 90).items()}
    del s[20]  # so some conversations borrow from none
    p, made = plain(s), {}
    for c in p:
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = p.get(c - c % 20, [])[:h] + p[c][h:]
    assert any(not v for v in made.values())
    assert rows_of(queries.op12(table_of(spark, s))) == brute_trie(made)


def test_hashes_of_groups_in_order(spark, monkeypatch):
    rng = random.Random(2)
    groups = {k: rng.sample(range(-50, 5000), rng.choice([1, 2, 400])) for k in range(40)}
    df = spark.createDataFrame([(k, -k, v, str(v)) for k, vs in groups.items() for v in vs], "a long, b long, at long, part string")
    want = {k: sha(",".join(map(str, sorted(v))).encode()) for k, v in groups.items()}
    for pack in (1 << 16, 20):
        monkeypatch.setattr(ordered_hash, "PACK_BYTES", pack)
        packed = ordered_hash.packed(df, ["a", "b"], "at", "part", b",")
        assert packed.count() < df.count()
        assert {r.a: r.h for r in ordered_hash.hashed(packed, ["a", "b"], "at", "part", b",", "h").collect()} == want


JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    back = {c: b for b, c in enumerate(byte_bpe.LETTERS)}
    spell_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)

    def spell_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()

    def tokens(text):
        """(id, end) of both sides, or None."""
        if not text:
            return None
        out = []
        for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, spell_a), (b.encode(text), spell_b)):
            parts = [spell(i) for i in ids]
            if b"".join(parts) != (" " + text).encode():
                return None
            out.append(list(zip(ids, np.cumsum([len(p) for p in parts]).tolist())))
        return out

    return tokens


def brute_alignment(rows, tokens):
    made = []
    for i, t in rows:
        both = tokens(t)
        if both is None:
            made.append((i, 0, 0, "", []))
            continue
        a, b = both
        common = sorted({e for _, e in a} & {e for _, e in b})
        text = ";".join(",".join(str(x) for x, e in a if lo < e <= hi) + "|" + ",".join(str(x) for x, e in b if lo < e <= hi) for lo, hi in zip([0, *common], common))
        by_end = {e: x for x, e in b}
        made.append((i, len(a), len(b), sha(text.encode()), [(x, by_end[e]) for x, e in a if e in by_end]))
    counts, best = defaultdict(int), defaultdict(int)
    for *_, links in made:
        for link in links:
            counts[link] += 1
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((i is not None, i or 0), n_a, n_b, len(x), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), h) for i, n_a, n_b, h, x in made)


def aligned(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def long_texts():
    rng = random.Random(3)
    mixed = "".join(rng.choice(["\n", "\n\n", " ", "  ", "\t", "\u00a0", "日本語", "é", "'s", "x" * 30, "word", "1999", "!?"]) for _ in range(400))
    return [(800, mixed), (801, "z" * 900), (802, mixed.replace(" ", "\n")), (803, words(rng, 300)), (804, words(rng, 200) + " \u2581 " + words(rng, 50)), (800, mixed),
            (805, "\n".join(words(rng, 300).split()))]


def test_alignment_against_brute_force(spark, libraries):
    rows = [*texts(), *long_texts(), (901, "<|endoftext|> <unk> <s> <0x41>"), (902, "a\u2581b"), (903, " lead"), (904, "\nlead"), (905, "end "), (906, "e\u0301 \u0301x"), (None, "no id"), (3, "again")]
    want = brute_alignment(rows, libraries)
    run = lambda **more: aligned(alignment.cross_alignment(docs(spark, rows), JSON, MODEL, **more))
    assert run() == want
    assert run(chunk=37, fan=2) == want
    assert run(chunk=100, fan=3, broadcast_pairs=0) == want
    none = alignment.cross_alignment(empty(spark), JSON, MODEL)
    assert none.count() == 0


def test_links_are_counted_in_their_batch(spark):
    rows = spark.createDataFrame([([1, 1, 2], [5, 5, 6]), ([], []), ([1, 40_000], [5, 7])], "a array<int>, b array<int>").coalesce(1)
    assert sorted(map(tuple, alignment._counted(rows).collect())) == [(1, 5, 3), (2, 6, 1), (40_000, 7, 1)]
    assert alignment._counted(rows.limit(0)).count() == 0


def test_texts_are_aligned_some_at_a_time(spark, monkeypatch):
    """Batches of rows are cut by bytes, and how they are cut changes nothing."""
    docs = spark.createDataFrame([(k, "some words, " * (k % 7) + str(k)) for k in range(60)], "doc_id long, text string").coalesce(1)
    want = sorted(map(tuple, alignment.cross_alignment(docs, JSON, MODEL).collect()))
    sizes = batches.map_batches(docs, lambda b: batches.record(n=pa.array([b.num_rows])), "n long", 300).collect()
    assert sum(r.n for r in sizes) == 60 and len(sizes) > 5
    monkeypatch.setattr(alignment, "SLICE", 300)
    assert sorted(map(tuple, alignment.cross_alignment(docs, JSON, MODEL).collect())) == want


def test_fragments_compose_in_any_order():
    sides = alignment.Sides(alignment.read_spec(JSON, MODEL))
    rng, text = random.Random(7), " " + long_texts()[2][1][:600]
    a, b = sides.encode_a([text])[0], sides.encode_b([text])[0]
    ends_a, ends_b = np.cumsum(sides.size_a[a]), np.cumsum(sides.size_b[b])
    whole, closed = alignment.align(alignment.Open(np.array(a, np.int32), np.array(b, np.int32), 0, 0), sides)
    for _ in range(60):
        n = rng.randint(1, 9)
        ca, cb = ([0, *sorted(rng.choices(range(len(x) + 1), k=n)), len(x)] for x in (a, b))  # the sides' cuts need not agree
        parts = []
        for k in range(n + 1):
            at = [int(e[c[k] - 1]) if c[k] else 0 for e, c in ((ends_a, ca), (ends_b, cb))]
            f, c = alignment.align(alignment.Open(np.array(a[ca[k]:ca[k + 1]], np.int32), np.array(b[cb[k]:cb[k + 1]], np.int32), *at), sides)
            parts.append((f, [(2 * k, c)], k))
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            (f, x, last), (g, y, end) = parts[k:k + 2]
            h, c = alignment.compose(f, g, sides)
            parts[k:k + 2] = [(h, [*x, *y, (2 * last + 1, c)], end)]
        f, got, _ = parts[0]
        made = alignment.Closed()
        for _, c in sorted(got, key=lambda p: p[0]):
            made = made + c
        assert f.tail is not None and f.tail.empty
        assert (made.text, made.a.tolist(), f.head.a.tolist(), f.head.b.tolist()) == (closed.text, closed.a.tolist(), whole.head.a.tolist(), whole.head.b.tolist())


def test_buckets_of_a_word_by_one_checksum_a_gram(monkeypatch):
    """The plain rule, and that no gram of a plain word is encoded by itself."""
    from topicforge.llm import quality_model as Q

    def plain(word):
        marked = f"<{word}>"
        parts = [b"w" + word.encode()] + [b"g" + marked[i:i + n].encode() for n in Q.GRAMS for i in range(len(marked) - n + 1)]
        return [zlib.crc32(p) % (Q.BUCKETS - 1) + 1 for p in parts]

    for word in ("", "a", "the", "Größe", "日本語", "xİy", "a<b>c", "long" * 20):
        assert Q.word_features(word) == plain(word)

    class Word(str):
        encoded = 0

        def encode(self, *a):
            Word.encoded += 1
            return super().encode(*a)

        def __format__(self, spec):
            raise AssertionError("an ASCII word needs no marked text")

    assert Q.word_features(Word("thing")) == plain("thing") and Word.encoded == 1
