"""Operator 12: a trie of conversation prefixes by fixed-length block hashing.

The turns of a conversation are cut into blocks of ``BLOCK`` turns and each block is hashed.  A prefix that
ends with a block has the sum of position-keyed block hashes as its name, so all names of a conversation
come from running sums, however long it is.  Conversations are grouped by these names first: equal blocks
after equal prefixes become one row with its number of members.  Only where the blocks after one prefix
differ are their turn boundaries compared, on these grouped rows; elsewhere the turns inside a block have
the members of the block.

Every node belongs to its smallest member, which then owns all nodes below on its own path.  So each
conversation owns its path from one branching depth on, and the sums over subtrees are sums over members:
a node's leaves are its members that own a leaf, and what its subtree saves is, over its members but the
owner, the words from the node to where they branch off.  No step goes level by level.

Defined results: rows without conv_id are left out; turns are ordered by turn, null first, and equal turn
numbers by the MD5 of role and text; null role or text is empty; repeated rows are repeated turns; other
columns are not read.  An empty table has no node, not even a root.  Names have 128 bits.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicforge.llm import ordered_hash
from topicforge.session import reliable_checkpoint

#: Turns of a block, and blocks of a conversation that one window takes.
BLOCK, SPAN = 4, 1024
#: Words as the counts take them (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
LANES = [f"p{i}" for i in range(4)]
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_digests(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """conv_id, turn, digest (MD5 of role and text, hex), n_words: all that the trie needs of a turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    return conversations.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words")).where("conv_id IS NOT NULL")


def ordinals(turns: DataFrame) -> DataFrame:
    """``turns`` with ``ord``, a turn's number in its conversation from 1.  Turns are sorted by range, so a
    conversation of any length is spread over tasks; its number in a task is a difference of row numbers,
    and what stands in tasks before is one count a conversation and task."""
    key = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = reliable_checkpoint(turns.repartitionByRange(*key).sortWithinPartitions(*key).select(
        "*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("task")))
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = dealt.groupBy("conv_id", "task").agg(F.min("at").alias("begin"), F.count("*").alias("n"))
    runs = runs.select("conv_id", "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("begin") + 1).alias("shift"))
    return dealt.join(runs, ["conv_id", "task"]).select("conv_id", "turn", "digest", "n_words", (F.col("at") + F.col("shift")).alias("ord"))


def _hashes(k: Column, digest: Column) -> list[Column]:
    """Four 32-bit numbers of a block and its place; their sums stay below 2 ** 63."""
    out = []
    for seed in (1, 2):
        h = F.xxhash64(F.lit(seed), k, digest)
        out += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))]
    return out


def _name(lanes: list[Column]) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *lanes) for seed in (1, 2)]


def _digest(turns: Column, n: int | Column) -> Column:
    return F.md5(F.array_join(F.transform(F.slice(turns, 1, n), lambda t: t["digest"]), ""))


def blocks(turns: DataFrame) -> DataFrame:
    """One row a block of a conversation: conv_id, k, turns (at most BLOCK of digest and n_words), the sums
    before it (p0-p3), the words before it and its own name e1, e2."""
    placed = turns.select("conv_id", F.floor((F.col("ord") - 1) / BLOCK).alias("k"), F.struct("ord", "digest", "n_words").alias("t"))
    placed = placed.withColumn("span", F.floor(F.col("k") / SPAN)).repartition("conv_id", "span")
    made = placed.groupBy("conv_id", "span", "k").agg(F.array_sort(F.collect_list("t")).alias("t"))
    made = made.withColumn("turns", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["n_words"].alias("n_words"))))
    made = made.select("conv_id", "span", "k", "turns", F.aggregate("turns", F.lit(0).cast("bigint"), lambda s, t: s + t["n_words"]).alias("words"),
                       _digest(F.col("turns"), F.size("turns")).alias("digest"))
    for lane, h in zip(LANES, _hashes(F.col("k"), F.col("digest"))):
        made = made.withColumn(lane, h)
    sums = [*LANES, "words"]
    inside = Window.partitionBy("conv_id", "span").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    made = reliable_checkpoint(made.select("conv_id", "span", "k", "turns", *sums, *(
        F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"in_{c}") for c in sums)))
    # What stands in the spans before: no rows unless a conversation has more than one span.
    spans = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    whole = made.groupBy("conv_id", "span").agg(*(F.sum(c).alias(c) for c in sums))
    ahead = whole.select("conv_id", "span", *(F.sum(c).over(spans).alias(f"far_{c}") for c in sums)).where("span > 0")
    made = made.join(ahead, ["conv_id", "span"], "left")
    total = {c: F.col(f"in_{c}") + F.coalesce(F.col(f"far_{c}"), F.lit(0)) for c in sums}
    made = made.select("conv_id", "k", "turns", *(F.col(c).alias(f"own_{c}") for c in LANES), *(total[c].alias(c) for c in LANES),
                       total["words"].alias("before"))
    e1, e2 = _name([F.col(c) + F.col(f"own_{c}") for c in LANES])
    return made.select("conv_id", "k", "turns", *LANES, "before", e1.alias("e1"), e2.alias("e2"))


def _nodes(groups: DataFrame, sums: list[str]) -> DataFrame:
    """All nodes but the root, of blocks grouped by name: name (a1, a2), name of the parent (b1, b2), depth,
    words before the node's turn, n, owner, ends and ``sums``.  Blocks marked ``split`` have siblings that
    differ; their turn boundaries are compared.  The others' turns are nodes as they are."""
    turns, k = F.col("turns"), F.col("k")
    names = [_name([F.col(c) for c in LANES])]
    names += [_name([F.col(c) + h for c, h in zip(LANES, _hashes(k, _digest(turns, j)))]) for j in range(1, BLOCK + 1)]
    each = []
    words: Column = F.col("before")
    for j in range(1, BLOCK + 1):
        last = F.size("turns") == j
        each.append(F.when(F.size("turns") >= j, F.struct(
            names[j][0].alias("a1"), names[j][1].alias("a2"), names[j - 1][0].alias("b1"), names[j - 1][1].alias("b2"),
            (k * BLOCK + j).alias("depth"), words.alias("before"), F.when(last, F.col("ends")).otherwise(0).alias("ends"))))
        words = words + F.coalesce(F.get(turns, F.lit(j - 1))["n_words"], F.lit(0))
    rows = groups.select("split", "n", "owner", *sums, F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x"))
    rows = rows.select("split", "x.*", "n", "owner", *sums)
    name = ["a1", "a2", "b1", "b2", "depth", "before"]
    refined = rows.where("split").groupBy(*name).agg(
        F.sum("ends").alias("ends"), F.sum("n").alias("n"), F.min("owner").alias("owner"), *(F.sum(c).alias(c) for c in sums))
    return refined.unionByName(rows.where("NOT split").drop("split"))


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of numbered turns (conv_id, digest, n_words, ord) of the conversations ``convs`` (conv_id,
    those without a turn included)."""
    convs = convs.select("conv_id").distinct()
    cut = reliable_checkpoint(blocks(turns))
    long = cut.groupBy("conv_id").agg(F.max("k").alias("last_k"), F.sum(F.size("turns")).cast("bigint").alias("n_turns"), F.sum(
        F.aggregate("turns", F.lit(0).cast("bigint"), lambda s, t: s + t["n_words"])).alias("words"))
    long = reliable_checkpoint(convs.join(long, "conv_id", "left").select(
        "conv_id", "last_k", F.coalesce("n_turns", F.lit(0)).alias("n_turns"), F.coalesce("words", F.lit(0)).alias("words")))
    marked = cut.join(long.select("conv_id", "last_k"), "conv_id").withColumn("last", F.when(F.col("k") == F.col("last_k"), 1).otherwise(0))

    # Blocks by name; a prefix after which more than one block stands has its blocks split.
    payload = ["e1", "e2", *LANES, "k", "before", "turns"]
    groups = reliable_checkpoint(marked.groupBy(*payload).agg(F.count("*").alias("n"), F.min("conv_id").alias("owner"), F.sum("last").alias("ends")))
    differ = groups.groupBy(*LANES, "k").agg(F.count("*").alias("next")).where("next > 1").select(*LANES, "k", F.lit(True).alias("split"))
    groups = reliable_checkpoint(groups.join(differ, [*LANES, "k"], "left").withColumn("split", F.coalesce("split", F.lit(False))))

    r1, r2 = _name([F.lit(0).cast("bigint")] * 4)
    none = F.lit(None).cast("bigint")

    def root(of: DataFrame, sums: list[str]) -> DataFrame:
        return of.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n"), F.sum((F.col("n_turns") == 0).cast("bigint")).alias("ends"),
                      *(F.sum(c).alias(c) for c in sums)).where("n > 0").select(
            r1.alias("a1"), r2.alias("a2"), none.alias("b1"), none.alias("b2"), F.lit(0).cast("bigint").alias("depth"),
            F.lit(0).cast("bigint").alias("before"), "ends", "n", "owner", *sums)

    # Where each conversation branches off, the words before that, and whether it owns a leaf.
    owned = root(long, []).unionByName(_nodes(groups, [])).groupBy("owner").agg(
        F.min("depth").alias("branch"), F.min("before").alias("until"), F.max((F.col("ends") == F.col("n")).cast("bigint")).alias("leaf"))
    own = reliable_checkpoint(long.join(owned, long["conv_id"] == owned["owner"], "left").select(
        "conv_id", "n_turns", "branch", F.coalesce("until", "words").alias("until"), F.coalesce("leaf", F.lit(0)).alias("leaf")))

    # Sums over members: by block first, then by node.
    sums = cut.select("conv_id", "e1", "e2").join(own.select("conv_id", "until", "leaf"), "conv_id").groupBy("e1", "e2").agg(
        F.sum("until").alias("until"), F.sum("leaf").alias("leaf"))
    nodes = reliable_checkpoint(root(own, ["until", "leaf"]).unionByName(_nodes(groups.join(sums, ["e1", "e2"]), ["until", "leaf"])))

    # Conversations that end at a node, in the order of their ids.
    ending = marked.where("last = 1").select(F.col("e1").alias("a1"), F.col("e2").alias("a2"), "conv_id").unionByName(
        long.where("n_turns = 0").select(r1.alias("a1"), r2.alias("a2"), "conv_id"))
    parts = ordered_hash.packed(ending.withColumn("id_text", F.col("conv_id").cast("string")), ["a1", "a2"], "conv_id", "id_text", b",")
    ends = ordered_hash.hashed(parts, ["a1", "a2"], "conv_id", "id_text", b",", "ends_sha256")

    # A node's parent has another owner only where the node's owner branches off.
    info = own.select(F.col("conv_id").alias("owner"), "branch", F.col("n_turns").alias("owner_turns"), F.col("until").alias("owner_until"))
    placed = reliable_checkpoint(nodes.join(info, "owner"))
    forks = placed.where("depth = branch AND depth > 0").select("a1", "a2", "b1", "b2")
    parents = nodes.select(F.col("a1").alias("b1"), F.col("a2").alias("b2"), F.col("owner").alias("parent_owner"))
    forks_of = forks.groupBy("b1", "b2").agg(F.count("*").alias("forks")).select(F.col("b1").alias("a1"), F.col("b2").alias("a2"), "forks")
    marks = (forks.join(parents, ["b1", "b2"]).select("a1", "a2", "parent_owner").join(forks_of, ["a1", "a2"], "full")
             .join(ends, ["a1", "a2"], "full"))
    out = placed.join(marks, ["a1", "a2"], "left")
    goes_on = (F.col("owner_turns") > F.col("depth")).cast("bigint")
    return out.select(
        F.col("owner").alias("conv_id"), "depth",
        F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("branch"), F.col("parent_owner")).otherwise(F.col("owner")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), (F.coalesce("forks", F.lit(0)) + goes_on).alias("n_children"), F.col("leaf").alias("n_leaves"),
        (F.col("until") - F.col("owner_until") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row a node, that is a distinct sequence of the first d turns of some conversation: conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = reliable_checkpoint(turn_digests(conversations, conv_col, turn_col, role_col, text_col))
    return trie(ordinals(turns), turns)
