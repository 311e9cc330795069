"""Operator 5: mixing sources to target weights by hierarchical budgets.

The levels (say domain, language, source) form a tree; a leaf is one combination.  Every node may carry a
whole-number weight (1 if none is given; 0 leaves the node and all below it out).  The token budget of the
whole is handed down: a node's budget is shared among its children in proportion to their weights, but no
child gets more than its documents can give in ``max_epochs`` passes.  What a child cannot take goes to its
siblings first; only what a whole family cannot take stays with the family's siblings, because the cap of a
family is the sum of its leaves' caps.  Proportional parts are rounded down and the tokens that this leaves
over go, one each, to the largest fractions, equal ones by name: the budgets of a family sum to its own or to
all its caps, whichever is less.

A leaf's budget is filled by epochs: whole passes over its documents, then a prefix, by tokens, of a pass in
an order seeded by the epoch (MD5 of seed, epoch and doc_id; equal doc_ids by text).  The prefix takes
documents while those before them hold fewer tokens than are left, so it passes the budget by less than one
document.

Everything is DataFrame and SQL functions.  No leaf is ordered in one task: tokens are summed by leaf and
leading hash digits, again inside the bucket that holds the boundary for as long as one has more than
``ORDERED`` rows, then that bucket is ordered by key, and the boundary keys (one row a leaf) are applied to
all rows.  Tables of one row a leaf are written first, so Spark knows their size and broadcasts small ones only.

Defined results: a negative weight is an error; a token is a word (``WORD``); null and empty texts have none
and come along with whole epochs alone; null levels and ids count as ''; repeated rows are documents of their own, ordered by text,
and rows equal in id and text stand or fall together; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicforge.llm.batches import id_text
from topicforge.session import reliable_checkpoint

WORD = r"[^\x20\x09-\x0D]+"
#: Hash digits by which a leaf, or a bucket of it, is cut into buckets: 16 ** DIGITS buckets.
DIGITS = 3
#: Digits of a whole key (MD5 in hex).
KEY_DIGITS = 32
#: A boundary bucket of more rows than this is cut again.
ORDERED = 10_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def _product(a: str, b: str) -> str:
    return f"cast({a} as decimal(19)) * cast({b} as decimal(19))"


def _share(children: DataFrame, budgets: DataFrame | int, above: list[str], level: str) -> DataFrame:
    """Budgets of one level from those above (a number for the root).  ``children``: above, level, weight, cap (0 if weight is 0).
    Among siblings in ascending order of cap per weight, those before the first that fits its proportional
    part are full; the rest share what is left, rounded down, and the largest fractions get one more.  That
    fits: a child that is not full has a cap above its part."""
    rows = children.join(budgets, above) if above else children.withColumn("budget", F.lit(budgets).cast("bigint"))
    # cap / weight, the whole part apart so that large caps are compared exactly
    order = [F.expr("if(weight = 0, 0, cap div greatest(weight, 1))"), F.expr("if(weight = 0, 0D, cap % greatest(weight, 1) / greatest(weight, 1))"), F.col(level)]
    siblings = Window.partitionBy(*above)
    upto = siblings.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"cap_upto": F.sum("cap").over(upto), "weight_upto": F.sum("weight").over(upto), "weight_all": F.sum("weight").over(siblings)})
    full = F.expr(f"{_product('cap', 'weight_all - weight_upto + weight')} <= {_product('greatest(0, budget - cap_upto + cap)', 'weight')}")
    # Once one is not full, none after it is.
    rows = rows.withColumn("is_full", full).withColumn("is_full", F.min("is_full").over(upto))
    rows = rows.withColumns({"rest": F.col("budget") - F.sum(F.expr("if(is_full, cap, 0)")).over(siblings),
                             "rest_weight": F.sum(F.expr("if(is_full, 0, weight)")).over(siblings)})
    rows = rows.withColumn("exact", F.expr(f"if(is_full, 0, {_product('rest', 'weight')})"))
    rows = rows.withColumns({"got": F.expr("if(is_full, cap, exact div greatest(rest_weight, 1))"), "fraction": F.expr("if(is_full, -1, exact % greatest(rest_weight, 1))")})
    spare = F.col("budget") - F.sum("got").over(siblings)
    turn = F.row_number().over(siblings.orderBy(F.desc("fraction"), level))
    rows = rows.withColumns({"spare": spare, "turn": turn})
    return rows.select(*above, level, F.expr("got + if(not is_full and turn <= spare, 1, 0)").cast("bigint").alias("budget"))


def leaf_budgets(sizes: DataFrame, levels: list[str], weights: DataFrame, budget_percent: int, max_epochs: int) -> DataFrame:
    """levels..., tokens, budget for every leaf.  ``sizes``: levels..., tokens.  ``weights``: (path string,
    weight bigint), path being the levels' values joined by '/'.  The budget of the whole is a percentage of
    all tokens.  Rows are leaves: as many as there are sources."""
    caps = sizes.withColumn("cap", F.col("tokens") * max_epochs)
    sound = weights.select("path", F.expr("if(weight < 0, raise_error(concat('negative weight of ', path)), cast(weight as bigint))").alias("weight"))
    for k in range(len(levels)):
        given = sound.select(F.col("path").alias("__path"), F.col("weight").alias(f"__weight{k}"))
        caps = (caps.withColumn("__path", F.concat_ws("/", *levels[:k + 1])).join(given, "__path", "left").drop("__path")
                .withColumn(f"__weight{k}", F.coalesce(f"__weight{k}", F.lit(1).cast("bigint"))))
    caps = caps.withColumn("cap", F.when(F.least(*(F.col(f"__weight{k}") for k in range(len(levels))), F.lit(1)) > 0, F.col("cap")).otherwise(0))
    caps = reliable_checkpoint(caps)
    budgets = caps.agg(F.expr(f"coalesce(sum(tokens), 0) * {budget_percent} div 100")).first()[0]
    for k, level in enumerate(levels):
        here = levels[:k + 1]
        nodes = caps.groupBy(*here).agg(F.sum("cap").alias("cap"), F.max(f"__weight{k}").alias("weight"))
        budgets = _share(nodes, budgets, levels[:k], level)
    return caps.select(*levels, "tokens").join(budgets, levels)


def mix(docs: DataFrame, levels: dict[str, Column], weights: DataFrame, budget_percent: int = 60, max_epochs: int = 2,
        seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Returns (rows, cuts).  ``rows``: doc_id, the levels, n_tokens and epochs (how often the document is
    taken, 1 at least) of the selected documents.  ``cuts``: one row a leaf (levels as __level0, ...) with its budget, its whole
    epochs and the last key of its prefix; ``apply_cuts`` selects from any table with it."""
    inner = _inner(levels)
    names = list(inner)
    keyed = _keyed(docs, inner, id_col, text_col).select("doc_id", *names, F.col("__md5_text").alias("text_key"), word_count(F.col("__text")).alias("n_tokens"))
    keyed = reliable_checkpoint(keyed)
    sizes = keyed.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    budgets = reliable_checkpoint(
        leaf_budgets(sizes, names, weights, budget_percent, max_epochs)
        .withColumn("whole", F.expr("case when tokens = 0 then 0 else budget div tokens end"))
        .withColumn("part", F.expr("case when tokens = 0 then 0 else budget % tokens end")))
    cuts = reliable_checkpoint(budgets.join(_last_keys(keyed, names, budgets, seed), names, "left"))
    own = [F.col(i).alias(n) for i, n in zip(names, levels)]
    return apply_cuts(keyed, names, cuts, seed).select("doc_id", *own, "n_tokens", "epochs"), cuts


def _last_keys(keyed: DataFrame, names: list[str], budgets: DataFrame, seed: str) -> DataFrame:
    """levels, last_key: the last key inside the prefix of each leaf that takes a part of a pass."""
    placed = keyed.join(budgets.where("part > 0").select(*names, "whole", "part"), names).withColumn("key", _order_key(seed, F.col("whole")))
    before = Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    rows, digits = placed.withColumn("start", F.lit(0).cast("bigint")), 0
    while True:
        # The last bucket that begins inside the prefix; rows without tokens after it are not taken.
        digits = min(digits + DIGITS, KEY_DIGITS)
        by_bucket = (rows.withColumn("bucket", F.substring("key", 1, digits)).groupBy(*names, "part", "start", "bucket")
                     .agg(F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("n_rows")))
        starts = by_bucket.withColumn("start", F.col("start") + F.coalesce(F.sum("n").over(before), F.lit(0))).where("start < part")
        edge = reliable_checkpoint(starts.groupBy(*names).agg(F.max(F.struct("bucket", "start", "n_rows")).alias("e")).select(*names, "e.*"))
        rows = (placed.withColumn("bucket", F.substring("key", 1, digits)).join(edge.drop("n_rows"), [*names, "bucket"]))
        largest = edge.agg(F.max("n_rows")).first()[0]
        if largest is None or largest <= ORDERED or digits == KEY_DIGITS:
            break
    by_key = rows.groupBy(*names, "part", "start", "key").agg(F.sum("n_tokens").alias("own"))
    ahead = F.col("start") + F.coalesce(F.sum("own").over(before.orderBy("key")), F.lit(0))
    return by_key.withColumn("ahead", ahead).where("ahead < part").groupBy(*names).agg(F.max("key").alias("last_key"))


def _inner(levels: dict[str, Column]) -> dict[str, Column]:
    """The levels under names that cannot clash with the columns made here."""
    return {f"__level{k}": c for k, c in enumerate(levels.values())}


def _keyed(docs: DataFrame, levels: dict[str, Column], id_col: str, text_col: str) -> DataFrame:
    # levels are read from the input's own columns before anything of ours is named, so names cannot clash
    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
                        *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()))
    return given.withColumn("__md5_text", F.md5(F.encode("__text", "UTF-8")))


def _order_key(seed: str, epoch: Column) -> Column:
    return F.md5(F.encode(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                   F.lit(":"), F.col("text_key")), "UTF-8"))


def apply_cuts(keyed: DataFrame, names: list[str], cuts: DataFrame, seed: str) -> DataFrame:
    """``keyed`` (doc_id, levels, text_key, anything else) with epochs, rows taken at least once; map-side
    while the cuts, one row a leaf, are small enough for Spark to broadcast."""
    took = F.col("last_key").isNotNull() & (_order_key(seed, F.col("whole")) <= F.col("last_key"))
    return (keyed.join(cuts.select(*names, "whole", "last_key"), names)
            .withColumn("epochs", F.col("whole") + F.when(took, 1).otherwise(0)).where("epochs > 0").drop("whole", "last_key"))


def mixed_documents(docs: DataFrame, levels: dict[str, Column], weights: DataFrame, budget_percent: int, max_epochs: int,
                    seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the mix takes, all their columns, each as often as it has epochs."""
    inner = _inner(levels)
    names = list(inner)
    _, cuts = mix(docs, levels, weights, budget_percent, max_epochs, seed, id_col, text_col)
    own = docs.columns
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in own)).alias("__row"), F.col(id_col).cast("bigint").alias("doc_id"),
                         F.md5(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")).alias("text_key"),
                         *(F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in inner.items()))
    taken = apply_cuts(packed, names, cuts, seed)
    return (taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("epochs").cast("bigint"))))
            .select(*(F.col("__row").getField(c).alias(c) for c in own)))
