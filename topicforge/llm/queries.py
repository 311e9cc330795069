"""The registered queries of the training-data operators: each applies its operator, with production
parameters, to its whole table.  ``ORACLE_SQL`` has DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicforge.llm import (alignment, bpe, byte_bpe, jaccard, line_crf, mixing, passages, prefix_trie, quality_model, token_counts,
                            token_files, topk, toxicity)
from topicforge.llm.batches import table
from topicforge.session import ensure_checkpoint_dir, reliable_checkpoint

WORD_BPE, BYTE_BPE, BYTE_RANKS, PIECES = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
END_ID = 1
TOKEN_LIMIT = 512

# The mix: sources fall into four domains by the last digit of their name; weights by path, 1 if not given.
MIX_WEIGHTS = {"d0": 2, "d1": 3, "d2": 3, "d3": 2, **{f"d{k}/{lang}": w for k in range(4) for lang, w in (("en", 5), ("de", 2), ("fr", 2), ("es", 1))}}
MIX_BUDGET_PERCENT, MIX_EPOCHS, MIX_SEED = 80, 2, "mix-1"


def mix_levels() -> dict:
    return {"domain": F.concat(F.lit("d"), F.coalesce(F.expr("try_cast(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) as bigint)") % 4, F.lit(0)).cast("string")),
            "lang": F.col("lang"), "source": F.col("source")}


def mix_weights(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{path}', {weight}L)" for path, weight in sorted(MIX_WEIGHTS.items()))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS weights(path, weight)")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), give="digest")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"), passages.MIN_WORDS, passages.PERCENT)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token_files/{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), END_ID)
    return token_files.read_token_files(spark, path, digest=True)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mix(table(spark, sf_dir, "documents"), mix_levels(), mix_weights(spark), MIX_BUDGET_PERCENT, MIX_EPOCHS, MIX_SEED)
    return rows


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), TOKEN_LIMIT)


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_model.score_quality(docs, quality_model.fit_quality(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), jaccard.SHINGLE, jaccard.PERCENT)


def op9_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_crf.mark_lines(docs, line_crf.fit_lines(docs, table(spark, sf_dir, "labels")))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10).drop("query_key")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.byte_bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS),
                                        public_tokenizers.PATTERN, give="digest")


def rebuilt(turns: DataFrame) -> DataFrame:
    """The conversations that op12 works on, of numbered turns: conversation c has the first h turns of
    conversation c - c % 20 (h is crc32 of c as text, mod 4), then its own turns after its first h."""
    shared = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 4
    own = turns.where(F.col("ord") > shared).select("conv_id", F.col("ord").alias("turn"), "digest", "n_words")
    heads = turns.where("conv_id % 20 = 0 AND ord <= 3").withColumnRenamed("conv_id", "head")
    lent = (turns.select("conv_id").distinct().withColumns({"head": F.expr("conv_id - conv_id % 20"), "h": shared})
            .join(heads, "head").where("ord <= h").select("conv_id", F.col("ord").alias("turn"), "digest", "n_words"))
    return own.unionByName(lent)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12(table(spark, sf_dir, "conversations"))


def op12(conversations: DataFrame) -> DataFrame:
    turns = reliable_checkpoint(prefix_trie.ordinals(prefix_trie.turn_digests(conversations)))
    return prefix_trie.trie(prefix_trie.ordinals(rebuilt(turns)), turns)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_passages": op2_passages,
    "op3_toxicity": op3_toxicity,
    "op4_token_files": op4_token_files,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_quality_model": op7_quality_model,
    "op8_jaccard": op8_jaccard,
    "op9_line_crf": op9_line_crf,
    "op10_topk": op10_topk,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_alignment": op13_alignment,
}

def _level_sql(k: int, names: list[str]) -> str:
    """One level of the budgets in SQL: the shares of ``names[k]`` within the budgets of level k - 1.  A node is
    full if all its siblings, filled to its own cap per weight or their caps, take no more than the budget."""
    here, above = ", ".join(names[:k + 1]), names[:k]
    family = f"PARTITION BY {', '.join(above)} " if above else ""
    on = " AND ".join(f"n.{c} = b.{c}" for c in above) or "true"
    path = " || '/' || ".join(f"l.{c}" for c in names[:k + 1])
    mine = ", ".join(f"n.{c}" for c in names[:k + 1])
    return f"""n{k} AS (SELECT {", ".join(f"l.{c}" for c in names[:k + 1])}, CAST(coalesce(w.weight, 1) AS HUGEINT) AS weight, l.cap
  FROM (SELECT {here}, CAST(sum(tokens) AS HUGEINT) * {MIX_EPOCHS} AS cap FROM sizes GROUP BY {here}) l LEFT JOIN weights w ON w.path = {path}),
f{k} AS (SELECT {mine}, n.weight, n.cap, any_value(s.budget) AS budget,
  CAST(sum(least(s.cap * n.weight, n.cap * s.weight)) AS HUGEINT) <= any_value(s.budget) * n.weight AS is_full
  FROM n{k} n JOIN (SELECT n.*, b.budget FROM n{k} n JOIN b{k} b ON {on}) s ON {on.replace("b.", "s.")} GROUP BY {mine}, n.weight, n.cap),
r{k} AS (SELECT *, budget - CAST(sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({family}) AS HUGEINT) AS rest,
  CAST(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({family}) AS HUGEINT) AS w FROM f{k}),
q{k} AS (SELECT *, CASE WHEN is_full THEN cap ELSE rest * weight // w END AS base,
  row_number() OVER ({family}ORDER BY CASE WHEN is_full THEN -1 ELSE rest * weight % w END DESC, {names[k]}) AS nth FROM r{k}),
b{k + 1} AS (SELECT {here}, CAST(base + CASE WHEN NOT is_full AND nth <= budget - sum(base) OVER ({family}) THEN 1 ELSE 0 END AS BIGINT) AS budget FROM q{k})"""


def _mix_sql() -> str:
    names = ["domain", "lang", "source"]
    weights = ", ".join(f"('{p}', {w})" for p, w in sorted(MIX_WEIGHTS.items()))
    return f"""WITH weights(path, weight) AS (VALUES {weights}),
k AS (SELECT doc_id, 'd' || CAST(coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) AS BIGINT) % 4, 0) AS VARCHAR) AS domain,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source, md5(coalesce(text, '')) AS text_key,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
sizes AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM k GROUP BY ALL),
b0 AS (SELECT CAST(coalesce(sum(tokens), 0) * {MIX_BUDGET_PERCENT} // 100 AS BIGINT) AS budget FROM sizes),
{", ".join(_level_sql(i, names) for i in range(3))},
leaf AS (SELECT z.*, CASE WHEN tokens = 0 THEN 0 ELSE budget // tokens END AS whole, CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END AS part
  FROM sizes z JOIN b3 USING (domain, lang, source)),
placed AS (SELECT k.*, whole, part, md5('{MIX_SEED}:' || CAST(whole AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || text_key) AS key
  FROM k JOIN leaf USING (domain, lang, source)),
ahead AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  - sum(n_tokens) OVER (PARTITION BY domain, lang, source, key) AS before FROM placed)
SELECT doc_id, domain, lang, source, n_tokens, CAST(whole + CASE WHEN before < part THEN 1 ELSE 0 END AS BIGINT) AS epochs
FROM ahead WHERE whole + CASE WHEN before < part THEN 1 ELSE 0 END > 0"""


_TOPK_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {"op5_mixing": _mix_sql(), "op10_topk": _TOPK_SQL}
