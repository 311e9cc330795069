"""ROUGE (E11, E12, E17).

A pair is scored where its row is: an Arrow helper counts the n-grams of
both sides, clips and sums them, and takes the longest common subsequences
of ROUGE-L/Lsum (the bit-parallel LCS helper), so the texts of a pair go
through no shuffle.  The numbers of each row are written once to the
checkpoint folder.  Rows that repeat a key are one pair to ROUGE-N: only
their n-grams are exploded and counted by (pair, gram).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicforge.functions.text import bind, tokens
from topicforge.llm.batches import map_arrow, slices
from topicforge.session import reliable_checkpoint

SCORE = T.StructType([
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
])


def ngrams(t: Column, n: int) -> Column:
    """Space-joined n-grams of a token array (empty if fewer than n): the
    array zipped with its shifted copies.  ``t`` is used several times, so
    give a bound value (``bind(tokens(c), ...)``), not an expression."""
    grams = t
    for k in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(t, k, 1 << 30), lambda g, w: F.concat(g, F.lit(" "), w))
    return F.slice(grams, 1, F.greatest(F.size(t) - F.lit(n - 1), F.lit(0)))


def _prf(hits: Column, n_pred: Column, n_ref: Column) -> list[Column]:
    p = hits / F.greatest(n_pred, F.lit(1))
    r = hits / F.greatest(n_ref, F.lit(1))
    f = F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))
    return [p.alias("precision"), r.alias("recall"), f.alias("f1")]


def _tagged_grams(pairs: DataFrame, keys: list[str], ns: Sequence[int], prediction: str,
                  reference: str) -> DataFrame:
    """(keys, n, g, p, r): every n-gram of both sides, tagged by side,
    from ONE generator per row (both sides, every n).  The empty gram,
    counted on no side, stands for a pair without n-grams."""
    def tag(n: int, p: int, r: int):
        return lambda g: F.struct(F.lit(n).alias("n"), g.alias("g"), F.lit(p).alias("p"), F.lit(r).alias("r"))

    def side(col: str, p: int, r: int) -> Column:  # each text is tokenised once
        return bind(tokens(col), lambda t: F.concat(*[F.transform(ngrams(t, n), tag(n, p, r)) for n in ns]))

    entries = [side(prediction, 1, 0), side(reference, 0, 1)]
    entries.append(F.array(*[F.struct(F.lit(n).alias("n"), F.lit("").alias("g"), F.lit(0).alias("p"), F.lit(0).alias("r")) for n in ns]))
    return pairs.select(*keys, F.explode(F.concat(*entries)).alias("_e")).select(*keys, "_e.*")


def _measures(ns: Sequence[int], kinds: Sequence[str]) -> Callable[[str | None, str | None], list]:
    """A function of a pair of texts: for each n the clipped overlap and the number of n-grams of
    both sides, then the scores of each kind of LCS.  What it makes of a reference it keeps for the next
    pair, which often has the same."""
    from topicforge.functions import lcs

    def side(text: str | None) -> tuple:
        lines = lcs.sentence_tokens(text) if "Lsum" in kinds else None
        toks = lcs.tokenize(text) if lines is None else [t for line in lines for t in line] if ns or "L" in kinds else []
        grams = [(Counter(zip(*(toks[k:] for k in range(n)))), max(len(toks) - n + 1, 0)) for n in ns]
        return toks, grams, lines

    last, made = None, side(None)

    def score(prediction: str | None, reference: str | None) -> list:
        nonlocal last, made
        if reference != last:
            last, made = reference, side(reference)
        ref, ref_grams, ref_s = made
        pred, pred_grams, pred_s = side(prediction)
        out: list = []
        for (p, n_pred), (r, n_ref) in zip(pred_grams, ref_grams):
            out += [sum(min(c, r[g]) for g, c in p.items() if g in r), n_pred, n_ref]
        return out + [lcs.rouge_l_tokens(pred, ref) if k == "L" else lcs.rouge_lsum_tokens(pred_s, ref_s) for k in kinds]

    return score


def _scored(pairs: DataFrame, keys: list[str], prediction: str, reference: str, ns: Sequence[int] = (),
            kinds: Sequence[str] = ()) -> DataFrame:
    """Of every row: keys, whole (neither text is null), hits_n, np_n and nr_n for each n, a SCORE for each kind."""
    schema = pairs.select(*keys).schema
    names = [f"{c}_{n}" for n in ns for c in ("hits", "np", "nr")]
    numbers = [T.StructField(c, T.LongType()) for c in names] + [T.StructField(k, SCORE) for k in kinds]
    wide = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _measures(ns, kinds)
        for whole in batches:
            for b in slices(whole):
                rows = [score(p, r) for p, r in zip(b.column(wide + 1).to_pylist(), b.column(wide + 2).to_pylist())]
                columns = list(zip(*rows))
                of_kind = [pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in zip(*c)], ["precision", "recall", "f1"])
                           for c in columns[len(names):]]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:wide + 1], *(pa.array(c, pa.int64()) for c in columns[:len(names)]), *of_kind],
                    [*b.schema.names[:wide + 1], *names, *kinds])

    rows = pairs.select(*keys, (F.col(prediction).isNotNull() & F.col(reference).isNotNull()).alias("whole"),
                        F.col(prediction).alias("_prediction"), F.col(reference).alias("_reference"))
    return map_arrow(rows, run, T.StructType([*schema, T.StructField("whole", T.BooleanType()), *numbers]))


def _per_pair(scored: DataFrame, pairs: DataFrame, ns: Sequence[int], keys: list[str], prediction: str,
              reference: str) -> DataFrame:
    """(keys, n, precision, recall, f1) from the rows' own numbers; rows that repeat a key are counted
    together, gram by gram.  Rows with a null text count nowhere."""
    def wide(n: int) -> Column:
        return F.struct(F.lit(n).alias("n"), *[F.col(f"{c}_{n}").alias(c) for c in ("hits", "np", "nr")])

    whole = scored.where("whole")
    numbers = whole.select(*keys, F.explode(F.array(*[wide(n) for n in ns])).alias("_e")).select(*keys, "_e.*")
    repeated = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(
        *[F.col(k).alias(f"_again_{k}") for k in keys])
    if not repeated.isEmpty():
        def of(df: DataFrame, how: str) -> DataFrame:
            same = [F.col(k).eqNullSafe(F.col(f"_again_{k}")) for k in keys]
            return df.join(repeated, same, how)

        side = _tagged_grams(of(pairs, "left_semi"), keys, ns, prediction, reference)
        per_gram = side.groupBy(*keys, "n", "g").agg(F.sum("p").alias("cp"), F.sum("r").alias("cr"))
        numbers = of(numbers, "left_anti").unionByName(per_gram.groupBy(*keys, "n").agg(
            F.sum(F.least("cp", "cr")).alias("hits"), F.sum("cp").alias("np"), F.sum("cr").alias("nr")))
    return numbers.select(*keys, "n", *_prf(F.col("hits"), F.col("np"), F.col("nr")))


def rouge_n_multi(pairs: DataFrame, ns: Sequence[int] = (1, 2), keys: Sequence[str] = ("id", "system"),
                  prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """E11 for several n in one pass: (keys, n, precision, recall, f1)."""
    keys = list(keys)
    scored = reliable_checkpoint(_scored(pairs, keys, prediction, reference, ns))
    return _per_pair(scored, pairs, ns, keys, prediction, reference)


def rouge_n(pairs: DataFrame, n: int = 1, keys: Sequence[str] = ("id", "system"),
            prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Per pair, clipped n-gram precision / recall / F1."""
    return rouge_n_multi(pairs, (n,), keys, prediction, reference).drop("n")


def rouge_l(pairs: DataFrame, keys: Sequence[str] = ("id", "system"), prediction: str = "prediction",
            reference: str = "reference", summary_level: bool = False) -> DataFrame:
    """ROUGE-L (or ROUGE-Lsum with ``summary_level=True``) per pair."""
    keys, kind = list(keys), "Lsum" if summary_level else "L"
    return _scored(pairs, keys, prediction, reference, kinds=(kind,)).select(
        *keys, f"{kind}.precision", f"{kind}.recall", f"{kind}.f1")


def evaluate_summaries(pairs: DataFrame, keys: Sequence[str] = ("id", "system"),
                       group: str = "system", with_lcs: bool = True) -> DataFrame:
    """Mean ROUGE F1 per system (rouge1, rouge2[, rougeL, rougeLsum]).

    One pass over the pairs gives the numbers of all four; the mean is
    taken over pairs as ROUGE-N knows them, joined to the rows' LCS scores."""
    keys = list(keys)
    scored = reliable_checkpoint(_scored(pairs, keys, "prediction", "reference", (1, 2), ("L", "Lsum") if with_lcs else ()))
    rn = _per_pair(scored, pairs, (1, 2), keys, "prediction", "reference").groupBy(*keys).agg(
        F.max(F.when(F.col("n") == 1, F.col("f1"))).alias("rouge1"),
        F.max(F.when(F.col("n") == 2, F.col("f1"))).alias("rouge2"),
    )
    j = rn
    if with_lcs:
        j = rn.join(scored.select(*keys, F.col("L.f1").alias("rougeL"), F.col("Lsum.f1").alias("rougeLsum")), keys)
    metrics = [c for c in ("rouge1", "rouge2", "rougeL", "rougeLsum") if c in j.columns]
    return j.groupBy(group).agg(F.count(F.lit(1)).alias("pairs"), *[F.avg(m).alias(m) for m in metrics])
