"""Most frequent terms (N4, N6) without a shuffle of the whole vocabulary."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.joins import sized_broadcast
from quarry.operators.textmining import spread, with_terms, with_tokens
from quarry.session import cut_lineage

__all__ = ["frequent_terms", "vocabulary_frequent", "top_words_frequent"]

BUCKETS = 1 << 20


def frequent_terms(rows: DataFrame, k: int, term: str = "term", cf: str = "cf", df: str | None = None,
                   keep: Column | None = None, least: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` terms of largest sum of ``cf`` (ties: the smaller term), with their sums
    of ``cf`` and ``df``; ``keep`` is a condition on these sums.  Exact.

    ``rows`` holds a term, its whole positive weight ``cf`` and, if asked for,
    ``df``.  First pass: weights by hash bucket of the term, a sketch that merges
    by addition and has at most ``buckets`` rows.  Second pass: exact sums of the
    terms in the ``4 k`` heaviest buckets only.  A term outside them weighs at
    most its bucket, so none is missed if every other bucket is lighter than the
    ``k``-th term found; the terms of buckets that are not are summed in a third
    pass.  With fewer than ``k`` found, those are the buckets of weight
    ``least`` or more (no term that ``keep`` accepts may weigh less).

    ``rows`` is read twice or three times; what is shuffled is bounded by
    the buckets and by the candidates, not by the vocabulary."""
    sums = [cf, *([df] if df else [])]
    src = rows.where(F.col(term).isNotNull()).select(F.pmod(F.xxhash64(term), F.lit(buckets)).alias("_b"), F.col(term), *sums)
    sketch = cut_lineage(src.groupBy("_b").agg(F.sum(cf).alias("_total")))
    first = cut_lineage(sketch.orderBy(F.desc("_total"), "_b").limit(4 * k))

    def best(chosen: DataFrame) -> DataFrame:
        few = sized_broadcast(chosen.select("_b"), rows_bound=buckets)
        t = src.join(few, "_b", "left_semi").groupBy(term).agg(*[F.sum(c).alias(c) for c in sums])
        return (t if keep is None else t.where(keep)).orderBy(F.desc(cf), term).limit(k)
    top = cut_lineage(best(first))
    found = top.agg(F.count(F.lit(1)).alias("n"), F.min(cf).alias("w")).first()
    bar = found["w"] if found["n"] >= k else least
    rest = cut_lineage(sketch.join(sized_broadcast(first.select("_b"), rows_bound=4 * k), "_b", "left_anti").where(F.col("_total") >= bar))
    if rest.isEmpty():
        return top.orderBy(F.desc(cf), term)
    return top.unionByName(best(rest)).orderBy(F.desc(cf), term).limit(k)


def vocabulary_frequent(docs: DataFrame, id_col: str, text_col: str, n_docs, max_features: int = 5000, min_df: int = 5, max_df: float = 0.8,
                        ngram_max: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """N4 straight from the texts: ``(term, df, cf)`` as :func:`~quarry.operators.textmining.vocabulary`
    gives, without counts by document and term.

    Each text sends an entry for every occurrence of a term and one for the
    term itself; their sums are ``cf`` and ``df``."""
    one = lambda c, d: lambda x: F.struct(x.alias("term"), F.lit(c).alias("cf"), F.lit(d).alias("df"))
    t = with_terms(spread(docs.select(id_col, text_col), id_col), text_col, ngram_max)
    e = F.concat(F.transform("terms", one(1, 0)), F.transform(F.array_distinct("terms"), one(0, 1)))
    rows = t.select(F.explode_outer(e).alias("e")).select("e.*")
    keep = (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs)
    return frequent_terms(rows, max_features, df="df", keep=keep, least=max(min_df, 1), buckets=buckets).select("term", "df", "cf")


def top_words_frequent(df: DataFrame, text_col: str, k: int = 200, digits: int = 6, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` most frequent words (ties: the smaller word), relative to the first."""
    w = with_tokens(spread(df.select(text_col)), text_col, "_tk").select(F.explode_outer("_tk").alias("word"), F.lit(1).alias("n"))
    top = cut_lineage(frequent_terms(w, k, term="word", cf="n", buckets=buckets))
    return top.withColumn("relative", F.round(F.col("n") / top.select(F.max("n")).scalar(), digits)).orderBy(F.desc("n"), "word")
