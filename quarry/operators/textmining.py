"""Text mining (N3-N7) and classification reports.

Tokenising, stop-word removal and n-grams are higher-order array
functions (codegen, no Python); TF-IDF is computed in long form
``(doc, term, weight)`` so nothing per-document is ever densified.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import WORD
from quarry.operators.joins import sized_broadcast
from quarry.session import cut_lineage

__all__ = ["stop_words", "spread", "raw_tokens", "with_tokens", "with_terms", "term_counts", "vocabulary", "tfidf", "top_words",
           "class_weights", "confusion", "classification_report", "compare_models",
           "improvement_over_baseline", "score_batches", "word_weights", "word_list_predictor"]

TOKEN_RE = WORD + "{2,}"


# The English stop words of Spark ML's StopWordsRemover, in its order.
STOP_WORDS_ENGLISH = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()


def stop_words() -> tuple[str, ...]:
    """English stop words (a constant: nothing is read when modules load)."""
    return tuple(STOP_WORDS_ENGLISH)


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Hash-repartition by ``key`` only when the input has fewer partitions than the
    cluster has cores.  Per-document tokenising is CPU-heavy; on many-file inputs
    this is a no-op.  The scan's own partitions decide; no file name reaches the
    driver's Python, and nothing runs."""
    par = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= par:
        return df
    return df.repartition(par, key) if key else df.repartition(par)


def raw_tokens(text) -> "F.Column":
    """Lower-cased word tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(text if not isinstance(text, str) else F.col(text)),
                                F.lit("(" + TOKEN_RE + ")"), 1)


def with_tokens(df: DataFrame, text_col: str, out: str = "tokens") -> DataFrame:
    """Tokens with stop words removed by Spark ML's ``StopWordsRemover``
    (hash-set lookup per token, JVM-side).  A null text has no tokens."""
    from pyspark.ml.feature import StopWordsRemover
    d = df.withColumn("_raw_tok", raw_tokens(F.coalesce(F.col(text_col), F.lit(""))))
    r = StopWordsRemover(inputCol="_raw_tok", outputCol=out, stopWords=list(stop_words()), caseSensitive=True)
    return r.transform(d).drop("_raw_tok")


def with_terms(docs: DataFrame, text_col: str, ngram_max: int = 2, out: str = "terms") -> DataFrame:
    """Unigrams plus n-grams (``"a b"``) of the stop-word-filtered tokens.

    Tokens are their own column; the k-th shifted copy ``slice(tok, k+1, n)``
    is zipped with it, so each n-gram is built from struct fields (no
    positional lookups, no re-tokenising)."""
    d = with_tokens(docs, text_col, "_t0")
    cols = ["_t0"]
    t = F.col("_t0")
    for n in range(2, ngram_max + 1):
        k = n - 1
        d = d.withColumn(f"_t{k}", F.slice(F.col("_t0"), k + 1, F.greatest(F.size("_t0"), F.lit(1))))
        cols.append(f"_t{k}")
        z = F.arrays_zip(*[F.col(c) for c in cols])
        cs = tuple(cols)
        grams = F.filter(F.transform(z, lambda x: F.when(x[cs[-1]].isNotNull(),
                                                         F.concat_ws(" ", *[x[c] for c in cs]))),
                         lambda g: g.isNotNull())
        t = F.concat(t, grams)
    return d.withColumn(out, t).drop(*cols)


def _counted(t: DataFrame, keys: Sequence[str], terms: str = "terms") -> DataFrame:
    """``(keys..., term, tf)`` of each row's own term array, without a shuffle: the
    array is sorted, and a term's count is the distance to the next term's first place.

    Each step stands behind a generator of one row, so that it is evaluated once
    and not copied into the lambdas of the next one."""
    once = lambda c, out: F.explode_outer(F.array(c)).alias(out)
    s = t.select(*keys, once(F.sort_array(terms), "_s"))
    firsts = F.filter(F.sequence(F.lit(0), F.size("_s") - 1), lambda i: (i == 0) | (F.get("_s", i) != F.get("_s", i - 1)))
    s = s.select(*keys, "_s", once(F.when(F.size("_s") > 0, firsts), "_b"))
    e = F.transform("_b", lambda b, k: F.struct(
        F.get("_s", b).alias("term"), (F.coalesce(F.get("_b", k + 1), F.size("_s")) - b).cast("long").alias("tf")))
    return s.select(*keys, F.explode_outer(e).alias("_e")).where(F.col("_e").isNotNull()) \
        .select(*keys, F.col("_e.term").alias("term"), F.col("_e.tf").alias("tf"))


def term_counts(docs: DataFrame, id_col: str, text_col: str, ngram_max: int = 2,
                keep: Sequence[str] = ()) -> DataFrame:
    """Long-form raw term frequencies ``(doc, [keep...], term, tf)``; ``keep``
    carries per-document columns (e.g. the split) so one tokenising pass can
    feed several consumers.

    A document is counted within its row, so no term is shuffled.  Only rows
    whose id (or null) comes more than once are added up by an aggregate; the ids
    alone are shuffled to find them."""
    keys = [id_col, *[c for c in keep if c != id_col]]
    src = docs.select(*keys, text_col)
    counted = lambda d: _counted(with_terms(spread(d, id_col), text_col, ngram_max), keys)
    again = cut_lineage(src.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(id_col).alias("_again")))
    if again.isEmpty():
        return counted(src)
    same, few = F.col(id_col).eqNullSafe(F.col("_again")), sized_broadcast(again)
    once, more = src.join(few, same, "left_anti"), src.join(few, same, "left_semi")
    return counted(once).unionByName(counted(more).groupBy(*keys, "term").agg(F.sum("tf").alias("tf")))


def vocabulary(tf: DataFrame, id_col: str, n_docs, max_features: int = 5000, min_df: int = 5,
               max_df: float = 0.8) -> DataFrame:
    """Terms with ``min_df <= df <= max_df * n_docs``, top ``max_features``
    by corpus count (ties -> term).  The result size is bounded by
    ``max_features``, so it may be broadcast."""
    s = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    s = s.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    return s.orderBy(F.desc("cf"), "term").limit(max_features)


def tfidf(tf: DataFrame, vocab: DataFrame, id_col: str, n_docs, digits: int = 6) -> DataFrame:
    """``tf * (ln((1 + n) / (1 + df)) + 1)``, L2-normalised per document."""
    v = vocab.select("term", (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1).alias("idf"))
    j = tf.join(F.broadcast(v), "term").withColumn("w", F.col("tf") * F.col("idf"))
    # per-document norm as a window on the doc key: one exchange (tf is already
    # aggregated by (doc, term), so a document's rows are bounded by its length)
    from pyspark.sql import Window
    nrm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return j.select(id_col, "term", F.round(F.col("w") / nrm, digits).alias("tfidf"))


def top_words(df: DataFrame, text_col: str, k: int = 200, digits: int = 6) -> DataFrame:
    """Word counts behind a word cloud: top ``k`` (ties -> word), relative to the max."""
    w = with_tokens(spread(df.select(text_col)), text_col, "_tk").select(F.explode_outer("_tk").alias("word")) \
        .where(F.col("word").isNotNull()).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n"))
    top = w.orderBy(F.desc("n"), "word").limit(k)
    mx = w.select(F.max("n")).scalar()
    return top.withColumn("relative", F.round(F.col("n") / mx, digits))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights ``n / (k * n_class)`` attached to every row.  Rows without
    a label are no class: they count in neither ``n`` nor ``k`` and stay, with a
    null weight."""
    c = cut_lineage(df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_nc")))
    n = c.select(F.sum("_nc")).scalar()
    k = c.select(F.count(F.lit(1))).scalar()
    w = c.select(label, (n / (k * F.col("_nc"))).alias(out))
    return df.join(sized_broadcast(w), label, "left")


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction",
              by: Sequence[str] = ()) -> DataFrame:
    """Tn, fp, fn, tp (binary 0/1) from one aggregate."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    aggs = [F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp")]
    return pred.groupBy(*by).agg(*aggs)


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                          by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Per class precision / recall / F1 / support, plus accuracy, macro and
    weighted averages, as rows ``(…by, row, precision, recall, f1, support)``."""
    cm = confusion(pred, label, prediction, by)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def prf(tp_, fp_, fn_):
        p = F.coalesce(F.try_divide(tp_.cast("double"), tp_ + fp_), F.lit(0.0))
        r = F.coalesce(F.try_divide(tp_.cast("double"), tp_ + fn_), F.lit(0.0))
        f = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
        return p, r, f
    p0, r0, f0 = prf(tn, fn, fp)
    p1, r1, f1 = prf(tp, fp, fn)
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1
    acc = (tp + tn) / n
    rows = cm.select(*by, F.array(
        F.struct(F.lit("0").alias("row"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("row"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("row"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), ((p0 * s0 + p1 * s1) / n).alias("precision"),
                 ((r0 * s0 + r1 * s1) / n).alias("recall"), ((f0 * s0 + f1 * s1) / n).alias("f1"),
                 n.alias("support"))).alias("_r"))
    e = rows.select(*by, F.explode("_r").alias("r"))
    return e.select(*by, F.col("r.row").alias("row"), F.round("r.precision", digits).alias("precision"),
                    F.round("r.recall", digits).alias("recall"), F.round("r.f1", digits).alias("f1"),
                    F.col("r.support").cast("bigint").alias("support"))


def compare_models(preds: Mapping[str, DataFrame], label: str = "label", prediction: str = "prediction",
                   digits: int = 4) -> DataFrame:
    """Accuracy and positive-class precision / recall / F1 per model."""
    from quarry.operators.aggregate import union_tagged
    u = union_tagged({k: v.select(label, prediction) for k, v in preds.items()}, "model")
    rep = classification_report(u, label, prediction, ["model"], 15)
    acc = rep.where(F.col("row") == "accuracy").select("model", F.col("f1").alias("accuracy"))
    pos = rep.where(F.col("row") == "1").select("model", "precision", "recall", "f1")
    j = acc.join(pos, "model")
    return j.select("model", *[F.round(c, digits).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


def improvement_over_baseline(comparison: DataFrame, baseline: str, digits: int = 4,
                              flag_points: float = 5.0) -> DataFrame:
    """Best model vs baseline: point deltas (x100), extra correct per 10,000, flag > 5 points."""
    best = comparison.orderBy(F.desc("accuracy"), "model").limit(1)
    base = comparison.where(F.col("model") == baseline).select(
        *[F.col(c).alias(f"b_{c}") for c in ("accuracy", "precision", "recall")])
    j = best.join(base, how="inner")
    d = lambda c: F.round((F.col(c) - F.col(f"b_{c}")) * 100, digits)
    return j.select(F.col("model").alias("best_model"), d("accuracy").alias("accuracy_gain_pts"),
                    d("precision").alias("precision_gain_pts"), d("recall").alias("recall_gain_pts"),
                    F.round((F.col("accuracy") - F.col("b_accuracy")) * 10000, 2).alias("extra_correct_per_10k"),
                    ((F.col("accuracy") - F.col("b_accuracy")) * 100 > flag_points).alias("significant"))


def score_batches(df: DataFrame, text_col: str, make_predictor: Callable[[], Callable[[pd.Series], pd.Series]],
                  out: str = "prediction") -> DataFrame:
    """Batch scoring with a pluggable predictor built ONCE per task
    (model load), applied to Arrow batches via ``mapInPandas``."""
    from pyspark.sql import types as T
    schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make_predictor()
        for b in batches:
            b[out] = predict(b[text_col]).astype("int32")
            yield b
    return df.mapInPandas(run, schema)


def word_weights(train: DataFrame, id_col: str, text_col: str, label: str, vocab: DataFrame) -> DataFrame:
    """Word-list model: ``ln((docs with term & label 1 + 1) / (docs with term & label 0 + 1))``
    over the (bounded) vocabulary unigrams."""
    dt = with_tokens(spread(train.select(id_col, label, text_col), id_col), text_col, "_tk") \
        .select(id_col, label, F.explode_outer(F.array_distinct("_tk")).alias("term")).where(F.col("term").isNotNull())
    v = vocab.select("term").where(~F.col("term").contains(" "))
    c = dt.join(F.broadcast(v), "term").groupBy("term").agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    return c.select("term", F.log((F.col("pos") + 1) / (F.col("neg") + 1)).alias("weight"))


def word_list_predictor(weights: Mapping[str, float], digits: int = 9):
    """Factory for :func:`score_batches` over a column of token arrays (tokenised
    by :func:`with_tokens`): sum of word weights > 0 -> positive.  A batch is
    scored at once: one lookup over all its tokens, one sum by row."""
    w = dict(weights)

    def make():
        import numpy as np

        def predict(tokens: pd.Series) -> pd.Series:
            rows = [t if t is not None else [] for t in tokens]
            row = np.repeat(np.arange(len(rows)), [len(t) for t in rows])
            flat = [x for t in rows for x in t]
            v = pd.Series(flat, dtype=object).map(w).fillna(0.0).to_numpy(dtype=float)
            return pd.Series((np.bincount(row, weights=v, minlength=len(rows)).round(digits) > 0).astype("int32"), index=tokens.index)
        return predict
    return make
