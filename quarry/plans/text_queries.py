"""Text workload: terms, vocabulary, TF-IDF, word counts, scoring and reports."""
from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import frequent as H
from quarry.operators import textmining as N
from quarry.plans import standins as S
from quarry.plans.registry import register, with_
from quarry.plans.stats_queries import LABELLED_SQL, labelled

STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in N.stop_words()) + "]"
TOK = r"list_filter(regexp_extract_all(lower({t}), '([\p{{L}}\p{{N}}_]{{2,}})', 1), lambda x: NOT list_contains(" + STOP_SQL + ", x))"


def tok_sql(name, src, id_col="doc_id", extra=""):
    return f"""{name} AS (SELECT {id_col}{extra}, {TOK.format(t='text')} AS t FROM {src})"""


def terms_sql(name, tokname, id_col="doc_id"):
    return f"""{name} AS (
  SELECT {id_col}, term, count(*) AS tf FROM (
    SELECT {id_col}, unnest(t) AS term FROM {tokname}
    UNION ALL
    SELECT {id_col}, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM {tokname})
  GROUP BY {id_col}, term)"""


TRAIN_SQL = (LABELLED_SQL, "train AS (SELECT * FROM lab WHERE split = 'train')",
             tok_sql("train_tok", "train", extra=", label"), terms_sql("train_tf", "train_tok"),
             "ntr AS (SELECT count(*) AS n FROM train)",
             """vocab AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM train_tf GROUP BY term
  HAVING count(*) >= 5 AND count(*) <= 0.8 * (SELECT n FROM ntr) ORDER BY cf DESC, term LIMIT 5000)""")


def train_parts(spark, d):
    lab = labelled(spark, d)
    train = lab.where(F.col("split") == "train")
    n = train.select(F.count(F.lit(1))).scalar()
    # one tokenising pass over all labelled documents; the vocabulary is fit
    # on the train rows of the same term table
    lab_tf = N.term_counts(lab, "doc_id", "text", keep=["split"])
    tf = lab_tf.where(F.col("split") == "train").drop("split")
    vocab = N.vocabulary(tf, "doc_id", n, 5000, 5, 0.8)
    return lab, train, n, lab_tf.drop("split"), vocab


@register("N3_terms_unigram_bigram_tf", with_(tok_sql("tok", "documents"), terms_sql("tf", "tok")) + """
SELECT doc_id, term, tf FROM tf""")
def n3(spark, d):
    return N.term_counts(S.table(spark, d, "documents"), "doc_id", "text")


@register("N4_vocabulary_df_bounds", with_(*TRAIN_SQL) + "SELECT term, df, CAST(cf AS BIGINT) AS cf FROM vocab")
def n4(spark, d):
    return train_parts(spark, d)[4]


@register("N4_vocabulary_by_heavy_buckets", with_(*TRAIN_SQL) + "SELECT term, df, CAST(cf AS BIGINT) AS cf FROM vocab")
def n4b(spark, d):
    train = labelled(spark, d).where(F.col("split") == "train")
    return H.vocabulary_frequent(train, "doc_id", "text", train.select(F.count(F.lit(1))).scalar(), 5000, 5, 0.8)


@register("N5_tfidf_long_form", with_(*TRAIN_SQL, tok_sql("lab_tok", "lab"), terms_sql("lab_tf", "lab_tok"),
          """w AS (SELECT f.doc_id, f.term, f.tf * (ln((1 + (SELECT n FROM ntr)) / (1 + v.df)) + 1) AS w
  FROM lab_tf f JOIN vocab v ON f.term = v.term)""") + """
SELECT w.doc_id, w.term, round(w.w / sqrt(s.ss), 6) AS tfidf
FROM w JOIN (SELECT doc_id, sum(w * w) AS ss FROM w GROUP BY doc_id) s ON w.doc_id = s.doc_id""")
def n5(spark, d):
    lab, train, n, all_tf, vocab = train_parts(spark, d)
    return N.tfidf(all_tf, vocab, "doc_id", n)


TOPW_SQL = """SELECT word, n, round(n / max(n) OVER (), 6) AS relative FROM (
  SELECT word, count(*) AS n FROM (SELECT unnest({tok}) AS word FROM {src}) GROUP BY word)
QUALIFY row_number() OVER (ORDER BY n DESC, word) <= 200"""


@register("N6_top_words_titles", TOPW_SQL.format(tok=TOK.format(t="p_name"), src="part"))
def n6(spark, d):
    return N.top_words(S.table(spark, d, "part"), "p_name", 200)


@register("N6_top_words_documents", TOPW_SQL.format(tok=TOK.format(t="text"), src="documents"))
def n6b(spark, d):
    return N.top_words(S.table(spark, d, "documents"), "text", 200)


@register("N6_top_words_by_heavy_buckets", TOPW_SQL.format(tok=TOK.format(t="text"), src="documents"))
def n6c(spark, d):
    return H.top_words_frequent(S.table(spark, d, "documents"), "text", 200)


@register("N7_balanced_class_weights", with_(LABELLED_SQL) + """
SELECT doc_id, label, round((SELECT count(*) FROM lab) / (2.0 * count(*) OVER (PARTITION BY label)), 6) AS weight FROM lab""")
def n7(spark, d):
    w = N.class_weights(labelled(spark, d).select("doc_id", "label"), "label")
    return w.select("doc_id", "label", F.round("weight", 6).alias("weight"))


WL_SQL = (*TRAIN_SQL,
          """wt AS (SELECT term, ln((count(*) FILTER (WHERE label = 1) + 1) / (count(*) FILTER (WHERE label = 0) + 1)) AS weight
  FROM (SELECT DISTINCT doc_id, label, term FROM (SELECT doc_id, label, unnest(t) AS term FROM train_tok))
  JOIN (SELECT term FROM vocab WHERE NOT contains(term, ' ')) USING (term) GROUP BY term)""",
          "test AS (SELECT * FROM lab WHERE split = 'test')", tok_sql("test_tok", "test", extra=", label"),
          """pred AS (SELECT k.doc_id, k.label, CAST(round(coalesce(sum(wt.weight), 0), 9) > 0 AS INTEGER) AS prediction
  FROM (SELECT doc_id, label, unnest(t) AS term FROM test_tok) k LEFT JOIN wt ON k.term = wt.term GROUP BY k.doc_id, k.label
  UNION ALL SELECT doc_id, label, 0 FROM test_tok WHERE len(t) = 0)""",
          "base AS (SELECT doc_id, label, 1 AS prediction FROM test)")


def predictions(spark, d):
    lab, train, n, tf, vocab = train_parts(spark, d)
    wts = N.word_weights(train, "doc_id", "text", "label", vocab)
    weights = {r["term"]: r["weight"] for r in wts.collect()}  # bounded by max_features
    test = lab.where(F.col("split") == "test").select("doc_id", "text", "label")
    tokens = N.with_tokens(test, "text", "tokens").select("doc_id", "label", "tokens")
    pred = N.score_batches(tokens, "tokens", N.word_list_predictor(weights)).drop("tokens")
    base = test.select("doc_id", "label", F.lit(1).alias("prediction"))
    return pred, base


@register("N14_batch_scoring_word_list", with_(*WL_SQL) + "SELECT doc_id, label, prediction FROM pred")
def n14(spark, d):
    return predictions(spark, d)[0]


@register("N10_confusion_matrix", with_(*WL_SQL) + """
SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
FROM pred""")
def n10(spark, d):
    return N.confusion(predictions(spark, d)[0])


REPORT_SQL = """cm AS (SELECT {by} count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM {src} {grp}),
m AS (SELECT {by} tn, fp, fn, tp,
  coalesce(CASE WHEN tn + fn = 0 THEN NULL ELSE tn / (tn + fn) END, 0.0) AS p0, coalesce(CASE WHEN tn + fp = 0 THEN NULL ELSE tn / (tn + fp) END, 0.0) AS r0,
  coalesce(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 0.0) AS p1, coalesce(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 0.0) AS r1
  FROM cm),
m2 AS (SELECT *, coalesce(CASE WHEN p0 + r0 = 0 THEN NULL ELSE 2 * p0 * r0 / (p0 + r0) END, 0.0) AS f0,
  coalesce(CASE WHEN p1 + r1 = 0 THEN NULL ELSE 2 * p1 * r1 / (p1 + r1) END, 0.0) AS f1,
  tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n FROM m),
rep AS (
  SELECT {by} '0' AS "row", p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m2 UNION ALL
  SELECT {by} '1', p1, r1, f1, s1 FROM m2 UNION ALL
  SELECT {by} 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n FROM m2 UNION ALL
  SELECT {by} 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m2 UNION ALL
  SELECT {by} 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM m2)"""


@register("N11_classification_report", with_(*WL_SQL, REPORT_SQL.format(by="", src="pred", grp="")) + """
SELECT "row", round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM rep""")
def n11(spark, d):
    return N.classification_report(predictions(spark, d)[0])


CMP_SQL = (*WL_SQL, """u AS (SELECT 'word_list' AS model, label, prediction FROM pred UNION ALL
  SELECT 'majority', label, prediction FROM base)""", REPORT_SQL.format(by="model,", src="u", grp="GROUP BY model"),
           """cmp AS (SELECT a.model, round(a.f1, 4) AS accuracy, round(p.precision, 4) AS precision, round(p.recall, 4) AS recall,
  round(p.f1, 4) AS f1 FROM rep a JOIN rep p ON a.model = p.model AND a."row" = 'accuracy' AND p."row" = '1')""")


@register("N12_model_comparison", with_(*CMP_SQL) + "SELECT model, accuracy, precision, recall, f1 FROM cmp")
def n12(spark, d):
    pred, base = predictions(spark, d)
    return N.compare_models({"word_list": pred, "majority": base})


@register("N13_improvement_over_baseline", with_(*CMP_SQL) + """
SELECT b.model AS best_model, round((b.accuracy - m.accuracy) * 100, 4) AS accuracy_gain_pts,
       round((b.precision - m.precision) * 100, 4) AS precision_gain_pts, round((b.recall - m.recall) * 100, 4) AS recall_gain_pts,
       round((b.accuracy - m.accuracy) * 10000, 2) AS extra_correct_per_10k, (b.accuracy - m.accuracy) * 100 > 5.0 AS significant
FROM (SELECT * FROM cmp ORDER BY accuracy DESC, model LIMIT 1) b, (SELECT * FROM cmp WHERE model = 'majority') m""")
def n13(spark, d):
    pred, base = predictions(spark, d)
    return N.improvement_over_baseline(N.compare_models({"word_list": pred, "majority": base}), "majority")
