"""Registered queries of the operators and the pipeline, with their DuckDB SQL."""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, hardneg, langid, lexical, licenses, pathjoin, permindex, pieces, secretscan, simhash, suffixdedup, tokenfiles, warc
from quarry.llm.common import document_path, scratch, ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return add


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@_query("op1_sentencepiece")
def op1(spark, d):
    return pieces.piece_digests(table(spark, d, "documents"), _vocabulary("piece_bpe_32k.model"))


@_query("op2_suffix_dedup")
def op2(spark, d):
    return suffixdedup.removal_digests(table(spark, d, "documents"))


@_query("op3_token_files")
def op3(spark, d):
    folder = scratch(spark, "token-files")
    done = tokenfiles.write_token_files(table(spark, d, "documents"), tokenfiles.byte_bpe_encoder(_vocabulary("byte_bpe_50k.json"), added_tokens=True), folder)
    return tokenfiles.token_digests(spark, folder, done)


@_query("op4_secret_scan")
def op4(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang", document_path().alias("path"))
    return secretscan.scan(docs, path_col="path", lang_col="lang").select(F.col("id").alias("doc_id"), "start", "end", "kind", "sha256", "score", "is_secret")


@_query("op5_permutation_index")
def op5(spark, d):
    return permindex.search(table(spark, d, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)


@_query("op6_language_id")
def op6(spark, d):
    docs = table(spark, d, "documents")
    model = langid.fit(docs.where(langid.trains("doc_id")))
    return langid.predict(docs.select("doc_id", langid.held_out("doc_id").alias("held_out"), "text"), model).drop("text")


_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP7 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS x FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format('text')} AS x FROM benchmark),
iw AS (SELECT DISTINCT item, len(w) AS n, array_to_string(w, ' ') AS w FROM (
  SELECT item, x[s:s + 12] AS w FROM (SELECT item, x, unnest(range(1, greatest(len(x) - 12, 1) + 1)) AS s FROM i WHERE len(x) > 0))),
dw AS (SELECT doc_id, s, n, array_to_string(x[s:s + n - 1], ' ') AS w FROM (
  SELECT doc_id, x, n, unnest(range(1, len(x) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(x) >= n)),
h AS (SELECT dw.doc_id, dw.s, dw.n, iw.item FROM dw JOIN iw ON dw.w = iw.w AND dw.n = iw.n),
k AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM h) GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(x) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(x) AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)"""


@_query("op7_decontamination", _OP7)
def op7(spark, d):
    return decontam.contamination_digests(table(spark, d, "documents"), table(spark, d, "benchmark"))


@_query("op8_simhash")
def op8(spark, d):
    near = simhash.near_duplicates(table(spark, d, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


_TOKENS = "regexp_extract_all(lower({}), '" + licenses.TOKEN + "')"
_NOT9 = " OR ".join([f"(license = '{k}' AND list_has_any(x, {v}))" for k, v in licenses.EXCLUDED.items()]
                    + [f"(license = '{k}' AND NOT list_has_any(x, {v}))" for k, v in licenses.REQUIRED.items()])
_OP9 = "WITH known(license, statement) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in licenses.TEMPLATES) + f"""),
src AS (SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR) || '.txt') AS path, coalesce(text, '') AS text FROM documents),
n AS (SELECT count(*) AS n FROM src),
tt AS (SELECT license, unnest({_TOKENS.format('statement')}) AS t FROM known),
idf AS (SELECT v.t, ln((1 + (SELECT n FROM n)) / (1 + coalesce(df, 0))) + 1 AS idf FROM (SELECT DISTINCT t FROM tt) v LEFT JOIN (
  SELECT t, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({_TOKENS.format('text')}) AS t FROM src) GROUP BY t) d ON v.t = d.t),
lw AS (SELECT license, t, w / sqrt(sum(w * w) OVER (PARTITION BY license)) AS lw FROM (
  SELECT license, tt.t, count(*) * any_value(idf) AS w FROM tt JOIN idf ON tt.t = idf.t GROUP BY license, tt.t)),
lines AS (SELECT doc_id, generate_subscripts(l, 1) AS line, unnest(l) AS s FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM src)),
units AS (SELECT doc_id, line, s FROM lines UNION ALL SELECT doc_id, 0, text FROM src),
tf AS (SELECT doc_id, line, t, count(*) AS tf FROM (SELECT doc_id, line, unnest({_TOKENS.format('s')}) AS t FROM units) GROUP BY ALL),
w AS (SELECT doc_id, line, tf.t, tf * coalesce(idf, ln(1 + (SELECT n FROM n)) + 1) AS w FROM tf LEFT JOIN idf ON tf.t = idf.t),
norm AS (SELECT doc_id, line, sqrt(sum(w * w)) AS norm FROM w GROUP BY ALL),
near_by AS (SELECT doc_id, line, license, round(sum(w / norm * lw), 6) AS cosine FROM w JOIN norm USING (doc_id, line) JOIN lw ON w.t = lw.t GROUP BY ALL),
cos AS (SELECT doc_id, line, license, cosine FROM near_by JOIN (SELECT doc_id, line, {_TOKENS.format('s')} AS x FROM units) USING (doc_id, line)
  WHERE cosine >= 0.6 AND NOT ({_NOT9})),
head AS (SELECT doc_id, license, cosine FROM cos WHERE line > 0 AND cosine >= 0.6
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, license) = 1),
decl AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license, cosine FROM cos JOIN src USING (doc_id)
  WHERE line = 0 AND cosine >= 0.6 AND doc_id IN (SELECT doc_id FROM head)),
dirs AS (SELECT dir, license, cosine FROM decl QUALIFY row_number() OVER (PARTITION BY dir ORDER BY cosine DESC, license) = 1),
up AS (SELECT doc_id, i AS depth, array_to_string(parts[1:i], '/') AS dir FROM (
  SELECT doc_id, parts, unnest(range(0, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(path, '/?[^/]*$', ''), '/') AS parts FROM src))),
near AS (SELECT doc_id, dir, license, cosine FROM up JOIN dirs USING (dir) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth DESC) = 1)
SELECT doc_id, path, coalesce(h.license, d.license) AS license, coalesce(h.cosine, d.cosine) AS cosine,
  CASE WHEN h.license IS NOT NULL THEN 'header' WHEN d.license IS NOT NULL THEN 'inherited' END AS basis,
  CASE WHEN h.license IS NULL THEN d.dir END AS directory
FROM src LEFT JOIN head h USING (doc_id) LEFT JOIN near d USING (doc_id)"""


@_query("op9_license_scan", _OP9)
def op9(spark, d):
    docs = table(spark, d, "documents")
    return licenses.scan_licenses(docs.select("doc_id", document_path().alias("path"), "text"), "doc_id", "path", "text")


@_query("op10_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
f AS (SELECT b, min(page_id) AS first FROM p WHERE strlen(b) >= 100 GROUP BY b)
SELECT page_id, CAST(strlen(p.b) AS BIGINT) AS payload_bytes, sha256(p.b) AS payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.b = f.b""")
def op10(spark, d):
    folder = scratch(spark, "warc")
    done = warc.write_warc(table(spark, d, "pages"), folder)
    return warc.read_warc(spark, folder, done).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_TERMS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@_query("op11_lexical_search", f"""
WITH d AS (SELECT doc_id, {_TERMS.format('text')} AS x FROM documents),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(x)) AS BIGINT) AS terms FROM d WHERE len(x) > 0),
q AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest({_TERMS.format('text')}) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, n, t, count(*) AS tf FROM (SELECT doc_id, len(x) AS n, unnest(x) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM p, c GROUP BY t),
s AS (SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (t) JOIN p USING (t), c GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10""")
def op11(spark, d):
    return lexical.rank_documents(table(spark, d, "documents"), table(spark, d, "benchmark"))


@_query("op12_hard_negatives", """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10""")
def op12(spark, d):
    vec, turned = F.col("vec_id"), F.expr("(label + 1) % 10")
    found = hardneg.mine(table(spark, d, "embeddings"), "vec_id", "embedding", F.when(vec % 7 == 0, turned).otherwise(F.col("label")), vec % 100 == 0)
    return found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"), "positive_score", "negative_score")


@_query("op13_minhash", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS (SELECT DISTINCT doc_id, t FROM (SELECT doc_id, unnest(CASE WHEN len(x) >= 3 THEN list_transform(range(1, len(x) - 1), lambda i: array_to_string(x[i:i + 2], ' '))
  WHEN len(x) > 0 THEN [array_to_string(x, ' ')] ELSE [] END) AS t FROM d)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS hits FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN c x ON u = x.doc_id JOIN c y ON v = y.doc_id WHERE 100 * hits >= 85 * (x.n + y.n - hits)),
r AS (SELECT doc_id, doc_id AS to_id FROM d UNION SELECT r.doc_id, l.v FROM r JOIN l ON r.to_id = l.u)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(to_id) AS component_id, doc_id = min(to_id) AS kept
FROM r LEFT JOIN c USING (doc_id) GROUP BY doc_id""")
def op13(spark, d):
    return pathjoin.near_duplicates(table(spark, d, "documents"))


@_query("pipeline")
def pipeline(spark, d):
    import corpus_pipeline
    return corpus_pipeline.run(spark, d)
