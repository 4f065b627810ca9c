"""A training corpus from ``documents``: five stages, each over all its predecessor kept."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontam, langid, pieces, secretscan, simhash
from quarry.llm.common import document_path, own_prefix, saved, ship_package, table

#: DuckDB has neither the models nor XXH64: run() is tested stage by stage against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; null texts and texts without a letter go.
    These alone go, too, if no row of the training fold has a language to learn."""
    ship_package(spark)
    model = langid.fit(docs.where(langid.trains("doc_id")))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    p = own_prefix(docs)
    return langid.predict(docs, model, lang_out=f"{p}lang", score_out=f"{p}score") \
        .where(F.col(f"{p}lang") != langid.UNDETERMINED).drop(f"{p}lang", f"{p}score")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group within three bits over three-word shingles."""
    ship_package(spark)
    return simhash.keep_one_of_each(docs, shingle=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    ship_package(spark)
    path = own_prefix(docs) + "path"
    return secretscan.redact(docs.withColumn(path, document_path()), path_col=path, lang_col="lang").drop(path)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, lang, source, n_tokens, ids)``; texts that do not decode to themselves raise an error
    (a U+2581 counts as the blank it decodes to)."""
    ship_package(spark)
    import public_tokenizers
    e = pieces.encode(docs, str(public_tokenizers.path("piece_bpe_32k.model")))
    same = F.col("decoded").eqNullSafe(F.translate("text", "▁", " "))
    return e.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"),
                    F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("ids do not decode to their text")).cast("array<int>")).alias("ids"))


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("decontaminate", decontaminate),
          ("mask_secrets", mask_secrets), ("sentencepiece", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
