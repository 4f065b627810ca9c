"""Membership before the shuffle (J8, U4, T8): a Bloom filter built by an aggregate,
with the exact operator behind it."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.predicates import fingerprint
from quarry.operators.joins import members, sized_broadcast
from quarry.operators.similarity import normalise_rows
from quarry.session import cut_lineage

__all__ = ["bloom", "bloom_fill", "may_contain", "members_filtered", "intersect_filtered", "row_overlap_filtered"]

WORDS = 1 << 20  # 64-bit words of a filter: 10 bits a key for 6.7 million keys
_SHIFTS = (24, 30, 36, 42)  # four bits of a key's word, from hash bits that do not choose the word


def _types(df: DataFrame, cols: Sequence[str]) -> list:
    return [df.schema[c].dataType for c in cols]


def _comparable(a: list, b: list) -> bool:
    """Whether equal keys of these types hash alike: the same types, none nested."""
    return a == b and not any(isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for t in a)


def _place(cols: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a key and the bits it sets there (alike for 0.0 and -0.0, and for NaN)."""
    if words & (words - 1) or not 0 < words <= 1 << 24:
        raise ValueError(f"{words}: a power of two up to 2^24")
    h = F.xxhash64(*cols)
    bits = F.lit(0).cast("long")
    for s in _SHIFTS:
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, s).bitwiseAND(F.lit(63)).cast("int")))
    return h.bitwiseAND(F.lit(words - 1).cast("long")), bits


def bloom(keys: DataFrame, cols: Sequence[str], words: int = WORDS, nulls: bool = False) -> DataFrame:
    """``(word, bits)``: a Bloom filter of ``cols`` of ``keys``, at most ``words`` rows.

    Each key sets four bits of one 64-bit word, so the filter is a plain
    ``bit_or`` by word: hash aggregate, combined on the map side, at most
    ``words`` rows leave a task.  Rows with a null in ``cols`` are left out
    unless ``nulls``.  The result is checkpointed; it never grows with the input."""
    k = keys.select(*cols)
    if not nulls:
        for c in cols:
            k = k.where(F.col(c).isNotNull())
    word, bits = _place(cols, words)
    return cut_lineage(k.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")))


def bloom_fill(built: DataFrame, words: int = WORDS) -> float:
    """Share of the filter's bits that are set; a foreign key passes with about its fourth power."""
    return (built.agg(F.sum(F.bit_count("bits")).alias("n")).first()["n"] or 0) / (64 * words)


def may_contain(df: DataFrame, cols: Sequence[str], built: DataFrame, words: int = WORDS, most_fill: float = 0.8) -> DataFrame:
    """Rows of ``df`` whose ``cols`` may be among the filter's keys: all that are, and few others.

    A semi join with the filter, broadcast since its rows are bounded by
    ``words``.  A filter filled beyond ``most_fill`` would pass two rows in five
    or more for nothing, so ``df`` is then returned as it is."""
    if bloom_fill(built, words) > most_fill:
        return df
    word, bits = _place(cols, words)
    p = "_w"
    while any(c.startswith(p) for c in df.columns):
        p += "w"
    f = sized_broadcast(built.select(F.col("word").alias(p), F.col("bits").alias(p + "b")), rows_bound=words)
    return df.join(f, (word == F.col(p)) & (F.col(p + "b").bitwiseAND(bits) == bits), "left_semi")


def members_filtered(a: DataFrame, b: DataFrame, keys: Sequence[str], words: int = WORDS) -> DataFrame:
    """J8 for a large ``a`` of which few rows have a partner: :func:`members` behind a
    Bloom filter of ``b``, so that rows without a partner are not shuffled.

    ``b`` is read twice, for the filter and for the join.  Keys of differing
    or nested types may hash differently and are joined without a filter.  Null keys match nothing."""
    if not _comparable(_types(a, keys), _types(b, keys)):
        return members(a, b, keys)
    return members(may_contain(a, keys, bloom(b, keys, words), words), b, keys)


def intersect_filtered(a: DataFrame, b: DataFrame, words: int = WORDS) -> DataFrame:
    """U4 (distinct rows in both, null equal to null) with ``a`` behind a Bloom filter of ``b``."""
    if not _comparable(_types(a, a.columns), _types(b, b.columns)):
        return a.intersect(b)
    return may_contain(a, a.columns, bloom(b, b.columns, words, nulls=True), words).intersect(b)


def row_overlap_filtered(real: DataFrame, synth: DataFrame, cols: Sequence[str], digits: int = 6, words: int = WORDS) -> DataFrame:
    """T8 with the synthetic rows behind a Bloom filter of the real fingerprints.

    Real fingerprints are shuffled once, for their distinct count; of the
    synthetic ones only those that may be among them, which is what an overlap
    near zero leaves."""
    hr = normalise_rows(real, cols).select(fingerprint(*cols).alias("h"))
    hs = normalise_rows(synth, cols).select(fingerprint(*cols).alias("h"))
    hs = may_contain(hs, ["h"], bloom(hr, ["h"], words), words).distinct().withColumn("s", F.lit(1))
    both = hr.distinct().join(hs, "h", "left").agg(F.count(F.lit(1)).alias("n_real_distinct"), F.count("s").alias("n_overlap"))
    return both.select("n_real_distinct", "n_overlap", F.round(F.col("n_overlap") * 100.0 / F.col("n_real_distinct"), digits).alias("overlap_pct"))
