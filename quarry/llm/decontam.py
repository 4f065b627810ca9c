"""Benchmark decontamination: a prefix-filtered join of item windows, in DataFrame operations only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import own_prefix, saved

__all__ = ["words", "item_windows", "window_hits", "contamination", "drop_contaminated"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; null has none."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    # lower() is a plain byte loop on ASCII texts; only the others need the character map
    low = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _NO_WORD), "")


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", length: int = 13) -> DataFrame:
    """``(w array<string>, items array)``: the distinct windows of ``length`` words (an
    item of fewer words is one window) and the items that hold them."""
    i = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("x")).where(F.size("x") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("x") - (length - 1), F.lit(1))))
    return i.select("item", "x", at.alias("at")).select("item", F.expr(f"slice(x, at, {length})").alias("w")) \
        .groupBy("w").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _rarity(docs_words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Occurrences of the benchmark's words in all documents; 0 where none."""
    seen = docs_words.select(F.explode("x").alias("t")).join(F.broadcast(vocabulary), "t", "left_semi").groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.join(seen, "t", "left").select("t", F.coalesce("n", F.lit(0)).alias("n"))


def window_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                item_text: str = "text", length: int = 13, block: int = 20_000) -> DataFrame:
    """``(id, th, start, n, items)``: each occurrence of a window in a document
    (``start`` counts words from 0; ``th`` tells rows of one id apart).

    A document holds a window only if it holds the window's rarest word (its
    necessary prefix in the order of rarity over all documents), and then only
    at one place: that word's position less its offset, with room for the whole
    window.  What remains is compared word by word.  Windows are broadcast in
    blocks of ``block`` rows; a larger benchmark takes more scans, not larger
    broadcasts."""
    win = saved(item_windows(items, item_col, item_text, length), "decontam-windows")
    n_win = win.count()
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("th"), words(t).alias("x"))
    out = rows.where(F.lit(False)).select("id", "th", F.lit(0).alias("start"), F.lit(0).alias("n"), F.array(F.lit("")).alias("items"))
    for k in range(-(-n_win // block)):
        part = win.where(F.pmod(F.xxhash64("w"), F.lit(-(-n_win // block))) == k)
        rare = saved(_rarity(rows, part.select(F.explode("w").alias("t")).distinct()), "decontam-rarity")
        first = part.select("w", "items", F.posexplode("w").alias("o", "t")).join(F.broadcast(rare), "t") \
            .groupBy("w", "items").agg(F.min(F.struct("n", "t", "o")).alias("p")) \
            .where("p.n > 0").select("w", "items", F.col("p.t").alias("t"), F.col("p.o").alias("o"))
        occ = rows.select("id", "th", "x", F.posexplode("x").alias("at", "t")).join(F.broadcast(first), "t") \
            .where("at >= o and at - o + size(w) <= size(x)").where("slice(x, at - o + 1, size(w)) = w") \
            .select("id", "th", (F.col("at") - F.col("o")).alias("start"), F.size("w").alias("n"), "items")
        out = occ if k == 0 else out.unionByName(occ)
    return out


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", length: int = 13, share: int = 20) -> DataFrame:
    """Per row of ``docs``: ``(id_col, n_words, n_hit, n_items, items, contaminated)``.

    A word inside any occurrence of a window is hit; ``items`` are the ids (as
    sorted strings) of the items with occurring windows; contaminated: hit words
    are at least one in ``share``, and at least one.  A null or wordless text
    has no words; an item without words has no window; null item ids are named
    by no document.  Rows that repeat an id are judged each by its own text."""
    return _judged(docs, items, id_col, text_col, item_col, item_text, length, share) \
        .select(F.col("id").alias(id_col), "n_words", "n_hit", "n_items", "items", "contaminated")


def _judged(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str = "item_id", item_text: str = "text",
            length: int = 13, share: int = 20) -> DataFrame:
    """:func:`contamination` with the text's hash: ``(id, th, n_words, n_hit, n_items, items, contaminated)``."""
    hits = window_hits(docs, items, id_col, text_col, item_col, item_text, length).distinct()
    # hit words by document: the part of each occurrence that lies beyond all earlier ones
    per = hits.groupBy("id", "th").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("s"),
                                       F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    n_hit = F.aggregate("s", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda a, x: F.struct(
        (a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], x["end"]).alias("to")))["n"]
    per = saved(per.select("id", "th", n_hit.cast("long").alias("n_hit"), "items"), "decontam-hits").alias("r")
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("th"), F.size(words(t)).cast("long").alias("n_words")).alias("l")
    j = base.join(per, (F.col("l.th") == F.col("r.th")) & F.col("l.id").eqNullSafe(F.col("r.id")), "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return j.select(F.col("l.id").alias("id"), F.col("l.th").alias("th"), "n_words", hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
                    items_.alias("items"), ((hit > 0) & (share * hit >= F.col("n_words"))).alias("contaminated"))


def contamination_digests(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    c = contamination(docs, items, **kw)
    return c.select(*[x for x in c.columns if x not in ("items", "contaminated")], F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated, all columns kept.  Rows
    that share an id, or have none, stay or go each by its own text."""
    p = own_prefix(docs)
    c = _judged(docs.select(id_col, text_col), items, id_col, text_col, **kw).where("contaminated") \
        .select(F.col("id").alias(f"{p}bad"), F.col("th").alias(f"{p}th")).distinct()
    th = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.join(c, (th == F.col(f"{p}th")) & F.col(id_col).eqNullSafe(F.col(f"{p}bad")), "left_anti")
