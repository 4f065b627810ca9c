"""Language identification: words first, then shorter and shorter character n-grams."""
from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import own_prefix, saved

__all__ = ["LanguageModel", "fit", "predict", "held_out", "trains"]

UNDETERMINED = "und"


def _fold(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def held_out(id_col: str = "doc_id") -> Column:
    """The test fold: crc32 of the id as text, modulo 3, is 1 (a null id counts as '')."""
    return _fold(id_col) == 1


def trains(id_col: str = "doc_id") -> Column:
    return _fold(id_col) != 1


def _words(text: str | None) -> list[str]:
    import regex
    return regex.findall(r"\p{L}+", text.lower()) if text else []


class Table(Mapping):
    """Strings and their vectors, which are rows of one array: an object a vector takes
    several times their bytes, in each worker."""

    def __init__(self, at: dict[str, int], rows: np.ndarray):
        self.at, self.rows = at, rows

    def __getitem__(self, w: str) -> np.ndarray:
        return self.rows[self.at[w]]

    def __iter__(self) -> Iterator[str]:
        return iter(self.at)

    def __len__(self) -> int:
        return len(self.at)


class LanguageModel:
    """Log frequencies of words and of character n-grams (word ends marked), by language.

    ``tables[0]`` has words, ``tables[n]`` n-grams; each maps a string to a
    vector over ``langs``.  A word of the table scores by it; another by its
    n-grams of the largest n of which any is known, averaged."""

    def __init__(self, langs: list[str], tables: dict[int, Table], priors: np.ndarray, max_n: int):
        self.langs, self.tables, self.priors, self.max_n = langs, tables, priors, max_n

    def word(self, w: str) -> np.ndarray:
        k = self.tables[0].at.get(w)
        if k is not None:
            return self.tables[0].rows[k]
        s = f"^{w}$"
        for n in range(self.max_n, 0, -1):
            get = self.tables[n].at.get
            known = [k for i in range(len(s) - n + 1) if (k := get(s[i:i + n])) is not None]
            if known:
                return self.tables[n].rows[known].mean(axis=0)
        return np.zeros(len(self.langs))


class Predictor:
    """Predictions of one worker; scores of words are held in a memo of bounded size."""

    def __init__(self, model: LanguageModel, memo: int = 100_000):
        self.model, self.most = model, memo
        self._reset()

    def _reset(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1 << 14, len(self.model.langs)))

    def _row(self, w: str) -> int:
        k = len(self.at)
        if k == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[k] = self.model.word(w)
        self.at[w] = k
        return k

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = _words(text)
        langs = self.model.langs
        if not words or not langs:
            return UNDETERMINED, 0.0
        total = self.model.priors.copy()
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            if len(self.at) > self.most:
                self._reset()
            get, row = self.at.get, self._row
            idx = [k if (k := get(w)) is not None else row(w) for w in part]
            total += self.rows[idx].sum(axis=0)
        best = int(np.argmax(total))  # ties: the first language by name
        return langs[best], float(1.0 / np.exp(np.minimum(total - total[best], 0)).sum())


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_docs: int = 20_000, max_words: int = 20_000,
        max_grams: int = 20_000, max_n: int = 4, seed_cols: tuple[str, ...] = ("doc_id",)) -> LanguageModel:
    """Fit on rows whose language is not null.

    ``max_docs`` bounds the labelled sample (its expected size): rows with the
    smallest hashes of ``seed_cols``, whole texts.  The model holds the most
    frequent words and n-grams of each length of a language, about
    ``max_words`` and ``max_grams``, so it is small whatever the corpus; of the
    equally frequent ones at the bound it holds those of the smallest hashes that
    fill it (their expected number), so a flat vocabulary fills the tables, too.  Without any labelled row
    the model has no languages and every prediction is ``und``."""
    lab = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    n = lab.count()
    if n > max_docs:
        lab = lab.where(F.pmod(F.xxhash64(*seed_cols, F.lit(11)), F.lit(1_000_000)) < math.ceil(1_000_000 * max_docs / n))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: defaultdict[str, Counter] = defaultdict(Counter)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, c in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())],
                                                 names=["lang", "w", "n"])
            found.clear()
        for b in batches:
            for lang, text in zip(b.column("lang"), b.column("text")):  # one text at a time becomes a Python string
                found[lang.as_py()].update(_words(text.as_py()))
                if sum(map(len, found.values())) > 50_000:
                    yield from rows()
        yield from rows()
    words = lab.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(count, "lang string, w string, n long").groupBy("lang", "w").agg(F.sum("n").alias("n"))
    words = saved(words, "langid-words")  # read by both the words' and the n-grams' counts
    langs_docs = {r["lang"]: r["n"] for r in lab.groupBy(F.col(lang_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(langs_docs)
    s = F.concat(F.lit("^"), F.col("w"), F.lit("$"))
    none = F.array().cast("array<struct<k:int,g:string>>")

    def cut(n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.length(s) - (n - 1)), lambda i: F.struct(F.lit(n).alias("k"), s.substr(i, F.lit(n)).alias("g")))
        return F.when(F.length(s) >= n, each).otherwise(none)
    pieces = F.flatten(F.array(*[cut(n) for n in range(1, max_n + 1)]))
    grams = words.select("lang", "n", F.explode(pieces).alias("p")).groupBy("lang", F.col("p.k").alias("k"), F.col("p.g").alias("w")) \
        .agg(F.sum("n").alias("n"))
    every = words.select("lang", F.lit(0).alias("k"), "w", "n").unionByName(grams)
    # how often a string must occur for the table to hold no more than its bound, and the share of the strings just below
    # that still find room: from the counts of counts
    most = F.when(F.col("k") == 0, max_words).otherwise(max_grams)
    counts = every.groupBy("lang", "k", "n").agg(F.count(F.lit(1)).alias("c"))
    held = F.sum("c").over(Window.partitionBy("lang", "k").orderBy(F.desc("n")))
    full = F.col("h") > most
    edge = counts.withColumn("h", held).groupBy("lang", "k").agg(F.max(F.when(full, F.struct("n", ((most - F.col("h") + F.col("c")) / F.col("c")).alias("room")))).alias("e"))
    kept = F.col("e").isNull() | (F.col("n") > F.col("e.n")) \
        | ((F.col("n") == F.col("e.n")) & (F.pmod(F.xxhash64("w", F.lit(13)), F.lit(1_000_000)) < F.col("e.room") * 1_000_000))
    top = every.join(F.broadcast(edge), ["lang", "k"]).where(kept)  # a row a language and length
    totals = {(r["lang"], r["k"]): (r["n"], r["v"]) for r in every.groupBy("lang", "k").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    col = {x: i for i, x in enumerate(langs)}
    ns = range(max_n + 1)
    floor = {n: np.array([math.log(0.5 / (sum(totals.get((x, n), (0, 0))) + 1)) for x in langs]) for n in ns}
    at: dict[int, dict[str, int]] = {n: {} for n in ns}
    cells = {n: (array("q"), array("q"), array("d")) for n in ns}
    for b in top.select("lang", "k", "w", "n").toArrow().to_batches(10_000):  # bounded by the model's own size
        for lang, k, w, n in zip(*(c.to_pylist() for c in b.columns)):
            for c, x in zip(cells[k], (at[k].setdefault(w, len(at[k])), col[lang], math.log((n + 0.5) / (sum(totals[lang, k]) + 1)))):
                c.append(x)
    tables = {}
    for n in ns:
        i, j, v = (np.array(c) for c in cells[n])
        vectors = np.tile(floor[n], (len(at[n]), 1))
        vectors[i, j] = v
        tables[n] = Table(at[n], vectors)
    all_docs = sum(langs_docs.values())
    priors = np.array([math.log(langs_docs[x] / all_docs) for x in langs])
    return LanguageModel(langs, tables, priors, max_n)


_LOADED: dict = {}


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language of each whole text and its posterior
    probability (columns of these names are replaced).  A null text or one without a letter is ``und`` with score 0;
    every other gets a learned language.  Nothing but the text is an input."""
    import uuid
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    @F.arrow_udf("struct<lang:string,score:double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _LOADED:
            _LOADED.clear()
            _LOADED[name] = Predictor(shared.value)
        p = _LOADED[name]
        for texts in batches:
            langs, scores = zip(*(p(t.as_py()) for t in texts)) if len(texts) else ((), ())  # one text at a time becomes a Python string
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])
    lp = own_prefix(docs) + "lp"
    return docs.withColumn(lp, run(F.col(text_col).cast("string"))).select(
        *[F.col(c) for c in docs.columns if c.lower() not in (lang_out.lower(), score_out.lower())], F.col(f"{lp}.lang").alias(lang_out), F.col(f"{lp}.score").alias(score_out))
