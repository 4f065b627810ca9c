"""Secret scans: candidates by pattern, false positives removed by a random forest."""
from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import own_prefix, saved

__all__ = ["Lexicon", "lexicon", "findings", "planted", "labelled", "fit_forest", "score", "scan", "redact"]

# Shapes of published key formats, words beside secrets and beside harmless numbers.
_LINE = r"(?:\r?\n|\\r\\n|\\n)"  # also as written within a JSON string
# A private key runs to its END line; without one, to the last of the base64 lines that follow (header lines first).
_BEGIN, _END = (r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----", r"-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----")
PEM = (rf"{_BEGIN}(?:[^\-]*+(?:-(?!----(?:BEGIN|END) )[^\-]*+)*+{_END}"
       rf"|(?:{_LINE}[ \t]*+(?:[A-Z][A-Za-z0-9]*-[A-Za-z0-9\-]+|Comment|Version): [^\r\n\\]*+)*+(?:{_LINE}[ \t]*+(?={_LINE}))?+"
       rf"(?:{_LINE}[ \t]*+=?[A-Za-z0-9+/]++={{0,2}}+[ \t]*+(?=[\r\n\\\"']|\Z))*+)")
KNOWN = (r"(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_\-]{20,}"
         r"|xox[abprs]-[A-Za-z0-9\-]{10,}|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_\-]{35}|eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]+"
         r"|(?<![A-Za-z0-9])(?:sk-(?:[a-z0-9]++-){0,2}[A-Za-z0-9_]{20,}|npm_[A-Za-z0-9]{36}|hf_[A-Za-z]{30,}|SG\.[A-Za-z0-9_\-]{22}\.[A-Za-z0-9_\-]{40,}))"
         rf"[A-Za-z0-9+/_\-]*+|{PEM}")
# Values and runs are maximal, of any length.  Any name that ends like a key's, the password of a URI's user
# information, the value of an authorization header, and any long run are candidates: the forest tells them apart.
ASSIGNED = (r"(?i:(?P<key>pass(?:word|wd|phrase|code)?s?|pwd|secrets?|tokens?|keys?|auth(?:orization)?|credentials?|signature|connection[_\-]?string))"
            r"[\"']?\s{0,4}(?:=>|:=|[:=])\s{0,4}[\"']?(?i:(?:bearer|basic|digest|token)[ \t]{1,4})?(?!-----BEGIN |//)(?P<value>[A-Za-z0-9+/=_\-.~!@#$%^&*]{6,}+)")
URI = r"://[^\s/:@\"'<>]*+:(?P<uri>[^\s/@\"'<>]{3,}+)(?=@)"
AUTH = r"(?i:\b(?:bearer|basic))[ \t]{1,4}(?P<auth>[A-Za-z0-9+/=_\-.~]{12,}+)"
RUN = r"(?<![\w+/\-])[A-Za-z0-9+/_\-]{16,}+={0,2}"
NEAR_SECRET = r"(?i)pass|pwd|secret|token|key|auth|credential|bearer"
NEAR_HARMLESS = r"(?i)sha\d*|md5|commit|checksum|digest|hash|uuid|isbn|phone|tel|card|account|order|invoice|serial|example|version"
PLACEHOLDER = r"(?i)example|sample|dummy|change.?me|placeholder|your[_\-]|xxxx|0000000|1234567|abcdefg|<|\{\{"
PATH_TEST = r"(?i)(^|[/_.\-])(tests?|examples?|docs?|fixtures?|samples?)([/_.\-]|$)"
PATH_CONFIG = r"(?i)\.(env|ini|cfg|conf|ya?ml|json|properties|pem|key|toml)$|(^|/)(config|secrets?|credentials?)([/.]|$)"

FEATURES = ("log_length", "digits", "upper", "lower", "other", "transitions", "bigram_log_p", "dictionary", "entropy", "hex_only", "digits_only",
            "known_format", "near_secret", "near_harmless", "assigned", "placeholder", "path_test", "path_config", "quoted", "distinct", "uri_password")


def _ascii(w: str) -> str:
    return re.sub("[^a-z]", "?", w)


class Lexicon:
    """Words of a corpus and the character transitions within its words (a-z, all
    other characters as one)."""

    def __init__(self, counts: Mapping[str, int], pairs: Mapping[str, int] | None = None):
        self.words = set(counts)
        self.lengths = sorted({len(w) for w in counts if len(w) > 2}, reverse=True)
        if pairs is None:
            pairs = Counter()
            for w, n in counts.items():
                s = f"^{_ascii(w)}$"
                for a, b in zip(s, s[1:]):
                    pairs[a + b] += n
        first = Counter()
        for p, n in pairs.items():
            first[p[0]] += n
        self.log_p = {p: math.log((n + 0.5) / (first[p[0]] + 20)) for p, n in pairs.items()}
        self.unseen = {a: math.log(0.5 / (n + 20)) for a, n in first.items()}

    def transitions(self, s: str) -> float:
        s = f"^{s.lower()}$"
        x = [self.log_p.get(a + b, self.unseen.get(a, -4.0)) for a, b in zip(s, s[1:])]
        return sum(x) / len(x)

    def coverage(self, s: str) -> float:
        """Share of the characters that words of three or more letters cover, longest first."""
        s, at, hit = s.lower(), 0, 0
        while at < len(s):
            n = next((n for n in self.lengths if n <= len(s) - at and s[at:at + n] in self.words), 0)
            hit += n
            at += n or 1
        return hit / max(len(s), 1)


def lexicon(docs: DataFrame, text_col: str = "text", lang_col: str | None = None, least_share: float = 1e-5) -> Lexicon:
    """Words and character transitions, counted over all texts (words of three or
    more letters).

    The dictionary has the words of 3 to 15 letters a-z (a candidate has no others,
    and a longer one may be a secret itself) that make up ``least_share`` or more
    of their language's words, so at most ``1 / least_share`` a language, and in a
    small corpus all.  Languages of less than a hundredth of all words count as
    one, as do all without ``lang_col``.  Transitions are counted over all words."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    w = docs.select(lang.alias("g"), F.explode(F.split(F.lower(F.col(text_col).cast("string")), r"[^\p{L}]+")).alias("w")).where(F.length("w") >= 3)
    w = saved(w.groupBy("g", "w").agg(F.count(F.lit(1)).alias("n")), "secret-words")
    total = w.agg(F.sum("n")).first()[0] or 0
    large = w.groupBy("g").agg(F.sum("n").alias("n")).where((F.col("n") * 100 >= total) & F.col("g").isNotNull()).collect()  # 100 rows at most
    least = {r["g"]: r["n"] * least_share for r in large}
    rest = (total - sum(r["n"] for r in large)) * least_share
    bound, group = F.lit(rest), F.lit(None).cast("string")
    for g in sorted(least):
        bound, group = F.when(F.col("g") == g, least[g]).otherwise(bound), F.when(F.col("g") == g, F.lit(g)).otherwise(group)
    words = w.where(F.col("w").rlike("^[a-z]{3,15}$")).withColumn("g", group).groupBy("g", "w").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= bound).groupBy("w").agg(F.sum("n").alias("n"))
    s = F.concat(F.lit("^"), F.regexp_replace("w", "[^a-z]", "?"), F.lit("$"))
    pairs = w.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda i: s.substr(i, F.lit(2)))).alias("p")) \
        .groupBy("p").agg(F.sum("n").alias("n"))
    return Lexicon({r["w"]: r["n"] for r in words.collect()}, {r["p"]: r["n"] for r in pairs.collect()})


def _features(value: str, kind: str, key: str | None, before: str, after: str, path: str, lex: Lexicon) -> list[float]:
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
    share = {k: kinds.count(k) / n for k in "dulo"}
    p = np.array(list(Counter(value).values())) / n
    near, given = before[-32:], key is not None or kind in ("uri", "auth")
    return [math.log(n), share["d"], share["u"], share["l"], share["o"], sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
            lex.transitions(value), lex.coverage(value), float(-(p * np.log2(p)).sum()), float(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None),
            float(value.isdigit()), float(kind == "known"), float(given or re.search(NEAR_SECRET, near) is not None),
            float(re.search(NEAR_HARMLESS, near + " " + after) is not None), float(given or re.search(r"[:=]\s*[\"']?$", before) is not None),
            float(re.search(PLACEHOLDER, value) is not None), float(re.search(PATH_TEST, path) is not None), float(re.search(PATH_CONFIG, path) is not None),
            float(before[-1:] in ("'", '"')), len(p) / n, float(kind == "uri")]


_SCAN = re.compile(f"(?P<known>{KNOWN})|{URI}|{ASSIGNED}|{AUTH}|(?P<run>{RUN})")


def _candidates(text: str, path: str, lex: Lexicon) -> Iterator[tuple]:
    for m in _SCAN.finditer(text):
        group = m.lastgroup if m.lastgroup != "key" else "value"
        kind = "assigned" if group == "value" else group
        a, b = m.span(group)
        value = text[a:b]
        if kind != "known" and re.fullmatch(KNOWN, value):
            kind = "known"
        yield a, b, kind, value, _features(value, kind, m["key"], text[max(0, a - 48):a], text[b:b + 16], path, lex)


def findings(docs: DataFrame, lex: Lexicon, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """``(id, th, start, end, kind, sha256, features)`` of every candidate in the
    whole texts; offsets count characters.  A candidate is a maximal run of any
    length, a private key the whole block from its BEGIN to its END line.  The
    candidates themselves are not passed on."""
    import hashlib
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(t).alias("th"), t.alias("t"),
                      (F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")).alias("p"))
    shared = docs.sparkSession.sparkContext.broadcast(lex)
    idt = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for b in batches:
            for first in range(0, b.num_rows, 512):
                part = b.slice(first, 512)
                row, out = [], []
                for i, (t, p) in enumerate(zip(part.column("t"), part.column("p"))):
                    for a, e, kind, value, x in _candidates(t.as_py(), p.as_py(), words):
                        row.append(i)
                        out.append((a, e, kind, hashlib.sha256(value.encode()).hexdigest(), x))
                if row:
                    c = list(zip(*out))
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(at), part.column("th").take(at), pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()),
                         pa.array(c[2], pa.string()), pa.array(c[3], pa.string()), pa.array(c[4], pa.list_(pa.float64()))],
                        names=["id", "th", "start", "end", "kind", "sha256", "features"])
    return src.mapInArrow(run, f"id {idt}, th long, start long, end long, kind string, sha256 string, features array<double>")


# Alphabets, names and forms of the planted findings.
_HEX, _LETTERS = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_ALNUM = _LETTERS + "0123456789"
_SECRET_NAMES = ("password", "passwd", "pwd", "secret", "client_secret", "token", "access_token", "api_key", "apikey", "private_key", "AccountKey",
                 "auth_token", "credential", "SECRET_KEY", "x-api-key", "passphrase", "signing_key", "authorization")
_HARMLESS_NAMES = ("sha1", "sha256", "md5", "commit", "checksum", "digest", "hash", "etag", "revision", "build", "version")
_NUMBER_NAMES = ("order", "invoice", "phone", "tel", "account", "card", "serial", "isbn", "id", "ref", "no.")
_PLACEHOLDERS = ("changeme", "change_me", "your_api_key_here", "your-token", "xxxxxxxxxxxxxxxx", "example_secret", "placeholder", "dummy-value", "sample_token_1",
                 "0000000000000000", "1234567890", "abcdefghijkl", "required", "undefined", "********")
_WORDS = ("house", "river", "stone", "water", "thing", "paper", "light", "garden", "number", "letter", "window", "market", "season", "winter", "morning",
          "music", "story", "table", "color", "village")
_PATHS = ("src/config/app.yaml", ".env", "deploy/secrets.properties"), ("tests/fixtures/data.json", "docs/readme.md", "examples/run.txt"), ("web/en/1.txt", "src/main.py", "")


def _plant(rng: random.Random, words: list[str]) -> tuple[str, str, str, str, str, float]:
    """``(form, text before, value, text after, path, label)`` of one planted finding."""
    word, some = lambda: rng.choice(words), lambda n, a: "".join(rng.choices(a, k=n))
    many = lambda least, sep, f=str: sep.join(f(x) for x in _until(word, least))

    def strong() -> str:
        return rng.choice((lambda: some(rng.choice((16, 24, 32, 40, 48, 64)), _HEX), lambda: some(rng.randrange(12, 64), _ALNUM),
                           lambda: some(rng.randrange(16, 90), _ALNUM + "+/") + "=" * rng.randrange(3), lambda: some(rng.randrange(16, 48), _LETTERS),
                           lambda: some(rng.randrange(16, 40), _LETTERS[26:])))()

    def password() -> str:
        return rng.choice((f"{word()}{rng.randrange(10 ** rng.randrange(1, 5))}{word()}", f"{word().capitalize()}{word().capitalize()}{rng.randrange(1, 999)}{rng.choice('!$#%&*')}",
                           some(rng.randrange(8, 20), _ALNUM), some(rng.randrange(8, 20), _ALNUM + "!$%^&*")))

    def named(names, value: str) -> tuple[str, str, str]:
        q, sep = rng.choice(("", '"', "'")), rng.choice((" = ", "=", ": ", ":", '": '))
        return f"{rng.choice(names)}{sep}{q}", value, q
    label = float(rng.random() < 0.5)
    if label:
        form = rng.choice(("known", "assigned", "assigned", "password", "uri", "auth", "bare"))
        if form == "known":
            value = rng.choice((lambda: "AKIA" + some(16, _ALNUM[:26] + "234567"), lambda: "ghp_" + some(36, _ALNUM), lambda: "sk_live_" + some(24, _ALNUM),
                                lambda: "AIza" + some(35, _ALNUM + "_-"), lambda: "sk-proj-" + some(40, _ALNUM), lambda: "xoxb-" + some(24, _ALNUM),
                                lambda: f"-----BEGIN PRIVATE KEY-----\n{some(64, _ALNUM)}\n-----END PRIVATE KEY-----"))()
            near = ("", value, "")
        elif form in ("assigned", "password"):
            near = named(_SECRET_NAMES, strong() if form == "assigned" else password())
        elif form == "uri":
            near = f"{rng.choice(('postgres', 'https', 'mysql', 'redis', 'amqp'))}://{word()}:", rng.choice((password, strong))().replace("/", "x"), f"@{word()}.{word()}/{word()}"
        elif form == "auth":
            near = rng.choice(("Authorization: Bearer ", "authorization: Basic ", "Bearer ", '"Authorization": "Bearer ')), strong() + some(4, _ALNUM), ""
        else:
            near = "", some(rng.randrange(24, 64), _ALNUM), ""
    else:
        form = rng.choice(("hash", "uuid", "digits", "placeholder", "named words", "words", "words", "dated", "prose"))
        if form == "hash":
            near = named(_HARMLESS_NAMES, some(rng.choice((32, 40, 64)), _HEX)) if rng.random() < 0.6 else (f"{rng.choice(_HARMLESS_NAMES)} ", some(rng.choice((32, 40, 64)), _HEX), "")
        elif form == "uuid":
            near = rng.choice(("", "id: ", "uuid=", "order ")), "-".join(some(n, _HEX) for n in (8, 4, 4, 4, 12)), ""
        elif form == "digits":
            value = some(rng.randrange(16, 24), _HEX[:10])
            near = named(_NUMBER_NAMES, value) if rng.random() < 0.5 else ("", value, "")
        elif form == "placeholder":
            near = named(_SECRET_NAMES, rng.choice(_PLACEHOLDERS))
        elif form == "named words":
            near = named(_SECRET_NAMES + ("key", "keys", "monkey"), many(rng.choice((6, 6, 14)), rng.choice(("-", "_", ".", ""))))
        elif form == "words":
            near = "", many(16, rng.choice(("-", "_", "/", "", "")), rng.choice((str, str, str.capitalize, str.upper))), ""
        elif form == "dated":
            near = "", f"{word()}-{rng.randrange(1990, 2040)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}-{many(5, '-')}", ""
        else:
            near = rng.choice(("basic ", "bearer ", "Basic ")), many(12, ""), ""
    # secrets are more often in configuration, harmless values in tests and documents
    path = rng.choice(rng.choices(_PATHS, (4, 1, 5) if label else (2, 3, 5))[0])
    before, after = " ".join(word() for _ in range(rng.randrange(9))), " ".join(word() for _ in range(rng.randrange(9)))
    return form, f"{before} {near[0]}", near[1], f"{near[2]} {after}", path, label


def _until(word, least: int) -> list[str]:
    out: list[str] = []
    while sum(map(len, out)) < least:
        out.append(word())
    return out


def planted(spark: SparkSession, lex: Lexicon, rows: int = 20_000, seed: int = 7) -> DataFrame:
    """``(doc_id, text, path, start, end, label, form)``: ``rows`` lines of words of the
    corpus, each with one value whose label is known because it was put there:
    secrets as keys, passwords and headers hold them, and hashes, numbers, names,
    placeholders and words that only look so.  The same rows at every run."""
    words = sorted(w for w in lex.words if 3 <= len(w) <= 12)
    words = random.Random(seed).sample(words, min(len(words), 2_000)) if len(words) >= 20 else list(_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in b.column(0).to_pylist():
                form, before, value, after, path, label = _plant(random.Random(seed * 1_000_003 + i), words)
                out.append((i, before + value + after, path, len(before), len(before) + len(value), label, form))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["doc_id", "text", "path", "start", "end", "label", "form"])
    return spark.range(0, rows, 1, 8).mapInArrow(run, "doc_id long, text string, path string, start long, end long, label double, form string")


def labelled(lines: DataFrame, lex: Lexicon) -> DataFrame:
    """The findings of :func:`planted` lines that lie in the planted value, with its
    ``label`` and ``form``."""
    at = lines.select(F.col("doc_id").alias("id"), F.col("start").alias("_a"), F.col("end").alias("_b"), "label", "form")
    return findings(lines, lex, path_col="path").join(at, "id").where("start < _b and end > _a").drop("_a", "_b")


def fit_forest(labelled: DataFrame, max_rows: int = 20_000, trees: int = 32, depth: int = 8):
    """A random forest on ``(features, label)``; ``max_rows`` bounds the sample (its
    expected size, by hash).  With fewer than two classes, their one label (0 if
    there is none) as a constant."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector
    n = labelled.groupBy("label").count().collect()
    total = sum(r["count"] for r in n)
    if len(n) < 2:
        return float(n[0]["label"]) if n else 0.0
    key = F.xxhash64("features", F.lit(5))
    d = labelled.where(F.pmod(key, F.lit(1_000_000)) < math.ceil(1_000_000 * max_rows / total)) if total > max_rows else labelled
    # one bounded partition in a fixed order: the same forest at every run
    d = d.select(array_to_vector("features").alias("features"), "label", key.alias("_k")).repartition(1).sortWithinPartitions("_k", "label")
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featuresCol="features", labelCol="label").fit(d)


def score(found: DataFrame, model) -> DataFrame:
    """``found`` with the probability ``score`` of being a secret."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    if isinstance(model, float):
        return found.withColumn("score", F.lit(model))
    x = found.withColumn("_raw", F.col("features")).withColumn("features", array_to_vector("features"))
    y = model.transform(x).withColumn("score", F.round(vector_to_array("probability")[1], 6))
    return y.withColumn("features", F.col("_raw")).select(*found.columns, "score")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
         label: Column | None = None, least: float = 0.5, lang_col: str | None = None, plants: int = 20_000) -> DataFrame:
    """``(id, th, start, end, kind, sha256, features, score, is_secret)`` of every
    candidate; ``is_secret``: the forest gives ``least`` or more.

    ``label`` is a column over the findings (1, 0, or null where unknown);
    without it the forest learns from ``plants`` :func:`planted` findings, whose
    labels do not depend on the features.  A null or empty text has no
    candidates, a null path no traits; an empty table gives no rows.  ``th``
    tells rows of one id apart; repeated rows give repeated findings."""
    lex = lexicon(docs, text_col, lang_col)
    found = saved(findings(docs, lex, id_col, text_col, path_col), "secret-findings")
    known = labelled(planted(docs.sparkSession, lex, plants), lex) if label is None else found.withColumn("label", label).where("label is not null")
    return score(found, fit_forest(known.select("features", "label"))).withColumn("is_secret", F.col("score") >= least)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", mark: str = "[SECRET]", **kw) -> DataFrame:
    """``docs`` with every found secret replaced by ``mark`` and ``chars_col``
    counted anew where the text changed; all rows and columns stay."""
    q = own_prefix(docs)
    spans = scan(docs, id_col, text_col, **kw).where("is_secret").groupBy("id", "th") \
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(f"{q}spans"))
    spans = saved(spans.select(F.col("id").alias(f"{q}rid"), F.col("th").alias(f"{q}rth"), f"{q}spans"), "secret-spans")
    text, found = F.col(text_col), F.col(f"{q}spans")
    th = F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))
    j = docs.withColumn(f"{q}th", th).join(spans, (F.col(f"{q}th") == F.col(f"{q}rth")) & F.col(id_col).eqNullSafe(F.col(f"{q}rid")), "left")
    cut = F.aggregate(found, F.struct(F.lit("").alias("s"), F.lit(0).cast("long").alias("at")), lambda a, x: F.struct(
        F.concat(a["s"], text.substr((a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit(mark)).alias("s"), x["end"].alias("at")))
    out = j.withColumn(f"{q}cut", cut).withColumn(f"{q}new", F.when(found.isNull(), text).otherwise(
        F.concat(f"{q}cut.s", text.substr((F.col(f"{q}cut.at") + 1).cast("int"), F.length(text)))))
    cols = [F.col(f"{q}new").alias(c) if c == text_col else
            F.when(found.isNull(), F.col(c)).otherwise(F.char_length(f"{q}new")).cast(docs.schema[c].dataType).alias(c) if c == chars_col
            else F.col(c) for c in docs.columns]
    return out.select(*cols)
