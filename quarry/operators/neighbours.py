"""Neighbours of every item (R4/R5) and best items for every user (R3), without pairing all with all.

The per-task arithmetic is NumPy over Arrow batches; Spark deals, shuffles and
merges.  Functions that run in tasks are nested, so that executors need no copy
of this package.
"""
from __future__ import annotations

import math
import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.windows import running_totals, top_n_per_group
from quarry.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["plan_tables", "similar_all", "recall", "recommend_pruned"]

_VECTOR_BYTES = 64 << 20
_USERS = 8192
#: nanoseconds for a byte of a vector sent to another task, and for a pair of vectors of 64 components scored, in a bucket and by a pass over all
_BYTE_NS, _PAIR_NS, _PASS_NS = 40, 6, 2
#: copies of the table that buckets may send
_COPIES = 4


def _usable(factors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, v array<double>)`` of rows with an id and a vector that has a direction."""
    v = F.col("v")
    ok = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return factors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .where(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))


def plan_tables(vectors: DataFrame, n: int, rows: int, bucket_rows: int | None = None, target: float = 0.95, sample: int = 2048,
                part_rows: int = 8192) -> tuple[int, int]:
    """``(bits, tables)`` with a chance of ``target`` that two neighbours share a bucket
    of some table, for buckets of about ``bucket_rows`` or, without it, of the
    size that costs least: small buckets score few pairs but need many tables,
    each of which sends every vector once (once a part of a bucket).  No
    bits, all pairs by :func:`_nearest_of_all`, is one of the choices, and the one
    taken where buckets would send over ``_COPIES`` copies of the table.

    How close neighbours are is read from at most ``sample`` vectors (those with
    the smallest hash of their id): the cosine that their n-th neighbours within
    the sample exceed in nine cases of ten, at most.  In the whole table
    neighbours are closer, so the estimate errs towards more tables."""
    import numpy as np
    bits = max(1, round(math.log2(max(2, rows / bucket_rows)))) if bucket_rows else 0
    x = [r["v"] for r in vectors.orderBy(F.xxhash64("id", F.lit(7)), "id").limit(sample).collect()]
    dim = max((len(v) for v in x), default=0)
    u = np.array([v for v in x if len(v) == dim], dtype=np.float64).reshape(-1, max(1, dim))
    size = np.linalg.norm(u, axis=1, keepdims=True)
    u = (u / np.where(size > 0, size, 1))[size[:, 0] > 0]
    if len(u) < 3:
        return bits, 1
    c = u @ u.T
    np.fill_diagonal(c, -np.inf)
    k = min(n, len(u) - 1)
    near = np.quantile(np.partition(c, len(u) - k, axis=1)[:, len(u) - k], 0.1)
    agree = 1 - math.acos(min(1.0, max(-1.0, near))) / math.pi  # that one hyperplane leaves both on one side
    needed = lambda b: 1 if b == 0 else max(1, math.ceil(math.log(1 - target) / math.log1p(-min(agree ** b, 1 - 1e-9))))
    if not bucket_rows:
        sent, pair = 4 * dim * _BYTE_NS, _PAIR_NS * max(dim, 32) / 64
        copies = lambda b: needed(b) * math.ceil(rows / 2 ** b / part_rows)
        cost = lambda b: copies(b) * sent + needed(b) * rows / 2 ** b * pair if b else rows * pair * _PASS_NS / _PAIR_NS
        bits = min((b for b in range(max(1, int(math.log2(max(2, rows / 256)))) + 1) if b == 0 or copies(b) <= _COPIES), key=lambda b: (cost(b), b))
    return bits, needed(bits)


def top_pairs():
    """A function for tasks: ``(i, j)`` of the entries of a matrix of at least a row's
    ``k``-th largest, less ``off``, and few others.  The ``k``-th largest of the maxima of
    many strided groups is at most that entry, and a maximum costs less than a partition."""
    def chosen(near, k: int, off: float):
        import numpy as np
        rows, cols = near.shape
        w = cols // 64
        g = near[:, :64 * w].reshape(rows, 64, w).max(axis=1) if w >= 4 * k else near
        low = np.partition(g, g.shape[1] - k, axis=1)[:, g.shape[1] - k] - np.float32(off)
        return np.divmod(np.flatnonzero(near >= low[:, None]), cols)
    return chosen


def similar_all(factors: DataFrame, n: int = 10, id_col: str = "id", vec_col: str = "features", bits: int | None = None,
                tables: int | None = None, bucket_rows: int | None = None, part_rows: int = 8192, seed: int = 42, digits: int = 6) -> DataFrame:
    """R4/R5 for every row: ``(query, neighbour, score, rank)``, the ``n`` nearest by
    cosine found for each (self included at 1.0), ties to the smaller id.

    Each row's side of random hyperplanes gives it one bucket in each of
    ``tables``; rows of a bucket are scored exactly against each other, a bucket
    of more than ``part_rows`` as pairs of parts in several tasks.  A task sends
    ``n`` neighbours a row, and the best over all buckets stay.  The table is read
    once, whatever the number of rows; the work is rows x tables x bucket size.
    ``bits`` and ``tables`` follow from :func:`plan_tables` unless given.  Without
    bits all pairs are scored, exactly, by :func:`_nearest_of_all`.

    The usable rows are stored once below the shared checkpoint folder, the
    vectors as they came.

    Rows with a null id or without a direction (null, zero or non-finite
    vectors) take no part; rows that share an id count once each as neighbours
    of others and keep the best score.  Empty tables give no rows."""
    spark = factors.sparkSession
    held = factors.schema[vec_col].dataType.simpleString()
    held = held if held == "array<float>" else "array<double>"  # vectors are sent as they are stored
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-vectors-{uuid.uuid4().hex}"
    own = _usable(factors, id_col, vec_col).withColumn("v", F.col("v").cast(held))
    own.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int")).write.option("parquet.enable.dictionary", "false").parquet(folder)
    v = spark.read.schema(own.schema).parquet(folder)
    rows = v.count()
    if bits is None or tables is None:
        b, t = plan_tables(v, n, rows, bucket_rows, part_rows=part_rows)
        bits, tables = b if bits is None else bits, t if tables is None else tables
    kind = v.schema["id"].dataType.simpleString()
    if bits == 0:
        top = _nearest_of_all(spark, folder, rows, n, kind, part_rows)
        return top.select("query", "neighbour", F.round("score", digits).alias("score"), "rank")

    def signed(batches):
        import numpy as np
        planes = {}
        for p in batches:
            size = p["v"].map(len).to_numpy()
            for dim in np.unique(size):
                own = p[size == dim]
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), tables * bits))
                side = (np.stack(own["v"].to_list()).astype(np.float64) @ planes[dim] > 0).reshape(len(own), tables, bits)
                code = (side * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
                yield pd.DataFrame({"id": own["id"], "v": own["v"], "dim": int(dim), "code": list(code)})
    coded = v.mapInPandas(signed, f"id {kind}, v {held}, dim int, code array<bigint>")
    coded = cut_lineage(coded)
    place = coded.select("id", "v", "dim", F.posexplode("code").alias("t", "code"))
    key = ["dim", "t", "code"]
    big = coded.select("dim", F.posexplode("code").alias("t", "code")).groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("m")).where("m > 1")
    r = place.join(big, key, "left").withColumn("m", F.coalesce("m", F.lit(1)))
    r = r.withColumn("s", F.pmod(F.xxhash64("id"), F.col("m")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    r = r.withColumn("a", F.least("s", "o")).withColumn("b", F.greatest("s", "o")).drop("o", "m")

    chosen = top_pairs()

    def scored(p: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        p = p.sort_values("id", kind="stable")
        x, ids = np.stack(p["v"].to_list()).astype(np.float64), p["id"].to_numpy()
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        y, off = x.astype(np.float32), 1e-6 + 4e-7 * x.shape[1]  # chosen in single precision, with its error to spare
        s, name = p["s"].to_numpy(), np.unique(ids, return_inverse=True)[1]
        again = int(np.bincount(name).max())  # rows of one id are one neighbour
        cross = p["a"].iloc[0] != p["b"].iloc[0]
        out = []
        for mine, other in ([(s == p["a"].iloc[0], s == p["b"].iloc[0]), (s == p["b"].iloc[0], s == p["a"].iloc[0])] if cross else [(s == s, s == s)]):
            mine, other = np.flatnonzero(mine), np.flatnonzero(other)
            for lo in range(0, len(mine) if len(other) else 0, 512):
                m = mine[lo:lo + 512]
                c = y[m] @ y[other].T
                i, j = chosen(c, min(n * again, len(other)), off)
                score = np.concatenate([(x[m[i[e:e + 65536]]] * x[other[j[e:e + 65536]]]).sum(axis=1) for e in range(0, len(i), 65536)])
                order = np.lexsort((j, -np.round(score, 12), i))
                if again > 1:
                    order = order[~pd.DataFrame({"i": i[order], "name": name[other[j[order]]]}).duplicated().to_numpy()]
                i, j, score = i[order], j[order], score[order]
                nth = np.arange(len(i)) - np.searchsorted(i, i)
                i, j, score = i[nth < n], j[nth < n], score[nth < n]
                out.append(pd.DataFrame({"query": ids[m[i]], "neighbour": ids[other[j]], "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query": ids[:0], "neighbour": ids[:0], "score": np.zeros(0)})
    found = r.groupBy(*key, "a", "b").applyInPandas(scored, f"query {kind}, neighbour {kind}, score double")
    best = found.groupBy("query", "neighbour").agg(F.max(F.round("score", 12)).alias("score"))
    top = top_n_per_group(best, ["query"], [F.desc("score"), F.col("neighbour")], n)
    return top.select("query", "neighbour", F.round("score", digits).alias("score"), F.col("rank").cast("int"))


def _nearest_of_all(spark, folder: str, rows: int, n: int, kind: str, part_rows: int) -> DataFrame:
    """``(query, neighbour, score, rank)``: the ``n`` nearest of all rows stored in ``folder``.

    A task takes the rows of about ``part_rows`` queries, all rows of an id
    together, and reads the stored vectors piece by piece; it keeps the ``n`` best so
    far, so neither vectors nor neighbours are sent from task to task.  A product in
    single precision chooses, with its error to spare, whom to score exactly."""
    from pyarrow import fs
    uri = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder
    where, path = fs.FileSystem.from_uri(uri)
    files = sorted(f.path for f in where.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))
    parts = min(1 << 20, max(spark.sparkContext.defaultParallelism, -(-rows // part_rows)))
    chosen = top_pairs()

    def pieces(size: int, columns: list):
        from pyarrow import fs, parquet
        where = fs.FileSystem.from_uri(uri)[0]
        for path in files:
            with where.open_input_file(path) as file:
                yield from parquet.ParquetFile(file).iter_batches(size, columns=columns)

    def unit(column):
        """``{length: (places, vectors of length one)}``"""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        size, out = pc.list_value_length(column).to_numpy(), {}
        for d in np.unique(size).tolist():
            at = np.flatnonzero(size == d)
            x = column.take(pa.array(at)).flatten().to_numpy().astype(np.float64).reshape(-1, d)
            size_of = np.linalg.norm(x, axis=1, keepdims=True)
            odd = np.flatnonzero(~((size_of > 1e-100) & (size_of < 1e100)))  # their squares leave the range of numbers
            x[odd] /= np.abs(x[odd]).max(axis=1, keepdims=True)
            size_of[odd] = np.linalg.norm(x[odd], axis=1, keepdims=True)
            out[d] = at, x / size_of
        return out

    def nearest(batches):
        for b in batches:
            for k in b["id"]:
                yield from of_part(int(k))

    def of_part(number: int):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        own = []
        for b in pieces(65536, ["id", "v", "part"]):
            b = b.filter(pc.equal(pa.array(b.column("part").to_numpy() % parts), number))
            if b.num_rows:
                own.append(b)
        if not own:
            return
        own = pa.Table.from_batches(own).combine_chunks()
        ids, by_dim = own["id"].to_pandas().to_numpy(), unit(own["v"].combine_chunks())
        del own
        # of each query: neighbours and their scores, and the n-th best score where there are n
        near_ids, scores = np.full((len(ids), n), ids[0], dtype=ids.dtype), np.full((len(ids), n), -np.inf)
        for b in pieces(8192, ["id", "v"]):
            them = b.column("id").to_pandas().to_numpy()
            for d, (at, z) in unit(b.column("v")).items():
                if d not in by_dim:
                    continue
                mine, x = by_dim[d]
                w, off = z.astype(np.float32).T, np.float32(6.5e-8 * (d + 8))  # no product of unit vectors is further off
                place, times = np.unique(them[at], return_inverse=True, return_counts=True)[1:]
                again, first = int(times.max()), None  # rows of one id are one neighbour
                for lo in range(0, len(mine), 512):
                    m = mine[lo:lo + 512]
                    near, low = x[lo:lo + 512].astype(np.float32) @ w, scores[m, n - 1].astype(np.float32) - off
                    if np.isfinite(low).all():
                        some = np.flatnonzero(near.max(axis=1) >= low)
                        i, j = np.divmod(np.flatnonzero(near[some] >= low[some][:, None]), len(at))
                        i = some[i]
                    else:
                        i, j = chosen(near, min(n * again, len(at)), off)
                        hit = near[i, j] >= low[i]
                        i, j = i[hit], j[hit]
                    if len(i) > 16 * len(m):  # many within that error: chosen again in double precision
                        near, least = x[lo:lo + 512] @ z.T, scores[m, n - 1] - 2e-12
                        if not np.isfinite(low).all():
                            i, j = chosen(near, min(n * again, len(at)), 2e-12)
                        hit = near[i, j] >= least[i]
                        i, j = i[hit], j[hit]
                    if len(i) > 64 * len(m):  # of equal vectors, those of the smallest ids
                        if first is None:
                            same = np.unique(np.ascontiguousarray(z).view(f"V{8 * d}").ravel(), return_inverse=True)[1]
                            order = np.lexsort((place, same))
                            nth, first = np.arange(len(at)) - np.searchsorted(same[order], same[order]), np.zeros(len(at), dtype=bool)
                            first[order] = nth < n * again
                        hit = first[j]
                        i, j = i[hit], j[hit]
                    if not len(i):
                        continue
                    score = np.concatenate([(x[lo + i[e:e + 65536]] * z[j[e:e + 65536]]).sum(axis=1) for e in range(0, len(i), 65536)])
                    # with those so far: by score, then by id, each id once
                    q = np.unique(i)
                    had = np.flatnonzero(np.isfinite(scores[m[q]]).ravel())
                    i = np.concatenate([np.searchsorted(q, i), had // n])
                    score = np.concatenate([np.round(score, 12), scores[m[q]].ravel()[had]])
                    them_all = np.concatenate([them[at[j]], near_ids[m[q]].ravel()[had]])
                    names, name = np.unique(them_all, return_inverse=True)
                    order = np.lexsort((-score, name, i))
                    order = order[np.concatenate([[True], (i[order][1:] != i[order][:-1]) | (name[order][1:] != name[order][:-1])])]
                    order = order[np.lexsort((name[order], -score[order], i[order]))]
                    i, score, name = i[order], score[order], name[order]
                    nth = np.arange(len(i)) - np.searchsorted(i, i)
                    i, score, name, nth = i[nth < n], score[nth < n], name[nth < n], nth[nth < n]
                    near_ids[m[q[i]], nth], scores[m[q[i]], nth] = names[name], score
        i, nth = np.nonzero(np.isfinite(scores))
        out = pd.DataFrame({"query": ids[i], "neighbour": near_ids[i, nth], "score": scores[i, nth]})
        if len(set(ids.tolist())) < len(ids):  # rows of one id keep the best
            out = out.sort_values(["query", "score", "neighbour"], ascending=[True, False, True]).drop_duplicates(["query", "neighbour"])
            out = out[out.groupby("query").cumcount() < n]
        out["rank"] = out.groupby("query", sort=False).cumcount().astype("int32") + 1
        yield out
    return spark.range(0, parts, 1, parts).mapInPandas(nearest, f"query {kind}, neighbour {kind}, score double, rank int")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``(n_exact, n_found, recall)``: share of the exact neighbours that were found."""
    hit = exact.select("query", "neighbour").join(found.select("query", "neighbour", F.lit(1).alias("_hit")), ["query", "neighbour"], "left")
    return hit.agg(F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_found")) \
        .withColumn("recall", F.col("n_found") / F.col("n_exact"))


def recommend_pruned(user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame | None = None, n: int = 10, user: str = "user",
                     item: str = "item", block: int = 512, band_bytes: int = _VECTOR_BYTES, stats=None, group: str | None = None) -> DataFrame:
    """R3 for every user, exact: ``(user, item, score, rank)``, the ``n`` best unseen
    items by inner product, ties to the smaller item.

    Items come in order of falling norm, in bands of at most ``band_bytes``, which
    are written once below the shared checkpoint folder.  A task takes some
    thousands of users at a time and reads band after band; within a band it goes
    through blocks of ``block`` items.  No item of a block can score more than the
    user's norm times the block's largest norm (Cauchy-Schwarz), so a user whose n-th best
    score so far lies above that is done, for this block and all behind it,
    and the next band is not read when no user of the task is left.  What
    is written grows with users plus items, not with users times bands, and no
    item passes through the driver.

    ``user_factors`` and ``item_factors`` hold ``(id, features)``; ``seen`` pairs of
    ``(user, item)``.  ``group`` names an integer column of both factor tables: a
    user has then also seen all items of the own group, without a list of
    these pairs, which grows with users times items.  Null ids or vectors, and vectors with a null or non-finite
    component, take no part, nor do items of another length than the user's
    vector; repeated ids count once (the largest vector).  ``stats`` is an
    accumulator that counts the scores computed."""
    held = {f.schema["features"].dataType.simpleString() for f in (user_factors, item_factors)}
    held = "array<float>" if held == {"array<float>"} else "array<double>"  # vectors are sent as they are stored

    def clean(f: DataFrame, name: str, parts: int | None = None) -> DataFrame:
        v = F.col("v")
        ok = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        g = (F.lit(None) if group is None else F.col(group)).cast("long").alias("g")
        f = f.select(F.col("id").alias(name), F.col("features").cast(held).alias("v"), g).where(F.col(name).isNotNull() & F.coalesce(ok, F.lit(False)))
        return (f if parts is None else f.repartition(parts, name)).groupBy(name).agg(F.max("v").alias("v"), F.max("g").alias("g"))
    norm = F.sqrt(F.aggregate(F.col("v").cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x))
    items = cut_lineage(clean(item_factors, "item").withColumn("norm", norm))
    total = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    per_band = max(block, band_bytes // (8 * max(1, total["dim"] or 1) + 64))
    bands = -(-total["n"] // per_band)
    if bands > 1:  # places in order of falling norm, so that a band is bounded even where norms are equal
        items = running_totals(items.withColumn("neg", -F.col("norm")), "neg", {"pos": F.lit(1).cast("bigint")}, tie_cols=["item"]).drop("neg")
        items = items.withColumn("band", F.floor((F.col("pos") - 1) / per_band).cast("int"))
    else:
        items = items.withColumn("band", F.lit(0))
    spark = user_factors.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-item-bands-{uuid.uuid4().hex}"
    items.select("band", "item", "v", "g", "norm").repartition(max(1, bands), "band").write.partitionBy("band").parquet(folder)
    # a task's users: some thousands, by a number of parts that is not coalesced to fewer than the cores
    parts = max(spark.sparkContext.defaultParallelism, -(-user_factors.count() // _USERS))
    users = clean(user_factors, "user", parts)
    uk, ik = users.schema["user"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    if seen is not None:
        had = seen.select(F.col(user).alias("user"), F.col(item).alias("item")).where("user IS NOT NULL AND item IS NOT NULL") \
            .repartition(parts, "user").groupBy("user").agg(F.collect_set("item").alias("seen"))
        users = users.join(had, "user", "left")
    else:
        users = users.withColumn("seen", F.lit(None).cast(f"array<{ik}>"))

    def load(number: int):
        """``(smallest norm, {length: (norms, items, vectors, groups, has a group)})`` of a band."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs, parquet
        where, path = fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)
        files = [f.path for f in where.get_file_info(fs.FileSelector(f"{path}/band={number}")) if f.path.endswith(".parquet")]
        t = pa.concat_tables([parquet.ParquetFile(where.open_input_file(f)).read() for f in files])
        t = t.take(np.argsort(-t["norm"].to_numpy(), kind="stable"))
        size, by_dim = pc.list_value_length(t["v"]), {}
        for d in pc.unique(size).to_pylist():
            own = t.filter(pc.equal(size, d))
            has = own["g"].is_valid().to_numpy()
            by_dim[d] = own["norm"].to_numpy(), own["item"].to_pylist(), \
                own["v"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(own), d), own["g"].fill_null(-1).to_numpy(), has
        return float(t["norm"][len(t) - 1].as_py()), by_dim

    def scored(batches):
        import heapq

        import numpy as np

        def _runs(row, col):
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else np.zeros(0, dtype=np.int64)
            return row[first].tolist(), [c.tolist() for c in np.split(col, first[1:])] if len(row) else []
        last = {}  # the band read last
        for p in batches:
            out = []
            for d, g in p.groupby(p["v"].map(len)):
                mine, has = g["g"].fillna(-1).to_numpy(dtype=np.int64), g["g"].notna().to_numpy()
                u = np.array(g["v"].to_list(), dtype=np.float64).reshape(len(g), d)
                size = np.sqrt((u * u).sum(axis=1)) * (1 + 1e-12)
                best, low, seen_by = [[] for _ in range(len(g))], np.full(len(g), -np.inf), g["seen"].to_list()
                left = np.arange(len(g))
                for number in range(bands):
                    if number not in last:
                        last.clear()
                        last[number] = load(number)
                    rest, by_dim = last[number]
                    if d in by_dim:
                        nrm, own, m, of, any_of = by_dim[d]
                        place = {x: j for j, x in enumerate(own)}
                        had = [[place[x] for x in seen_by[i] if x in place] if seen_by[i] is not None else [] for i in left]
                        had_of, had_at = np.repeat(left, [len(x) for x in had]), np.array([j for x in had for j in x], dtype=np.int64)
                        order = np.argsort(had_at, kind="stable")
                        had_of, had_at = had_of[order], had_at[order]
                        for at in range(0, len(own), block):
                            live = left[size[left] * nrm[at] >= low[left]]
                            if not len(live):
                                break
                            part, score = own[at:at + block], u[live] @ m[at:at + block].T
                            if stats is not None:
                                stats.add(score.size)
                            a, b = np.searchsorted(had_at, [at, at + len(part)])
                            row = np.full(len(u), -1)
                            row[live] = np.arange(len(live))
                            x, y = row[had_of[a:b]], had_at[a:b] - at
                            score[x[x >= 0], y[x >= 0]] = -np.inf
                            if group is not None:
                                score[(mine[live][:, None] == of[None, at:at + block]) & has[live][:, None] & any_of[None, at:at + block]] = -np.inf
                            least = low[live]
                            new = np.flatnonzero(~np.isfinite(least))  # too few so far: the block's own n-th
                            if len(new) and len(part) > n:
                                least[new] = np.partition(score[new], len(part) - n, axis=1)[:, len(part) - n]
                            least = np.where(np.isfinite(least), least, -np.finfo(float).max)
                            at_row, at_col = np.nonzero(score >= (least - 1e-9 * (1 + np.abs(least)))[:, None])
                            real = np.isfinite(score[at_row, at_col])
                            at_row, at_col = at_row[real], at_col[real]
                            for k, js in zip(*_runs(at_row, at_col)):
                                i = live[k]
                                best[i] += [(float(u[i] @ m[at + j]), part[j]) for j in js]
                                if len(best[i]) > n:
                                    best[i] = heapq.nsmallest(n, best[i], key=lambda x: (-x[0], x[1]))
                                if len(best[i]) == n:
                                    low[i] = min(x[0] for x in best[i])
                    left = left[size[left] * rest >= low[left]]
                    if not len(left):
                        break
                best = [sorted(b, key=lambda x: (-x[0], x[1])) for b in best]
                out.append(pd.DataFrame({"user": g["user"], "best": [[{"score": s, "item": i} for s, i in b] for b in best]}))
            if out:
                yield pd.concat(out)
    result = users.mapInPandas(scored, f"user {uk}, best array<struct<score:double,item:{ik}>>")
    e = result.select(F.col("user").alias(user), F.posexplode("best").alias("at", "x"))
    return e.select(user, F.col("x.item").alias(item), F.col("x.score").alias("score"), (F.col("at") + 1).cast("int").alias("rank"))
