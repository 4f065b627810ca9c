"""Recommendation operators.

Exact top-N similarity deals queries and candidates in parts; each pair of
parts is scored in one task, which sends the best of its candidates a query.
"""
from __future__ import annotations

import contextlib
import threading
import uuid
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import cosine
from quarry.operators.joins import exclude_seen
from quarry.operators.neighbours import recommend_pruned, top_pairs
from quarry.operators.windows import index_ids, running_totals, top_n_per_group
from quarry.session import cut_lineage, ensure_checkpoint_dir

__all__ = ["implicit_positives", "implicit_rows", "interaction_triples", "interactions", "similar", "fit_als", "recommend", "als_report",
           "popular_unseen"]

def implicit_positives(ratings: DataFrame, rating: str = "rating", min_rating: int = 4,
                       user: str = "user", item: str = "item") -> DataFrame:
    """Keep ratings >= ``min_rating``; report kept rows, % kept, users and items left (one scan)."""
    ok = F.col(rating) >= min_rating
    a = ratings.agg(F.count(F.lit(1)).alias("_n"), F.count_if(ok).alias("n_kept"),
                    F.count_distinct(F.when(ok, F.col(user))).alias("n_users"),
                    F.count_distinct(F.when(ok, F.col(item))).alias("n_items"))
    return a.select("n_kept", "n_users", "n_items", F.round(F.col("n_kept") * 100.0 / F.col("_n"), 4).alias("pct_kept"))


def implicit_rows(ratings: DataFrame, rating: str = "rating", min_rating: int = 4) -> DataFrame:
    """The kept rows themselves."""
    return ratings.where(F.col(rating) >= min_rating)


def interaction_triples(ratings: DataFrame, user: str = "user", item: str = "item", rating: str = "rating") -> DataFrame:
    """``(user_index, item_index, rating)``: duplicates summed, dense zero-based indices in id order."""
    pairs = cut_lineage(ratings.groupBy(user, item).agg(F.sum(rating).alias(rating)))
    ui, ii = index_ids(pairs, user, "user_index"), index_ids(pairs, item, "item_index")
    return pairs.join(ui, user).join(ii, item).select("user_index", "item_index", user, item, rating)


def interactions(ratings: DataFrame, user: str = "user", item: str = "item",
                 rating: str = "rating") -> DataFrame:
    """Duplicates summed; dimensions and sparsity of the implied matrix."""
    pairs = ratings.groupBy(user, item).agg(F.sum(rating).alias(rating))
    return pairs.agg(F.count_distinct(user).alias("n_users"), F.count_distinct(item).alias("n_items"),
                     F.count(F.lit(1)).alias("nnz")) \
        .withColumn("sparsity_pct", F.round((F.lit(1.0) - F.col("nnz") / (F.col("n_users").cast("double") * F.col("n_items"))) * 100, 4))


def similar(factors: DataFrame, query_ids: DataFrame, n: int = 10, id_col: str = "id",
            vec_col: str = "features", block: int = 1024, digits: int = 6, part_rows: int = 8192, plain_pairs: int = 1 << 22) -> DataFrame:
    """Top-``n`` cosine neighbours of each query id (self included at 1.0), exact.

    Up to ``block`` queries are scored by :func:`_similar_plain`, without Python, while
    their pairs with the candidates are at most ``plain_pairs``; with more candidates
    :func:`_similar_few` scores them where the candidates lie.  More
    queries and the candidates are dealt in parts of about ``part_rows``, and every pair
    of parts is scored in one task: a matrix product in single precision chooses,
    with its error to spare, and the chosen get the exact cosine.  A task's memory
    is bounded by the parts, and a query sends ``n`` rows a part.  Rows whose cosine
    is undefined (null ids or vectors, zero, non-finite or of another length) go
    through :func:`_similar_plain`."""
    f = factors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("held"))
    asked = query_ids.select(F.col(id_col).alias("id")).distinct()
    best = lambda scored: top_n_per_group(scored, ["query"], [F.desc("score"), F.col("neighbour")], n) \
        .select("query", "neighbour", F.round("score", digits).alias("score"), F.col("rank").cast("int"))
    few = cut_lineage(f.join(asked, "id", "left_semi"))
    asking = few.count()
    if asking <= block and asking * f.count() <= plain_pairs:
        return best(_similar_plain(f, few, n, block))
    v, size = F.col("v"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    ok = F.coalesce(~F.exists(v, lambda x: x.isNull() | F.isnan(x)) & size.between(1e-100, 1e100) & F.col("id").isNotNull(), F.lit(False))
    f = cut_lineage(f.withColumn("v", F.col("held").cast("array<double>")).select("id", "held", F.when(ok, F.size("v")).alias("dim")))
    dim = f.agg(F.mode("dim")).first()[0] or 0
    f = f.select("id", "held", F.coalesce(F.col("dim") == dim, F.lit(False)).alias("whole"))
    q = cut_lineage(f.join(asked, "id", "left_semi"))
    found = [_similar_few(f.where("whole"), q.where("whole"), n) if asking <= block else _similar_parts(f.where("whole"), q.where("whole"), n, part_rows)]
    odd, odd_q = f.where("NOT whole"), q.where("NOT whole")
    if not odd.isEmpty():
        found.append(_similar_plain(odd, q, n, block))
    if not odd_q.isEmpty():
        found.append(_similar_plain(f.where("whole"), odd_q, n, block))
    scored = found[0]
    for x in found[1:]:
        scored = scored.unionByName(x)
    return best(scored)


def _similar_parts(c: DataFrame, q: DataFrame, n: int, part_rows: int) -> DataFrame:
    """``(query, neighbour, score)``: the ``n`` best of each part, for vectors of one length."""
    a, b = max(1, -(-q.count() // part_rows)), max(1, -(-c.count() // part_rows))
    own = lambda m: F.pmod(F.xxhash64("id", "held"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    dealt = q.select("id", "held", F.lit(True).alias("asks"), own(a).alias("a"), every(b).alias("b")) \
        .unionByName(c.select("id", "held", F.lit(False).alias("asks"), own(b).alias("b"), every(a).alias("a")))
    kind = c.schema["id"].dataType.simpleString()
    return dealt.groupBy("a", "b").applyInPandas(_scorer(n), f"query {kind}, neighbour {kind}, score double")


def _similar_few(c: DataFrame, q: DataFrame, n: int) -> DataFrame:
    """The same for a block of queries, which every task gets: a batch of candidates
    leaves ``n`` rows a query, and no candidate is sent."""
    few, scored = q.select("id", "held").toPandas().assign(asks=True), _scorer(n)
    kind = c.schema["id"].dataType.simpleString()

    def batchwise(batches):
        for b in batches:
            if len(b) and len(few):
                yield scored(pd.concat([few, b.assign(asks=False)], ignore_index=True))
    return c.select("id", "held").mapInPandas(batchwise, f"query {kind}, neighbour {kind}, score double")


def _scorer(n: int):
    """A function for tasks: the ``n`` best candidates of each query in a frame of both."""
    chosen = top_pairs()

    def scored(p: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        p = p.sort_values("id", kind="stable")
        asks, ids = p["asks"].to_numpy(), p["id"].to_numpy()
        x = np.stack(p["held"].to_list()).astype(np.float64)

        def summed(l, r):  # in the order of the components, as the SQL expression does
            out = np.zeros(len(l))
            for k in range(x.shape[1]):
                out += l[:, k] * r[:, k]
            return out
        size = np.sqrt(summed(x, x))
        y, off = (x / size[:, None]).astype(np.float32), 1e-6 + 4e-7 * x.shape[1]
        mine, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        k = min(n, len(other))
        out = [pd.DataFrame({"query": ids[:0], "neighbour": ids[:0], "score": np.zeros(0)})]
        for lo in range(0, len(mine) if k else 0, 512):
            m = mine[lo:lo + 512]
            near = y[m] @ y[other].T
            i, j = chosen(near, k, off)
            score = np.concatenate([summed(x[m[i[e:e + 65536]]], x[other[j[e:e + 65536]]]) for e in range(0, len(i), 65536)])
            score /= size[m[i]] * size[other[j]]
            order = np.lexsort((j, -score, i))
            i, j, score = i[order], j[order], score[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append(pd.DataFrame({"query": ids[m[i[best]]], "neighbour": ids[other[j[best]]], "score": score[best]}))
        return pd.concat(out[1:] or out)
    return scored


def _similar_plain(c: DataFrame, q: DataFrame, n: int, block: int) -> DataFrame:
    """``(query, neighbour, score)`` by the SQL expression, which says what undefined
    cosines are.  A block of about ``block`` queries is one scalar of the plan; every
    candidate row is scored against it map-side."""
    q = q.select(F.col("id").alias("query"), F.col("held").alias("qv"))
    blocks = max(1, -(-q.count() // block))
    q = cut_lineage(q.withColumn("_b", F.pmod(F.xxhash64("query"), F.lit(blocks))))
    out = None
    for k in range(blocks):
        qs = q.where(F.col("_b") == k).agg(F.collect_list(F.struct("query", "qv")).alias("_q"))  # one row of about block vectors
        # explode_outer: no inferred size() > 0 filter re-running the scoring
        scored = c.select(F.col("id").alias("neighbour"), F.col("held").alias("_v"), qs.scalar().alias("_q")) \
            .select("neighbour", F.explode_outer(F.transform("_q", lambda s: F.struct(
                s["query"].alias("query"), cosine(F.col("_v"), s["qv"]).alias("score")))).alias("s")) \
            .select("s.query", "neighbour", "s.score").where(F.col("query").isNotNull())
        top = top_n_per_group(scored, ["query"], [F.desc("score"), F.col("neighbour")], n).drop("rank")
        out = top if out is None else out.unionByName(top)
    return out


class Factors(NamedTuple):
    """A fitted model: ``(id, features)`` of users and of items, stored below the checkpoint folder."""
    rank: int
    userFactors: DataFrame
    itemFactors: DataFrame


def fit_als(ratings: DataFrame, rank: int = 50, reg: float = 0.01, iters: int = 15, alpha: float = 1.0,
            seed: int = 42, user: str = "user", item: str = "item", rating: str = "rating",
            n_blocks: int | None = None, block_ratings: int = 2_000_000) -> Factors:
    """R2: implicit-feedback ALS (lambda scaled by counts and confidence 1 + alpha*r, as Spark's).

    Spark's ALS checks the ratings and draws the first factors, by ``n_blocks``
    (default: the cluster parallelism).  Its iterations send each factor to every block
    with a rating of it, nearly ``n_blocks`` copies on disk; here each half of an
    iteration writes its factors once, below the shared checkpoint folder.  The
    ratings are dealt by user, and by item, into blocks of about
    ``block_ratings``, stored once, a file each; a task of the next half reads its
    block's file and the stored factors in pieces, keeps those its block has
    ratings of and solves the block's rows.
    What is written grows with the factors times iterations, what is read with the
    blocks besides, and a task holds no more factors than its block has ratings."""
    spark = ratings.sparkSession
    if n_blocks is None:
        n_blocks = max(2, spark.sparkContext.defaultParallelism)
    parts = max(n_blocks, -(-ratings.count() // block_ratings))
    own = ratings.select(F.col(user).cast("int").alias("user"), F.col(item).cast("int").alias("item"), F.col(rating).cast("float").alias("rating"))
    als = ALS(implicitPrefs=True, rank=rank, regParam=reg, maxIter=0, alpha=alpha, seed=seed, userCol="user", itemCol="item",
              ratingCol="rating", coldStartStrategy="drop", numUserBlocks=n_blocks, numItemBlocks=n_blocks)
    stored = []
    try:
        with _unused_files_removed(spark):
            stored.append(_stored_blocks(own, parts, "user", "item"))
            by_user = spark.read.schema(own.schema).parquet(stored[0])
            start = als.fit(by_user)
            stored.append(_stored_blocks(by_user, parts, "item", "user"))
            users = _stored_factors(start.userFactors)
            items = _stored_factors(start.itemFactors)
            del start
            for k in range(iters):
                items = _solved(spark, stored[1], "item", "user", users, items, rank, reg, alpha, k == iters - 1)
                users = _solved(spark, stored[0], "user", "item", items, users, rank, reg, alpha, k == iters - 1)
    finally:
        for folder in stored:
            _removed(folder)
    return Factors(rank, *(spark.read.schema("id int, features array<float>").parquet(f) for f in (users, items)))


def _stored_blocks(ratings: DataFrame, parts: int, *own: str) -> str:
    """The folder of the ratings, dealt by the first of ``own`` and sorted; a file is a block."""
    folder = f"{ensure_checkpoint_dir(ratings.sparkSession).rstrip('/')}/quarry-ratings-{uuid.uuid4().hex}"
    ratings.repartition(parts, own[0]).sortWithinPartitions(*own, "rating").write.option("maxRecordsPerFile", 0).parquet(folder)
    return folder


def _stored_factors(factors: DataFrame) -> str:
    folder = f"{ensure_checkpoint_dir(factors.sparkSession).rstrip('/')}/quarry-factors-{uuid.uuid4().hex}"
    factors.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(folder)
    return folder


def _at(folder: str) -> str:
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder


def _files(folder: str) -> list[str]:
    from pyarrow import fs
    where, path = fs.FileSystem.from_uri(_at(folder))
    return sorted(f.path for f in where.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet"))


def _removed(folder: str) -> None:
    from pyarrow import fs
    where, path = fs.FileSystem.from_uri(_at(folder))
    where.delete_dir(path)


def _factor_pieces(rank: int):
    """A function for tasks: ``(ids, vectors)`` of a file of factors, a piece at a time.  A
    vector is stored as an array or, between the iterations, as its bytes."""
    def pieces(where, path: str):
        import numpy as np
        import pyarrow as pa
        from pyarrow import parquet
        with where.open_input_file(path) as file:
            for b in parquet.ParquetFile(file).iter_batches(65536):
                x = b.column("features")
                if pa.types.is_list(x.type):
                    x = x.flatten().to_numpy()
                else:
                    at = np.frombuffer(x.buffers()[1], np.int32)[x.offset:x.offset + len(x) + 1]
                    x = np.frombuffer(x.buffers()[2], np.uint8)[at[0]:at[-1]].view(np.float32)
                yield b.column("id").to_numpy(), x.reshape(-1, rank)
    return pieces


def _solved(spark, blocks: str, mine: str, other: str, source: str, before: str, rank: int, reg: float, alpha: float, last: bool) -> str:
    """The folder of the factors of ``mine`` for those of ``other``, stored in ``source``;
    those of the iteration ``before`` are removed.

    For a row with ratings r of the vectors y: (Y'Y + sum alpha|r| yy' + reg n I) x = sum (1 + alpha|r|) y,
    the right side and n over r > 0, in double precision."""
    pieces, factor_files, block_files = _factor_pieces(rank), _files(source), _files(blocks)
    at_uri, room, piece = _at(source), 1 << 21, 8192
    each = lambda files: spark.range(0, len(files), 1, len(files))  # a task a file

    def squares(batches):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs
        total, where = np.zeros((rank, rank)), fs.FileSystem.from_uri(at_uri)[0]
        for b in batches:
            for k in b.column("id").to_pylist():
                for _, x in pieces(where, factor_files[k]):
                    x = x.astype(np.float64)
                    total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["g"])
    gram = sum(np.array(r["g"]).reshape(rank, rank) for r in each(factor_files).mapInArrow(squares, "g array<double>").collect())

    def solve(batches):
        for b in batches:
            for k in b.column("id").to_pylist():
                yield from solved(block_files[k])

    def solved(block: str):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs, parquet
        where = fs.FileSystem.from_uri(at_uri)[0]
        with where.open_input_file(block) as file:
            t = parquet.ParquetFile(file).read()
        if not t.num_rows:
            return
        need, at = np.unique(t[other].to_numpy(), return_inverse=True)
        own, first, n = np.unique(t[mine].to_numpy(), return_index=True, return_counts=True)  # the block is sorted
        r = t["rating"].to_numpy().astype(np.float64)
        del t
        v, found = np.empty((len(need), rank), dtype=np.float32), 0
        for f in factor_files:
            for ids, x in pieces(where, f):
                p = np.minimum(np.searchsorted(need, ids), len(need) - 1)
                hit = need[p] == ids
                v[p[hit]] = x[hit]
                found += int(hit.sum())
        if found != len(need):
            raise RuntimeError(f"{found} of {len(need)} factors found in {at_uri}")
        c = alpha * np.abs(r)
        right, positive = np.where(r > 0, 1 + c, 0), np.add.reduceat(r > 0, first, dtype=np.int64)
        usual = bool((r > 0).all()) and c.min() > 1e-6
        x, diagonal = np.empty((len(own), rank), dtype=np.float32), np.arange(rank)
        for k in np.unique(n).tolist():  # rows of equally many ratings at a time
            rows = np.flatnonzero(n == k)
            few = np.linalg.inv(gram + reg * k * np.eye(rank)) if usual and 2 * k <= rank else None
            step = max(1, room // (rank * max(rank, min(k, piece))))
            for lo in range(0, len(rows), step):
                g = rows[lo:lo + step]
                if few is not None:  # (M + y'Cy)^-1 y'w = M^-1 y' (yM^-1y' + 1/C)^-1 w/C, a system of k instead of rank
                    i = first[g][:, None] + np.arange(k)
                    y = v[at[i]].astype(np.float64)
                    ym = (y.reshape(-1, rank) @ few).reshape(y.shape)
                    a = ym @ y.transpose(0, 2, 1)
                    a[:, np.arange(k), np.arange(k)] += 1 / c[i]
                    x[g] = (np.linalg.solve(a, (right[i] / c[i])[..., None]).transpose(0, 2, 1) @ ym)[:, 0]
                    continue
                a, b = np.repeat(gram[None], len(g), axis=0), np.zeros((len(g), rank))
                for e in range(0, k, piece):
                    i = first[g][:, None] + np.arange(e, min(k, e + piece))
                    y = v[at[i]].astype(np.float64)
                    a += y.transpose(0, 2, 1) @ (y * c[i][..., None])
                    b += (right[i][:, None, :] @ y)[:, 0]
                a[:, diagonal, diagonal] += reg * positive[g][:, None]
                x[g] = np.linalg.solve(a, b[..., None])[..., 0]
        for lo in range(0, len(own), 10_000):
            part, ids = x[lo:lo + 10_000], pa.array(own[lo:lo + 10_000], pa.int32())
            if last:
                part = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * rank, pa.int32()), pa.array(part.ravel()))
            else:
                part = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer((np.arange(len(part) + 1) * rank * 4).astype(np.int32)), pa.py_buffer(part)])
            yield pa.RecordBatch.from_arrays([ids, part], names=["id", "features"])
    folder = _stored_factors(each(block_files).mapInArrow(solve, f"id int, features {'array<float>' if last else 'binary'}"))
    _removed(before)
    return folder


@contextlib.contextmanager
def _unused_files_removed(spark, seconds: float = 5.0):
    """Spark removes shuffle files, and blocks of cached data, that nothing refers to
    once the driver's garbage is collected, and asks for that each
    ``spark.cleaner.periodicGC.interval`` (30 minutes).  While the body runs it is
    asked every ``seconds``; a shorter body never asks."""
    ended, gc = threading.Event(), spark.sparkContext._jvm.System.gc

    def ask() -> None:
        while not ended.wait(seconds):
            gc()
    asking = threading.Thread(target=ask, daemon=True)
    asking.start()
    try:
        yield
    finally:
        ended.set()
        asking.join()


def recommend(model: Factors, seen: DataFrame, n: int = 10, user: str = "user", item: str = "item",
              users: DataFrame | None = None) -> DataFrame:
    """Best ``n`` unseen items for ``users`` (default: every user with an
    interaction), exact.

    Within the blocks of :func:`~quarry.operators.neighbours.recommend_pruned` the
    seen items are left out before the best are kept, so a user carries ``n``
    items from block to block.  ALS's own blockwise top-k would send ``n`` plus
    the items seen for every block of items, which fills the disks.  Scores are
    summed in double precision and returned as floats, like ALS's."""
    if users is not None:
        seen = seen.join(users.select(user).distinct(), user, "left_semi")
    own = model.userFactors.join(seen.select(F.col(user).alias("id")).distinct(), "id", "left_semi")
    r = recommend_pruned(own, model.itemFactors, seen, n, user, item)
    return r.select(user, item, F.col("score").cast("float").alias("score"), "rank")


def als_report(model: Factors) -> DataFrame:
    """Parameters, factor table sizes and total parameter count."""
    u = model.userFactors.select(F.count(F.lit(1))).scalar()
    i = model.itemFactors.select(F.count(F.lit(1))).scalar()
    k = model.rank
    spark = model.userFactors.sparkSession
    return spark.range(1).select(F.lit(k).alias("rank"), u.alias("n_user_factors"), i.alias("n_item_factors"),
                                 ((u + i) * k).alias("total_parameters"))


def popular_unseen(ratings: DataFrame, user_groups: DataFrame, group: str,
                   n: int = 5, user: str = "user", item: str = "item") -> DataFrame:
    """The ``n`` items most popular in the user's group that the user has not seen.

    Items get their place within the group by a distributed prefix count.  A
    user who has seen k items finds the ``n`` among the first ``n + k`` places, so
    the user is joined with just these places of the group, an equi join on
    (group, place) whose size is interactions + ``n`` x users; no key pairs all
    users of a group with all its items.  The anti-join removes the seen ones,
    and nobody gets fewer than the group offers."""
    pop = cut_lineage(ratings.join(user_groups, user).where(F.col(group).isNotNull()).groupBy(group, item).agg(F.count(F.lit(1)).alias("popularity")))
    if pop.schema[item].dataType.typeName() in ("byte", "short", "integer", "long"):  # equal popularity: by item, as one number
        ranked = pop.withColumn("_ix", F.col(item))
    else:
        ranked = pop.join(index_ids(pop, item, "_ix"), item)
    ranked = ranked.withColumn("_o", (F.col("_ix").cast("decimal(20,0)") - F.col("popularity").cast("decimal(18,0)") * F.expr("CAST(10000000000000000000 AS DECIMAL(20,0))")).cast("decimal(38,0)"))
    ranked = running_totals(ranked, "_o", {"_place": F.lit(1).cast("bigint")}, [group]).select(group, "_place", item, "popularity")
    seen_by = ratings.groupBy(user).agg(F.count_distinct(item).alias("_k"))
    places = user_groups.join(seen_by, user).select(user, group, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_k") + n)).alias("_place"))
    recs = exclude_seen(places.join(ranked, [group, "_place"]), ratings, [user, item])
    return top_n_per_group(recs.select(user, group, item, "popularity"), [user], [F.desc("popularity"), F.col(item)], n)
