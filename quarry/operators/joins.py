"""Join operators.

Broadcast is never forced blindly: :func:`sized_broadcast` hints one only for a
side whose size is proven; no query is run only to learn the size of its
result.  Otherwise the join stays a shuffle join, which Spark may still turn
into a broadcast by the size it then knows.
"""
from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.vectors import dot
from quarry.session import cut_lineage

__all__ = [
    "estimated_bytes", "measured", "measured_bytes", "is_stored", "sized_broadcast", "row_width", "join_null_safe", "enrich", "enrich_roles", "exclude_seen",
    "members", "align_freq", "score_pairs", "heavy_keys", "join_heavy",
]

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _plan_bytes(plan) -> int:
    v = plan.stats().sizeInBytes()
    return int(v) if isinstance(v, int) else int(v.toString())


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` (bytes)."""
    return _plan_bytes(df._jdf.queryExecution().optimizedPlan())


def row_width(df: DataFrame) -> int | None:
    """Bytes of a row, where every column has a fixed width; else None."""
    from pyspark.sql import types as T
    if any(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType))
           for f in df.schema.fields):
        return None
    return 16 + 16 * len(df.columns)


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and their size as text plus row overhead, by one distributed aggregate."""
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields]
    r = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(t).alias(f"b{i}") for i, t in enumerate(text)]).first()
    return r["n"], r["n"] * (16 + 16 * len(text)) + sum(r[f"b{i}"] or 0 for i in range(len(text)))


def measured_bytes(df: DataFrame) -> int:
    return measured(df)[1]


_NARROW = {"LogicalRDD", "Relation", "LocalRelation", "Project", "Filter", "SubqueryAlias"}


def is_stored(df: DataFrame) -> bool:
    """Whether ``df`` only reads a checkpoint or a file, without a join, aggregate, sort or Python."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return set(re.findall(r"(?m)^[\s:+\-]*([A-Za-z]\w*)", plan)) <= _NARROW


def _input_bytes(df: DataFrame) -> int:
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(_plan_bytes(leaves.apply(i)) for i in range(leaves.size()))


def sized_broadcast(dim: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                    rows_bound: int | None = None, row_bytes: int | None = None) -> DataFrame:
    """Broadcast hint only for a side proven to be under ``max_bytes``.

    The proof is ``rows_bound``, a row count known by construction (one row per
    bucket of a fixed number of groups), with columns of fixed width or with
    ``row_bytes``; or the optimizer's estimate; or, for a side that is stored
    (a checkpoint, a file), a sum over its rows.  A side derived from inputs that
    are below the bound together is checkpointed, so that its plan runs once, and
    then measured.  For any other side nothing runs: the join carries no hint,
    and adaptive execution broadcasts it if its shuffle turns out small."""
    width = row_bytes if row_bytes is not None else row_width(dim)
    if rows_bound is not None and width is not None and rows_bound * width <= max_bytes:
        return F.broadcast(dim)
    if estimated_bytes(dim) <= max_bytes:
        return F.broadcast(dim)
    if is_stored(dim):
        return F.broadcast(dim) if measured_bytes(dim) <= max_bytes else dim
    if _input_bytes(dim) <= max_bytes:
        kept = cut_lineage(dim)
        return F.broadcast(kept) if measured_bytes(kept) <= max_bytes else kept
    return dim


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys match each other; the keys appear once."""
    names = {k: f"_rk_{i}" for i, k in enumerate(keys)}
    r = right.select(*[F.col(k).alias(names[k]) if k in names else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k, v in names.items():
        cond = cond & F.col(k).eqNullSafe(F.col(v))
    return left.join(r, cond, how).drop(*names.values())


def enrich(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str,
           cols: Mapping[str, str] | Sequence[str], how: str = "left",
           max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Dimension lookup; the key column of ``df`` is kept once.

    ``cols`` maps dimension column -> output name (or a list kept as is).
    """
    if not isinstance(cols, Mapping):
        cols = {c: c for c in cols}
    d = dim.select(F.col(dim_key).alias(left_key), *[F.col(k).alias(v) for k, v in cols.items()])
    return df.join(sized_broadcast(d, max_broadcast_bytes), left_key, how)


def enrich_roles(df: DataFrame, dim: DataFrame, dim_key: str,
                 roles: Mapping[str, Mapping[str, str]], how: str = "left",
                 max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Role-playing dimension, e.g. ``{"PULocationID": {"Borough": "PU_Borough"}}``."""
    out = df
    for left_key, cols in roles.items():
        out = enrich(out, dim, left_key, dim_key, cols, how, max_broadcast_bytes)
    return out


def exclude_seen(recs: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop recommendations the user has already interacted with."""
    return recs.join(seen.select(*keys), list(keys), "left_anti")  # anti join needs no distinct


def members(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is present in ``b`` (semi join, no fan-out)."""
    return a.join(b.select(*keys), list(keys), "left_semi")


def align_freq(a: DataFrame, b: DataFrame, key: str, a_col: str, b_col: str,
               a_name: str = "a", b_name: str = "b") -> DataFrame:
    """Full-outer alignment of two frequency tables; missing -> 0, and a null
    key matches a null key."""
    j = a.select(F.col(key).alias("_ka"), F.col(a_col).alias(a_name)).join(
        b.select(F.col(key).alias("_kb"), F.col(b_col).alias(b_name)), F.col("_ka").eqNullSafe(F.col("_kb")), "full_outer")
    return j.select(F.coalesce("_ka", "_kb").alias(key), F.coalesce(a_name, F.lit(0)).alias(a_name),
                    F.coalesce(b_name, F.lit(0)).alias(b_name))


def score_pairs(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame,
                user: str = "user", item: str = "item") -> DataFrame:
    """Dot product of factors for given (user, item) pairs (two equi-joins).

    Only the factors of items that occur are joined, by broadcast if they are
    few: a handful of items shared by all pairs is then no hot key."""
    u = user_factors.select(F.col("id").alias(user), F.col("features").alias("_uf"))
    i = item_factors.select(F.col("id").alias(item), F.col("features").alias("_if")).join(pairs.select(item).distinct(), item, "left_semi")
    return (pairs.join(u, user).join(sized_broadcast(i), item)
            .withColumn("score", dot("_uf", "_if")).drop("_uf", "_if"))


def heavy_keys(df: DataFrame, key: str, parts: int, most: int = 64) -> dict:
    """``{key: tasks}``: the keys that hold more than a ``1 / parts`` share of the rows,
    and over how many tasks their rows should go.  A mergeable top-k sketch of
    bounded size, ``most`` entries at the driver; its counts are upper bounds, so
    no such key is missed while at most ``most`` exist."""
    tracked = max(1000, 16 * parts)
    r = df.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()
    return {x["item"]: math.ceil(x["count"] * parts / r["n"]) for x in (r["top"] or []) if x["count"] * parts > r["n"]}


def join_heavy(df: DataFrame, dim: DataFrame, key: str, deal_by: Sequence[str], how: str = "left", parts: int | None = None) -> DataFrame:
    """J1-J4 with a dimension too large to broadcast and hot keys: equi join on ``key``.

    Rows of a heavy key (:func:`heavy_keys`) are dealt over several tasks by the
    hash of ``deal_by``, columns of ``df`` that tell its rows apart; the matching
    dimension rows are repeated once for each.  All other rows join plainly, in
    the same shuffle.  The hash of stored columns places a row alike when a lost
    task is run again.  Null keys match nothing and are dealt by the same hash.
    ``how``: ``left``, ``inner``, ``left_semi`` or ``left_anti`` (a join that keeps
    unmatched dimension rows would repeat them)."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"{how}: the dimension's rows are repeated")
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(df, key, parts)
    if not heavy:
        return df.join(dim, key, how)
    p = "_h"
    while any(c.startswith(p) for c in [*df.columns, *dim.columns]):
        p += "h"
    many = F.create_map(*[x for k, m in heavy.items() for x in (F.lit(k).cast(df.schema[key].dataType), F.lit(m))])
    tasks = lambda c: F.coalesce(many[c], F.lit(1))
    place = F.pmod(F.xxhash64(*deal_by), F.when(F.col(key).isNull(), F.lit(parts)).otherwise(tasks(F.col(key)))).cast("int")
    left = df.withColumn(p, place)
    right = dim.where(F.col(key).isNotNull()).withColumn(p, F.explode(F.sequence(F.lit(0), tasks(F.col(key)) - 1)))
    return left.join(right, [key, p], how).drop(p)
