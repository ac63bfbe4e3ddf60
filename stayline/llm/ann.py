"""Approximate nearest neighbours: one hierarchical navigable small-world
graph per shard, searched shard by shard, results merged.

Distinct vectors are dealt by a hash to shards of about ``shard_rows``. Every
shard builds a graph: nodes come in a random order in batches that double, a
node is linked to near earlier ones that are nearer to it than to each other,
and links are mutual up to a fixed degree. A node reaches layer l with
probability ``DEGREE`` ** -l. A layer is one flat array of neighbour numbers
with a fixed row length (-1: none), so an index row is a few plain arrays.
The index moves once; queries go to every shard and are read as a stream, in
blocks: greedy descent through the layers, then a beam of ``beam`` nodes on the
lowest, all queries of a block in lockstep. The shards' best are merged and
ranked by exact double-precision distance.

Copies of a vector are one node; the merge gives each its smallest ids back.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components neither search nor are found; vectors of another length than the
query are not compared; a null vec_id is no query and no result; fewer
candidates than k give fewer rows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged
from .vectors import fold_copies

SHARD_ROWS = 4096
BLOCK = 512
DEGREE = 16
BEAM = 100
CANDIDATES = 32


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0, out=d)


def spread(v: np.ndarray, near: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of each node's candidates, nearest first (``near``, -1: none, at
    ``dist``), those nearer to it than to any kept before; at most ``most``.
    Returns a mask."""
    n, c = near.shape
    keep = np.zeros((n, c), bool)
    x = v[near]
    norm = (x * x).sum(axis=2)
    for r in range(c):
        to = norm + norm[:, r, None] - 2.0 * np.einsum("ncd,nd->nc", x, x[:, r])
        blocked = ((to < dist[:, r, None]) & keep).any(axis=1)
        keep[:, r] = ~blocked & (near[:, r] >= 0) & (keep.sum(axis=1) < most)
    return keep


def layer(v: np.ndarray, degree: int) -> np.ndarray:
    """Flat neighbour array [nodes, 2 * degree] over the rows of v, which are
    in insertion order."""
    n, width = len(v), 2 * degree
    links = np.full((n, width), -1, np.int32)
    lo = 0
    while lo < n:
        hi = min(n, max(2 * lo, width + 1))
        d = square_distances(v[lo:hi], v[:hi])
        d[np.arange(hi - lo), np.arange(lo, hi)] = np.inf
        c = min(CANDIDATES, hi - 1)
        if c <= 0:
            break
        near = np.argpartition(d, c - 1, axis=1)[:, :c]
        dist = np.take_along_axis(d, near, 1)
        order = np.argsort(dist, axis=1, kind="stable")
        near, dist = np.take_along_axis(near, order, 1), np.take_along_axis(dist, order, 1)
        i, r = np.nonzero(spread(v, near, dist, degree))
        a, b, w = i + lo, near[i, r], dist[i, r]
        # with the links there are, mutual, nearest first, up to the width
        oi, orow = np.nonzero(links[:hi] >= 0)
        oj = links[oi, orow]
        ow = ((v[oi] - v[oj]) ** 2).sum(axis=1)
        src, dst, w = np.concatenate((a, b, oi)), np.concatenate((b, a, oj)), np.concatenate((w, w, ow))
        order = np.lexsort((dst, w, src))
        src, dst = src[order], dst[order]
        pair = src.astype(np.int64) * n + dst
        _, first = np.unique(pair, return_index=True)
        first.sort()
        src, dst = src[first], dst[first]
        rank = np.arange(len(src)) - np.searchsorted(src, src)
        ok = rank < width
        links[:hi] = -1
        links[src[ok], rank[ok]] = dst[ok]
        lo = hi
    return links


def build(v: np.ndarray, seed: int, degree: int = DEGREE):
    """(insertion order, nodes per layer, flat neighbours of all layers);
    layer l is over the first nodes[l] nodes of the order."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(v))
    nodes, flat, n = [], [], len(v)
    while n > 0:
        nodes.append(n)
        flat.append(layer(v[order[:n]], degree).ravel())
        if n <= 2 * degree:
            break
        n = ceil(n / degree)
    return order, nodes, np.concatenate(flat) if flat else np.zeros(0, np.int32)


def beam_search(v, links, queries, entries, beam):
    """Lockstep beam search on one layer: (node ids, square distances), best
    first, -1 where fewer were reached."""
    q, n = len(queries), len(v)
    vv, qq = (v * v).sum(axis=1), (queries * queries).sum(axis=1)
    seen = np.zeros((q, n), bool)
    ids = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf)
    open_ = np.zeros((q, beam), bool)

    def push(rows, cand):
        """Merge candidate nodes (-1: none) into the beams of ``rows``."""
        ok = cand >= 0
        safe = np.where(ok, cand, 0)
        ok &= ~seen[rows[:, None], safe]
        seen[rows[:, None], safe] |= ok
        d = vv[safe] + qq[rows, None] - 2.0 * np.einsum("qcd,qd->qc", v[safe], queries[rows])
        d = np.where(ok, d, np.inf)
        all_d = np.concatenate((dist[rows], d), axis=1)
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        dist[rows] = np.take_along_axis(all_d, best, 1)
        ids[rows] = np.take_along_axis(np.concatenate((ids[rows], np.where(ok, cand, -1)), axis=1), best, 1)
        open_[rows] = np.take_along_axis(np.concatenate((open_[rows], ok), axis=1), best, 1)

    push(np.arange(q), entries)
    while True:
        todo = np.where(open_, dist, np.inf)
        pick = todo.argmin(axis=1)
        rows = np.flatnonzero(np.isfinite(todo[np.arange(q), pick]))
        if len(rows) == 0:
            break
        at = ids[rows, pick[rows]]
        open_[rows, pick[rows]] = False
        push(rows, links[at].astype(np.int64))
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    return np.where(np.isfinite(dist), ids, -1), dist


def search(v, nodes, flat, degree, queries, beam: int = BEAM):
    """Beam of the lowest layer for each query, entered from above. v is in
    insertion order."""
    width, ends = 2 * degree, np.concatenate(([0], np.cumsum(np.array(nodes) * 2 * degree)))
    entries = np.zeros((len(queries), 1), np.int64)
    for l in reversed(range(len(nodes))):
        links = flat[ends[l]:ends[l + 1]].reshape(nodes[l], width)
        entries, dist = beam_search(v[:nodes[l]], links, queries, entries, beam if l == 0 else max(4, beam // 8))
    return entries, dist


def _build(degree: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid")
        v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        shard = int(pdf["shard"].iloc[0])
        order, nodes, flat = build(v, shard, degree)
        return pd.DataFrame({"dim": [v.shape[1]], "shard": [shard], "cid": [pdf["cid"].to_numpy()[order]],
                             "v": [v[order].ravel()], "nodes": [nodes], "links": [flat]})
    return run


def _search(k: int, degree: int, beam: int, block: int):
    def answer(x, part: pd.DataFrame) -> pd.DataFrame:
        cid, v, nodes, flat = x
        q = np.stack(part["v"].to_numpy()).astype(np.float64)
        found, _ = search(v, nodes, flat, degree, q, max(beam, k))
        i, r = np.nonzero(found >= 0)
        at = found[i, r]
        # exact distances on the original vectors
        d = np.sqrt(((v[at] - q[i]) ** 2).sum(axis=1))
        out = pd.DataFrame({"query_id": part["query_id"].to_numpy()[i], "cid": cid[at], "score": d})
        out = out.sort_values(["query_id", "score"], kind="stable")
        # ties with the last place stay: the merge ranks them by id
        last = out.groupby("query_id")["score"].transform(lambda s: s.iloc[min(k, len(s)) - 1])
        return out[out["score"] <= last]

    def run(batches):
        x = None
        for pdf in batches:
            # an index row comes before the queries of its shard
            starts = np.flatnonzero(~pdf["is_query"].to_numpy().astype(bool)).tolist()
            for lo, hi in zip([0, *starts], [*starts, len(pdf)]):
                if lo in starts and hi > lo:
                    r = pdf.iloc[lo]
                    x = (np.asarray(r["cid"]), np.asarray(r["v"], np.float64).reshape(-1, int(r["dim"])),
                         list(r["nodes"]), np.asarray(r["links"]))
                    lo += 1
                for at in range(lo, hi, block):
                    yield answer(x, pdf.iloc[at:min(at + block, hi)])
    return run


def build_index(classes: DataFrame, shard_rows: int = SHARD_ROWS, degree: int = DEGREE) -> DataFrame:
    """One row per shard: dim, shard, cid, v, nodes, links (flat arrays)."""
    # one row per vector length
    shards = classes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = (classes.join(F.broadcast(shards), "dim")
             .withColumn("shard", F.pmod(F.xxhash64("cid"), F.col("shards")).cast("int")))
    return staged(dealt.select("dim", "shard", "cid", "v").groupBy("dim", "shard").applyInPandas(
        _build(degree), "dim int, shard int, cid array<long>, v array<double>, nodes array<int>, links array<int>"),
        "ann-index")


def nearest(table: DataFrame, is_query, k: int = 10, shard_rows: int = SHARD_ROWS, degree: int = DEGREE,
            beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest
    found for every row where ``is_query`` holds."""
    classes, rows = fold_copies(table)
    rows = rows.where("vec_id is not null")
    index = build_index(classes, shard_rows, degree)
    shards = index.select(F.col("dim").alias("q_dim"), F.col("shard").alias("q_shard"))
    queries = (rows.where(is_query).select(F.col("vec_id").alias("query_id"), "cid").distinct()
               .join(classes.select("cid", "dim", "v"), "cid"))
    # two rows of one vec_id and different vectors are two searches merged
    asked = (queries.select("query_id", F.col("dim").alias("d"), "v").join(shards, F.col("d") == F.col("q_dim"))
             .select(F.col("q_dim").alias("dim"), F.col("q_shard").alias("shard"), F.lit(True).alias("is_query"),
                     F.col("query_id").cast("long").alias("query_id"), F.col("v").cast("array<double>").alias("v"),
                     *[F.lit(None).cast(index.schema[c].dataType).alias(c) for c in ("cid", "nodes", "links")]))
    # the index moves once, its row before the queries of its shard
    kept = index.select("dim", "shard", F.lit(False).alias("is_query"), F.lit(0).cast("long").alias("query_id"),
                        "v", "cid", "nodes", "links")
    found = (kept.unionByName(asked).repartition(max(1, index.count()), "dim", "shard")
             .sortWithinPartitions("dim", "shard", "is_query")
             .mapInPandas(_search(k + 1, degree, beam, BLOCK), "query_id long, cid long, score double"))
    # k + 1 ids of a class are enough: one may be the query itself
    by_id = Window.partitionBy("cid").orderBy("vec_id")
    ids = rows.withColumn("i", F.row_number().over(by_id)).where(F.col("i") <= k + 1).select("cid", "vec_id")
    hits = (found.join(ids, "cid").where("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
