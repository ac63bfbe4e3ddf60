"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to length 1 and rotated to the principal axes, so that the
leading dimensions carry the most. They are cut into cells along the first
axis and into tiles of at most about ``tile`` rows inside a cell; two tiles
are compared only if their cells are near enough for a link. Inside a pair of
tiles, products of the leading dimensions are summed first; the rest is at
most the product of the two suffix norms, and a pair is dropped as soon as its
cosine cannot reach the threshold. What survives is decided on the original
vectors in double precision.

A pair of tiles returns, per vector, its number of links and a local root, so
a group of near copies gives rows in proportion to its size, never its pairs.
Exact copies are folded first.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths do not link. A null
vec_id takes part but names no component (its component_id is the smallest id
reached, null if none). An empty table gives an empty result.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import Forest, components
from .staging import staged
from .vectors import fold_copies, usable

TILE = 4096
ROWS = 512
STEPS = (8, 16, 32)
EPS = 1e-9


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _moments(batches):
    """Second moments of unit vectors, one row per task and dimension."""
    sums: dict[int, np.ndarray] = {}
    for pdf in batches:
        for dim, part in pdf.groupby("dim"):
            u = unit(np.stack(part["v"].to_numpy()).astype(np.float64))
            sums[dim] = sums.get(dim, 0.0) + u.T @ u
    for dim, m in sums.items():
        yield pd.DataFrame({"dim": [dim], "m": [m.ravel()]})


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length: axes as columns, largest first. dim * dim sums."""
    got = (classes.select("dim", "v").mapInPandas(_moments, "dim int, m array<double>")
           .select("dim", F.posexplode("m").alias("i", "x")).groupBy("dim", "i").agg(F.sum("x").alias("x")).toPandas())
    out = {}
    for dim, part in got.groupby("dim"):
        m = np.zeros(dim * dim)
        m[part["i"].to_numpy()] = part["x"].to_numpy()
        out[int(dim)] = np.linalg.eigh(m.reshape(dim, dim))[1][:, ::-1].copy()
    return out


def tile_links(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool):
    """Pairs (i, j) of rows of x and y (i < j if ``same``) with cosine >=
    threshold, in blocks. Yields index arrays."""
    ux, uy = unit(x), unit(y)
    px, py = ux @ axes, uy @ axes
    dim = x.shape[1]
    steps = [s for s in STEPS if s < dim] + [dim]
    sx = {s: np.sqrt(np.maximum((px[:, s:] ** 2).sum(axis=1), 0)) for s in steps}
    sy = {s: np.sqrt(np.maximum((py[:, s:] ** 2).sum(axis=1), 0)) for s in steps}
    k = steps[0] if len(steps) == 1 else steps[1] if len(steps) > 2 else steps[0]
    later = [s for s in steps if s > k]
    for lo in range(0, len(x), ROWS):
        hi = min(lo + ROWS, len(x))
        part = px[lo:hi, :k] @ py[:, :k].T
        near = part + sx[k][lo:hi, None] * sy[k][None, :] >= threshold - EPS
        if same:
            near &= np.arange(lo, hi)[:, None] < np.arange(len(y))[None, :]
        i, j = np.nonzero(near)
        dot = part[i, j]
        i = i + lo
        done = k
        for s in later:
            if len(i) == 0:
                break
            dot = dot + np.einsum("ij,ij->i", px[i, done:s], py[j, done:s])
            ok = dot + sx[s][i] * sy[s][j] >= threshold - EPS
            i, j, dot, done = i[ok], j[ok], dot[ok], s
        if len(i):
            ok = np.einsum("ij,ij->i", ux[i], uy[j]) >= threshold
            yield i[ok], j[ok]


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        dim, ta, tb = key
        pdf = pdf.sort_values("cid")
        a = pdf[pdf["tile"] == ta]
        b = pdf[pdf["tile"] == tb] if tb != ta else a
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")
        x = np.stack(a["v"].to_numpy()).astype(np.float64)
        y = x if tb == ta else np.stack(b["v"].to_numpy()).astype(np.float64)
        wa, wb = a["copies"].to_numpy(), b["copies"].to_numpy()
        shift = 0 if tb == ta else len(a)
        cid = a["cid"].to_numpy() if tb == ta else np.concatenate((a["cid"].to_numpy(), b["cid"].to_numpy()))
        links, forest = np.zeros(len(cid), np.int64), Forest(len(cid))
        for i, j in tile_links(x, y, axes[dim], threshold, tb == ta):
            links += np.bincount(i, weights=wb[j], minlength=len(cid)).astype(np.int64)
            links += np.bincount(j + shift, weights=wa[i], minlength=len(cid)).astype(np.int64)
            forest.link(i, j + shift)
        hit = np.flatnonzero(links)
        return pd.DataFrame({"cid": cid[hit], "links": links[hit], "root": cid[forest.up[hit]]})
    return run


def linked(classes: DataFrame, threshold: float = 0.9, tile: int = TILE) -> DataFrame:
    """(cid, links to rows of other classes, root) rows, several per class."""
    axes = principal_axes(classes)
    width = sqrt(2 - 2 * threshold) * 1.001 + 1e-6 if threshold < 1 else 1e-3
    first = {d: a[:, 0].tolist() for d, a in axes.items()}

    def cells(batches):
        for pdf in batches:
            out = [int(np.floor(unit(np.asarray(v, np.float64)[None, :])[0] @ first[d] / width))
                   for d, v in zip(pdf["dim"], pdf["v"])]
            yield pdf.assign(cell=out)
    c = staged(classes.select("cid", "dim", "v", "copies").mapInPandas(
        cells, f"cid long, dim int, v {classes.schema['v'].dataType.simpleString()}, copies long, cell int"),
        "vector-cells")
    # at most 2 / width + 2 cells per vector length
    sizes = {(r["dim"], r["cell"]): r["n"] for r in c.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return c.select("cid", F.col("copies").alias("links"), F.col("cid").alias("root"))
    plan, at = [], 0
    for (dim, cell), n in sorted(sizes.items()):
        k = ceil(n / tile)
        plan.append((dim, cell, at, k))
        at += k
    near = {(d, cell): [(f, k) for d2, c2, f, k in plan if d2 == d and abs(c2 - cell) <= 1] for d, cell, _, _ in plan}
    rows = [(d, cell, f, k, min(x for x, _ in near[d, cell]), max(x + y for x, y in near[d, cell]) - 1)
            for d, cell, f, k in plan]
    cellplan = classes.sparkSession.createDataFrame(rows, "dim int, cell int, first int, k int, lo int, hi int")
    t = (c.join(F.broadcast(cellplan), ["dim", "cell"])  # a row per cell
         .withColumn("tile", F.col("first") + F.pmod(F.xxhash64("cid"), F.col("k")).cast("int"))
         .withColumn("other", F.explode(F.sequence("lo", "hi")))
         .select("dim", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"),
                 "cid", "v", "copies", "tile"))
    return t.groupBy("dim", "ta", "tb").applyInPandas(_compare(axes, threshold), "cid long, links long, root long")


def near_duplicates(table: DataFrame, threshold: float = 0.9, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    classes, rows = fold_copies(table)
    found = staged(linked(classes, threshold, tile), "vector-links")
    comp = components(found, "cid", "root")
    n = found.groupBy("cid").agg(F.sum("links").alias("links"))
    ids = (comp.join(classes.select(F.col("cid").alias("node"), "min_id"), "node")
           .groupBy("root").agg(F.min("min_id").alias("low")))
    per = (classes.select("cid", "copies", "min_id").join(n, "cid", "left")
           .join(comp.withColumnRenamed("node", "cid"), "cid", "left").join(ids, "root", "left")
           .select("cid", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
                   F.coalesce("low", "min_id").alias("component_id")))
    good = rows.join(per, "cid").select("vec_id", "n_links", "component_id")
    bad = table.where(~usable(F.col("embedding"))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
