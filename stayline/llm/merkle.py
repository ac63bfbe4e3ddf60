"""Merkle manifest of a dataset: one tree per source, one tree over the sources,
and for every row an inclusion proof expanded from an octopus multiproof.

H is lowercase hex sha256 of its inputs laid end to end, digests as hex text.
Leaves of a source ascend by their order column; while a tree has several
nodes, every ``FANOUT`` consecutive ones (the last run may be shorter, even
one) become their H. The source roots, in source order (null first, then by
UTF-8 bytes), are the leaves of the top tree. A tree of one leaf is that leaf.

1. Leaf digests are computed where the rows lie; only digests move after that.
2. Leaves are range-sorted by (source, order); a position is a row's place in
   its range plus the counts of the ranges before it, so a source that holds a
   third of all rows lies in as many ranges as it has parts.
3. Inner nodes: runs of whole subtrees (``TIER`` levels) are grouped in place
   after one shuffle of the nodes, each tier having 1 / FANOUT ** TIER of the
   nodes of the one before.
4. Octopus. A leaf partition is ``block`` consecutive leaves of a range, of one
   or many sources. From the first and last position per source it tells the
   minimal union of coordinates its proofs need and its own leaves do not give
   (mates of its two edges, level by level, through source and top tree). They
   are fetched by one join, the shared interiors are derived once, and the
   proof of each leaf is read off. The derived roots must equal the fetched
   ones, else the job fails.

Null fields are written ``-``, others as byte count, ``:``, value, so no two
rows share an encoding. Rows with equal order value are ordered by their
digest, null order values first; repeated rows are leaves of their own. An
empty table has no leaves and gives no rows. Columns outside ``fields`` are
not read; ``keep`` names those returned with the proof, as one struct.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged

FANOUT = 16
TIER = 3
BLOCK = 4096
RANGE_ROWS = 200_000
TOP = "top"  # source trees are named "" (null) or "=" and the source
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(c) for c in fields]), 256)


def tree_name(source: Column) -> Column:
    """Names that sort as the sources do, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def numbered(leaves: DataFrame, range_rows: int = RANGE_ROWS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(leaves with pos in their tree, n leaves of the tree, block and edge;
    one row per tree: tree, n).

    leaves: tree, ord, digest and more. ``edge``: fewer than FANOUT leaves away
    from a border of its block, so that another block may ask for it."""
    total = leaves.count()
    parts = max(1, -(-total // range_rows))
    at = F.monotonically_increasing_id()  # range number in the high bits, place in the range in the low 33
    d = staged(leaves.repartitionByRange(parts, "tree", "ord", "digest").sortWithinPartitions("tree", "ord", "digest")
               .withColumn("at", at), "merkle-leaves")
    d = d.withColumn("part", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND((1 << 33) - 1))
    runs = d.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"),
                                         F.max("place").alias("last"))
    by_part = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = staged(runs.select("tree", "part", "first", F.coalesce(F.sum("rows").over(by_part), F.lit(0)).alias("before"),
                              F.sum("rows").over(Window.partitionBy("tree")).alias("n"),
                              (F.max("last").over(Window.partitionBy("part")) + 1).alias("range_size")), "merkle-runs")
    in_block = F.col("place") % block
    edge = ((in_block < FANOUT) | (in_block >= block - FANOUT) | (F.col("place") >= F.col("range_size") - FANOUT))
    d = d.join(runs, ["tree", "part"]).select(
        *leaves.columns, "n", (F.col("place") - F.col("first") + F.col("before")).alias("pos"),
        F.concat_ws("-", "part", F.floor(F.col("place") / block)).alias("block"), edge.alias("edge"))
    return d, runs.groupBy("tree").agg(F.max("n").alias("n"))


def height(n: Column, most: int = 16) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    out = F.lit(0)
    for k in range(most):
        out = out + F.when(n > FANOUT ** k, 1).otherwise(0)
    return out


def inner_nodes(leaves: DataFrame, levels: int) -> DataFrame:
    """All nodes above the leaves, and the roots of trees of one leaf: (tree,
    level, idx, digest). ``levels``: height of the tallest tree."""
    node = leaves.select("tree", height(F.col("n")).alias("top"), F.col("pos").alias("idx"), "digest")
    out = [node.where("top = 0").select("tree", F.lit(0).alias("level"), "idx", "digest")]
    for low in range(0, levels, TIER):
        chunk = F.floor(F.col("idx") / FANOUT ** TIER)
        x = node.withColumn("chunk", chunk).repartition("tree", "chunk")
        tier = None
        for level in range(low + 1, min(low + TIER, levels) + 1):
            x = x.where(F.col("top") >= level).groupBy("tree", "top", "chunk", F.floor(F.col("idx") / FANOUT).alias("up"))
            x = x.agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("run"))
            x = x.select("tree", "top", "chunk", F.col("up").alias("idx"),
                         F.sha2(F.array_join("run.digest", ""), 256).alias("digest"))
            one = x.select("tree", "top", F.lit(level).alias("level"), "idx", "digest")
            tier = one if tier is None else tier.unionByName(one)
        tier = staged(tier, "merkle-nodes")
        out.append(tier.drop("top"))
        node = tier.where(F.col("level") == low + TIER).select("tree", "top", "idx", "digest")
    nodes = out[0]
    for more in out[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def missing(low: int, high: int, n: int):
    """Coordinates (level, idx) that proofs of the leaves low..high of n need
    beside those leaves, and the root's."""
    level = 0
    while n > 1:
        left, right = low // FANOUT * FANOUT, min(high // FANOUT * FANOUT + FANOUT, n)
        yield from ((level, i) for i in range(left, low))
        yield from ((level, i) for i in range(high + 1, right))
        low, high, n, level = low // FANOUT, high // FANOUT, -(-n // FANOUT), level + 1
    yield level, 0


def derive(nodes: dict, low: int, high: int, n: int) -> list[dict]:
    """Per level the digests by idx: those given (by (level, idx)) and those
    that follow from them, up to the root."""
    levels, level = [], 0
    while True:
        left, right = low // FANOUT * FANOUT, min(high // FANOUT * FANOUT + FANOUT, n)
        row = {i: nodes[level, i] for i in (range(left, right) if n > 1 else (0,))}
        levels.append(row)
        if n <= 1:
            return levels
        for up in range(low // FANOUT, high // FANOUT + 1):
            run = (row[i] for i in range(up * FANOUT, min(up * FANOUT + FANOUT, n)))
            digest = sha256("".join(run).encode()).hexdigest()
            if nodes.setdefault((level + 1, up), digest) != digest:
                raise ValueError(f"node {level + 1}, {up} of the manifest is not the digest of its run")
        low, high, n, level = low // FANOUT, high // FANOUT, -(-n // FANOUT), level + 1


def paths(levels: list[dict], low: int, high: int, tail=((), ())) -> list[tuple]:
    """(left siblings, right siblings) of each leaf low..high, one string per
    level, followed by those of ``tail``."""
    above = {0: tail}
    for level in range(len(levels) - 2, -1, -1):
        row, here = levels[level], {}
        a, b = low // FANOUT ** level, high // FANOUT ** level
        for i in range(a, b + 1):
            up = i // FANOUT
            run = [row[j] for j in range(up * FANOUT, up * FANOUT + FANOUT) if j in row]
            k = i - up * FANOUT
            here[i] = (("".join(run[:k]), *above[up][0]), ("".join(run[k + 1:]), *above[up][1]))
        above = here
    return [above[i] for i in range(low, high + 1)] if len(levels) > 1 else [tail]


def _wanted(batches):
    """(block, tree, lowest and highest leaf, n) -> coordinates to fetch."""
    for pdf in batches:
        rows = [(b, t, level, i) for b, t, low, high, n in pdf.itertuples(index=False)
                for level, i in missing(low, high, n)]
        yield pd.DataFrame(rows, columns=["block", "tree", "level", "idx"])


def _expand(leaves: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
    """Proofs of one leaf partition."""
    known: dict = {}
    for r in fetched.itertuples(index=False):
        known.setdefault(r.tree, {})[r.level, r.idx] = r.digest
    leaves = leaves.sort_values(["rank", "pos"], kind="stable").reset_index(drop=True)
    groups = list(leaves.groupby("rank", sort=True))
    ranks, top = [], known.setdefault(TOP, {})
    for rank, g in groups:
        low, high, n = int(g["pos"].iloc[0]), int(g["pos"].iloc[-1]), int(g["n"].iloc[0])
        given = known.get(g["tree"].iloc[0], {})
        for i, digest in zip(g["pos"], g["digest"]):
            given[0, int(i)] = digest
        levels = derive(given, low, high, n)
        if top.setdefault((0, int(rank)), levels[-1][0]) != levels[-1][0]:
            raise ValueError("a source root of the manifest differs from its leaves")
        ranks.append((int(rank), g, levels, low, high))
    first, last, trees = ranks[0][0], ranks[-1][0], int(leaves["trees"].iloc[0])
    top_levels = derive(top, first, last, trees)
    tails = paths(top_levels, first, last)
    left, right, subroot = [], [], []
    for rank, g, levels, low, high in ranks:
        for a, b in paths(levels, low, high, tails[rank - first]):
            left.append(a)
            right.append(b)
        subroot += [levels[-1][0]] * len(g)
    return pd.DataFrame({"keep": leaves["keep"], "digest": leaves["digest"], "left": left, "right": right,
                         "subroot": subroot, "root": top_levels[-1][0]})


def multiproofs(rows: DataFrame, block: int = BLOCK, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows``: tree (see :func:`tree_name`), ord, digest, keep (a string).
    Per row: keep, digest, left and right (arrays of sibling digests, one
    string per level from the leaf to the root), subroot, root."""
    rows = staged(rows.select("tree", "ord", "digest", "keep"), "merkle-rows")
    leaves, trees = numbered(rows, range_rows, block)
    trees, _ = numbered(trees.select(F.lit(TOP).alias("tree"), F.col("tree").alias("ord"), F.lit("").alias("digest"),
                                     F.col("n").alias("size")), range_rows)
    trees = trees.select(F.col("ord").alias("tree"), F.col("size"), F.col("pos").alias("rank"), F.col("n").alias("trees"))
    levels, top_levels = trees.agg(F.max(height(F.col("size"))), F.max(height(F.col("trees")))).first()
    nodes = inner_nodes(leaves, levels or 0)
    roots = nodes.join(trees, "tree").where(F.col("level") == height(F.col("size")))
    roots = roots.select(F.lit(TOP).alias("tree"), F.col("trees").alias("n"), F.col("rank").alias("pos"), "digest")
    top = roots.select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest").where("n > 1")
    nodes = (nodes.unionByName(top).unionByName(inner_nodes(roots, top_levels or 0))
             .unionByName(leaves.where("edge and n > 1").select("tree", F.lit(0).alias("level"), F.col("pos").alias("idx"), "digest")))
    # what each leaf partition lacks: in its sources, and in the top tree
    spans = leaves.groupBy("block", "tree").agg(F.min("pos").alias("low"), F.max("pos").alias("high"), F.max("n").alias("n"))
    ranks = spans.join(trees, "tree").groupBy("block").agg(F.min("rank").alias("low"), F.max("rank").alias("high"),
                                                           F.max("trees").alias("n"))
    spans = spans.unionByName(ranks.withColumn("tree", F.lit(TOP)))
    wanted = spans.mapInPandas(_wanted, "block string, tree string, level int, idx long")
    fetched = wanted.join(nodes.withColumn("level", F.col("level").cast("int")), ["tree", "level", "idx"])
    mine = leaves.join(trees, "tree").select("block", "tree", "rank", "trees", "pos", "n", "digest", "keep")
    return mine.groupBy("block").cogroup(fetched.groupBy("block")).applyInPandas(
        _expand, "keep string, digest string, left array<string>, right array<string>, subroot string, root string")


def folded(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(F.arrays_zip(left.alias("l"), right.alias("r")), leaf,
                       lambda acc, x: F.sha2(F.concat(x["l"], acc, x["r"]), 256))


def siblings(left: Column, right: Column) -> Column:
    """All sibling digests, left to right, level by level."""
    return F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), "")


def manifest(docs: DataFrame, fields=FIELDS, source: str = "source", order: str = "doc_id",
             changed: dict | None = None, block: int = BLOCK, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per row of ``docs``: the order column, leaf, other (leaf digest with the
    columns of ``changed`` in place of the row's own: {name: Column}; the leaf
    itself without), left, right, subroot and root."""
    changed = changed or {}
    leaf = leaf_digest([F.col(c) for c in fields])
    other = leaf_digest([changed.get(c, F.col(c)) for c in fields]) if changed else leaf
    rows = docs.select(tree_name(F.col(source)).alias("tree"), F.col(order).alias("ord"), leaf.alias("digest"),
                       F.to_json(F.struct(F.col(order).cast("string").alias("o"), other.alias("d"))).alias("keep"))
    p = multiproofs(rows, block, range_rows)
    kept = F.from_json("keep", "o string, d string")
    return p.select(kept["o"].cast(docs.schema[order].dataType).alias(order), F.col("digest").alias("leaf"),
                    kept["d"].alias("other"), "left", "right", "subroot", "root")


def verified(docs: DataFrame, tampered: Column, changed: dict, **kw) -> DataFrame:
    """The manifest's digests and a check of every proof: rows where
    ``tampered`` (over the order column) holds are folded from the changed
    leaf, all others from their own."""
    m = manifest(docs, changed=changed, **kw)
    m = m.select("*", folded(F.when(tampered, F.col("other")).otherwise(F.col("leaf")), F.col("left"), F.col("right"))
                 .alias("folded_root"))
    order = m.columns[0]
    return m.select(order, "leaf", "subroot", "root", F.sha2(siblings(F.col("left"), F.col("right")), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
