"""Near-duplicate detection by b-bit MinHash, confirmed on full shingle sets.

1. One pass over the texts makes, per document, its number of distinct word
   shingles, a key of the set (copies share it), one key per band of minima
   and the low ``BITS`` bits of all minima, packed.
2. Copies are folded into classes. Classes that share a band key form a
   bucket. Each is compared with its bucket's leader, the class with the most
   company over all its buckets (of a group of near copies, the original): bit
   counts of the packed signatures give a collision-corrected similarity, and
   pairs that come near the threshold are confirmed on full shingle sets.
3. The confirmed links are closed into components. In buckets that still span
   several components, all signatures are compared in tiles of bounded size;
   components with a near pair form a cluster, and each cluster's full sets
   are compared in tiles again, so no link between different components is
   lost to the star in step 2. A tile returns a spanning forest, never all its
   pairs.

A document without words has an empty set and no link. Rows with a null doc_id
take part; a component's id is its smallest non-null doc_id (null if none).
Rows that repeat a doc_id are separate documents.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .components import Forest, components
from .staging import staged, whole_row

BANDS, ROWS, BITS = 28, 4, 4
PERMS = BANDS * ROWS
WORDS64 = PERMS * BITS // 64
TILE = 1024
#: standard errors of the estimate that a true link may fall short by
MARGIN = 5.0


def _signer(k: int):
    rng = np.random.default_rng(20)
    mul = (rng.integers(0, 1 << 32, PERMS, np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
    add = rng.integers(0, 1 << 32, PERMS, np.uint64).astype(np.uint32)[:, None]
    salt = rng.integers(0, 1 << 63, BANDS, np.uint64)

    def sign(sets: np.ndarray):
        x = (sets >> np.uint64(32)).astype(np.uint32)
        low = np.full(PERMS, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 1024):
            np.minimum(low, (mul * x[None, i:i + 1024] + add).min(axis=1), out=low)
        rows = low.reshape(BANDS, ROWS).astype(np.uint64)
        key = salt.copy()
        for j in range(ROWS):
            key = tb.mix64(key * np.uint64(tb.BASE) + rows[:, j])
        nib = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(WORDS64, 64 // BITS)
        packed = (nib << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
        return key.view(np.int64), packed.view(np.int64)

    def run(batches):
        for pdf in batches:
            for lo, hi, raw in tb.pieces(pdf["text"]):
                h, off = tb.words(raw)
                out = []
                for i in range(hi - lo):
                    s = tb.shingles(h[off[i]:off[i + 1]], k)
                    if len(s) == 0:
                        out.append((0, None, None, None))
                        continue
                    with np.errstate(over="ignore"):
                        cls = np.array([s.sum(dtype=np.uint64), tb.mix64(s ^ salt[0]).sum(dtype=np.uint64)])
                    bands, packed = sign(s)
                    out.append((len(s), cls.tobytes(), bands, packed))
                part = pd.DataFrame(out, columns=["n_shingles", "cls", "bands", "sig"])
                part.insert(0, "doc_id", pdf["doc_id"].iloc[lo:hi].to_numpy())
                part.insert(1, "tk", pdf["tk"].iloc[lo:hi].to_numpy())
                yield part
    return run


def _setter(k: int):
    def run(batches):
        for pdf in batches:
            for lo, hi, raw in tb.pieces(pdf["text"]):
                h, off = tb.words(raw)
                sets = [tb.shingles(h[off[i]:off[i + 1]], k).view(np.int64) for i in range(hi - lo)]
                yield pd.DataFrame({"tk": pdf["tk"].iloc[lo:hi].to_numpy(), "shingles": sets})
    return run


def estimate(a: str, b: str):
    """Collision-corrected similarity from two packed signatures: b-bit codes
    of different minima agree with probability 2**-BITS."""
    differ = F.lit(0)
    ones = sum(1 << (BITS * i) for i in range(64 // BITS))
    ones -= (1 << 64) if ones >> 63 else 0
    for w in range(1, WORDS64 + 1):
        x = F.element_at(a, w).bitwiseXOR(F.element_at(b, w))
        y = x
        for s in range(1, BITS):
            y = y.bitwiseOR(F.shiftrightunsigned(x, s))
        differ = differ + F.bit_count(y.bitwiseAND(F.lit(ones)))
    chance = 2.0 ** -BITS
    return ((1 - differ / F.lit(float(PERMS))) - chance) / (1 - chance)


def least_estimate(threshold: float) -> float:
    chance = 2.0 ** -BITS
    agree = chance + (1 - chance) * threshold
    return threshold - MARGIN * sqrt(agree * (1 - agree) / PERMS) / (1 - chance)


def _agree(sig: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Number of minima whose low bits agree, from packed signatures."""
    x = sig[others] ^ sig[i]
    y = x.copy()
    for s in range(1, BITS):
        y |= x >> np.uint64(s)
    ones = np.uint64(sum(1 << (BITS * k) for k in range(64 // BITS)))
    return PERMS - np.bitwise_count(y & ones).sum(axis=1).astype(np.int64)


def least_agreement(least: float) -> int:
    chance = 2.0 ** -BITS
    return int(np.ceil(PERMS * (chance + (1 - chance) * least) - 1e-9))


def _near_roots(least: float):
    """Tiles of a bucket -> spanning forest over the components in it that
    hold a pair of near signatures."""
    least = least_agreement(least)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ti, tj = pdf["ti"].iloc[0], pdf["tj"].iloc[0]
        names, root = np.unique(pdf["root"].to_numpy(), return_inverse=True)
        sig = np.stack(pdf["sig"].to_numpy()).view(np.uint64)
        tile = pdf["tile"].to_numpy()
        forest, right = Forest(len(names)), np.flatnonzero(tile == tj)
        for i in np.flatnonzero(tile == ti):
            open_ = right[forest.up[root[right]] != forest.up[root[i]]]
            j = open_[_agree(sig, i, open_) >= least]
            forest.link(np.full(len(j), root[i]), root[j])
        k = np.flatnonzero(forest.up != np.arange(len(names)))
        return pd.DataFrame({"a": names[k], "b": names[forest.up[k]]})
    return run


def _confirm_tile(least: float, percent: int):
    """Tiles of a cluster with full sets -> links that join components."""
    least = least_agreement(least)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid", ignore_index=True)
        ti, tj = pdf["ti"].iloc[0], pdf["tj"].iloc[0]
        names, root = np.unique(pdf["root"].to_numpy(), return_inverse=True)
        sig = np.stack(pdf["sig"].to_numpy()).view(np.uint64)
        sets, tile = pdf["shingles"].to_numpy(), pdf["tile"].to_numpy()
        size = np.array([len(x) for x in sets])
        forest, right, found = Forest(len(names)), np.flatnonzero(tile == tj), []
        for i in np.flatnonzero(tile == ti):
            j = right[forest.up[root[right]] != forest.up[root[i]]]
            small, large = np.minimum(size[j], size[i]), np.maximum(size[j], size[i])
            j = j[100 * small >= percent * large]
            agree = _agree(sig, i, j)
            j = j[np.argsort(-agree, kind="stable")][:int((agree >= least).sum())]
            for k in j:
                if forest.up[root[k]] == forest.up[root[i]]:
                    continue
                both = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[k] - both):
                    forest.link(root[[i]], root[[k]])
                    found.append((names[root[i]], names[root[k]]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
    return run


def _tiled(df: DataFrame, keys: list[str], tiles) -> DataFrame:
    """Rows dealt to every pair of tiles of their group that holds theirs."""
    return (df.withColumn("n", tiles.cast("int"))
            .withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("n")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .withColumn("ti", F.least("tile", "other")).withColumn("tj", F.greatest("tile", "other"))
            .drop("n", "other"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of full sets."""
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb")), "b")
            .withColumn("both", both)
            .where(F.col("both") * 100 >= percent * (F.size("sa") + F.size("sb") - F.col("both")))
            .select("a", "b"))


def near_duplicates(docs: DataFrame, percent: int = 85, k: int = 5, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and class key of every row of
    ``docs`` (doc_id, text). Links: Jaccard of k-word shingles >= percent/100.
    Bands find a pair at 0.85 with probability over 1 - 1e-8, at 0.8 over 1 - 1e-6."""
    id_type = docs.schema["doc_id"].dataType
    src = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.xxhash64("text").alias("tk"))
    rows = staged(src.mapInPandas(_signer(k), "doc_id string, tk long, n_shingles long, cls binary, "
                                  "bands array<long>, sig array<long>")
                  .withColumn("doc_id", F.col("doc_id").cast(id_type)), "minhash-rows")
    cls = staged(rows.where("cls is not null").groupBy("cls")
                 .agg(F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.max("n_shingles").alias("n_shingles"),
                      F.min("tk").alias("tk"), F.min("doc_id").alias("min_id"))
                 .withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")
    member = cls.select("cid", F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    inside = staged(member.join(shared, "band"), "minhash-buckets")
    company = inside.groupBy("cid").agg(F.sum("m").alias("company"))
    lead = (inside.join(company, "cid").groupBy("band")
            .agg(F.max(F.struct("company", (-F.col("cid")).alias("neg"))).alias("top"))
            .select("band", (-F.col("top.neg")).alias("lead")))
    star = (inside.join(lead, "band").where("cid <> lead")
            .select(F.col("cid").alias("a"), F.col("lead").alias("b")).distinct())
    sig = cls.select("cid", "sig")
    least = least_estimate(percent / 100)
    star = staged(star.join(sig.select(F.col("cid").alias("a"), F.col("sig").alias("ga")), "a")
                  .join(sig.select(F.col("cid").alias("b"), F.col("sig").alias("gb")), "b")
                  .where(estimate("ga", "gb") >= least).select("a", "b"), "minhash-star")
    texts = src.select("tk", "text")

    def sets_of(need: DataFrame) -> DataFrame:
        need = need.join(cls.select("cid", "tk"), "cid")
        one = texts.join(need.select("tk"), "tk", "left_semi").groupBy("tk").agg(F.first("text").alias("text"))
        return staged(one.mapInPandas(_setter(k), "tk long, shingles array<long>")
                      .join(need, "tk").select("cid", "shingles"), "minhash-sets")

    ends = star.select(F.col("a").alias("cid")).unionByName(star.select(F.col("b").alias("cid"))).distinct()
    links = staged(confirmed(star, sets_of(ends), percent), "minhash-links")
    comp = components(links, "a", "b").withColumnRenamed("node", "cid")
    # what the stars left open: buckets that span several components
    here = inside.join(comp, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    open_ = (here.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
             .where("r0 <> r1").select("band"))
    rest = here.where("m > 2").join(open_, "band", "left_semi").join(sig, "cid")
    near = staged(_tiled(rest, ["band"], F.ceil(F.col("m") / tile))
                  .groupBy("band", "ti", "tj").applyInPandas(_near_roots(least), "a long, b long").distinct(),
                  "minhash-near")
    if near.take(1):
        cluster = components(near, "a", "b").select(F.col("node").alias("root"), F.col("root").alias("cluster"))
        mine = staged(cls.select("cid", "sig", "n_shingles").join(comp, "cid", "left")
                      .withColumn("root", F.coalesce("root", "cid")).join(cluster, "root"), "minhash-clusters")
        many = mine.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("s"))
        full = mine.join(many, "cluster").join(sets_of(mine.select("cid")), "cid")
        late = (_tiled(full, ["cluster"], F.greatest(F.ceil(F.col("m") / tile), F.ceil(F.col("s") / (tile * 1024))))
                .select("cluster", "ti", "tj", "tile", "cid", "root", "sig", "shingles")
                .groupBy("cluster", "ti", "tj").applyInPandas(_confirm_tile(least, percent), "a long, b long"))
        comp = components(late.unionByName(comp.select(F.col("cid").alias("a"), F.col("root").alias("b"))),
                          "a", "b").withColumnRenamed("node", "cid")
    comp = staged(comp, "minhash-components")
    ids = (comp.join(cls.select("cid", "min_id"), "cid").groupBy("root").agg(F.min("min_id").alias("component_id")))
    final = (cls.select("cls", "cid", "min_id").join(comp, "cid", "left").join(ids, "root", "left")
             .select("cls", F.coalesce("component_id", "min_id").alias("component_id"),
                     F.coalesce("root", "cid").alias("group_key")))
    out = rows.select("doc_id", "tk", "n_shingles", "cls").join(final, "cls", "left")
    cid = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "tk", "n_shingles", cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, cid.isNull()).alias("kept"), "group_key")


def one_per_group(docs: DataFrame, percent: int = 85, k: int = 5) -> DataFrame:
    """``docs`` with one row of each group (the one with its smallest doc_id;
    of rows that repeat it, the one with the smallest text hash). Documents
    without words have no group and all stay."""
    d = near_duplicates(docs, percent, k)
    pick = (d.where("group_key is not null").groupBy("group_key")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "tk")).alias("p"))
            .select(F.col("p.doc_id").alias("_id"), F.col("p.tk").alias("_tk"))
            .unionByName(d.where("group_key is null").select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk"))
                         .distinct()))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^\\x20\\x09-\\x0D]")) > 0
    kept = docs.select(whole_row(docs).alias("row"), "doc_id", F.xxhash64("text").alias("tk"), words.alias("words")).join(
        pick, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tk") == F.col("_tk")), "left_semi")
    return kept.where("words").dropDuplicates(["doc_id", "tk"]).unionByName(kept.where("not words")).select("row.*")
