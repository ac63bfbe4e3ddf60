"""Best-fit packing into bins of several permitted lengths.

Documents are cut into pieces of at most the largest length. Pieces, largest
first, go into the open bin they fit best; if none has room, the bin length of
least cost per word it is expected to hold is opened (``open_cost`` words for
every bin, plus its length, over the words of the pieces still to come that
would fill it). At the end every bin shrinks to the smallest permitted length
that holds its contents.

Scale: documents are dealt by a hash to shards of about ``shard_rows`` rows;
each shard is packed by itself, and loses at most its last bins to others. The
shard of a row depends on its text as well, so rows that repeat a doc_id (a
mix repeats documents) spread, and a serial number splits equal rows.

Defined results: sizes are word counts; a null or empty text takes no bin and
gives one row with null bin and length 0. Rows that repeat a doc_id are packed
as separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mixing import word_count
from .staging import staged

LENGTHS = (512, 1024, 2048, 4096, 8192)
OPEN_COST = 16
SHARD_ROWS = 20_000


def opening_length(piece: int, rest: int, lengths, open_cost: int) -> int:
    """The permitted length of least cost per word for a bin that starts with
    ``piece`` while ``rest`` more words wait."""
    fit = [n for n in lengths if n >= piece]
    return min(fit, key=lambda n: ((n + open_cost) / min(n, piece + rest), -n))


def pack(sizes: list[int], lengths=LENGTHS, open_cost: int = OPEN_COST):
    """Best-fit of ``sizes`` (sorted, largest first, none above the largest
    length): (bin number per piece, offset per piece, length per bin)."""
    lengths = sorted(lengths)
    room: list[tuple[int, int]] = []  # (free words, -bin), sorted
    used, size_of = [], []
    place, offset = [], []
    rest = sum(sizes)
    for s in sizes:
        rest -= s
        # the tightest open bin that holds the piece; the oldest among equals
        k = bisect_left(room, (s, -len(used)))
        if k < len(room):
            free = room[k][0]
            k = bisect_left(room, (free + 1, -len(used))) - 1
            free, b = room.pop(k)
            b = -b
        else:
            b = len(used)
            n = opening_length(s, rest, lengths, open_cost)
            used.append(0)
            size_of.append(n)
            free = n
        place.append(b)
        offset.append(used[b])
        used[b] += s
        if free > s:
            insort(room, (free - s, -b))
    return place, offset, [next(n for n in lengths if n >= u) for u in used]


def _shard(lengths, open_cost):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "tk", "serial", "piece"],
                              ascending=[False, True, True, True, True], na_position="last").reset_index(drop=True)
        place, offset, length = pack(pdf["size"].tolist(), lengths, open_cost)
        pdf["bin"] = place
        pdf["bin_offset"] = offset
        pdf["bin_length"] = [length[b] for b in place]
        return pdf[["shard", "bin", "bin_offset", "bin_length", "doc_id", "tk", "serial", "piece", "start", "size"]]
    return run


def packed(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, open_cost: int = OPEN_COST,
           shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: doc_id, n_words (of its document), piece (from 0),
    start (its first word in the document), size, bin ("shard-number"),
    bin_offset and bin_length."""
    id_type, top = docs.schema["doc_id"].dataType, max(lengths)
    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("tk"),
                    word_count(F.col("text")).alias("n_words"))
    # equal rows differ in nothing; a serial number tells them apart
    d = staged(d.groupBy("doc_id", "tk", "n_words").agg(F.count(F.lit(1)).alias("times"))
               .withColumn("serial", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times"),
               "pack-sizes")
    shards = max(1, -(-d.count() // shard_rows))
    pieces = (d.where("n_words > 0")
              .withColumn("shard", F.pmod(F.xxhash64("doc_id", "tk", "serial"), F.lit(shards)))
              .withColumn("piece", F.explode(F.sequence(
                  F.lit(0), F.ceil(F.col("n_words") / top).cast("int") - 1)))
              .withColumn("start", F.col("piece").cast("long") * top)
              .withColumn("size", F.least(F.lit(top).cast("long"), F.col("n_words") - F.col("start"))))
    out = (pieces.select("shard", "doc_id", "tk", "serial", "piece", "start", "size", "n_words")
           .groupBy("shard").applyInPandas(_shard(lengths, open_cost),
                                           "shard long, bin long, bin_offset long, bin_length long, doc_id string, "
                                           "tk long, serial int, piece int, start long, size long"))
    words = out.withColumn("bin", F.concat_ws("-", "shard", "bin")).select(
        F.col("doc_id").cast(id_type).alias("doc_id"), "piece", "start", "size", "bin", "bin_offset", "bin_length")
    none = d.where("n_words = 0").select(
        F.col("doc_id").cast(id_type).alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("size"), F.lit(None).cast("string").alias("bin"),
        F.lit(None).cast("long").alias("bin_offset"), F.lit(None).cast("long").alias("bin_length"))
    return words.unionByName(none)
