"""Document toxicity by multiple-instance learning.

Only documents are labelled. A sentence's probability is a logistic function
of its hashed words and word beginnings; a document is toxic unless none of
its sentences is (noisy-or: 1 - prod(1 - p)). The weights are fitted so that
the noisy-or explains the document labels, which leaves the sentence scores to
say which sentences offend.

Training takes about ``per_class`` labelled documents of each class at most
(the share with the smallest hashes of their ids), reweighted to the true
class ratio.
Scoring reads every whole text once and needs no shuffle.

Defined results: null and empty texts score 0; rows that repeat a doc_id are
scored one by one; a doc_id labelled both ways counts as toxic; without labels
of both classes every score is 0; an empty table gives no rows. Only doc_id and
text are read, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .langid import unit_hash

BITS = 18
BEGINNINGS = (4, 5, 6)
PER_CLASS = 3000
LEAST_DOCS = 5
LEAST_Z = 3.0
STEPS = 200
FLAG = 0.3


def sentences(raw: list[bytes]):
    """Texts laid end to end -> (code per feature, sentence per feature,
    text per sentence, first and last byte + 1 of each sentence in its text).
    Sentences end at . ! ? and line ends; words are runs of letters, digits
    and bytes above 127, A-Z lower-cased."""
    table = bytearray(b" " * 256)
    for lo, hi in ((48, 58), (97, 123), (128, 256)):
        table[lo:hi] = bytes(range(lo, hi))
    table[65:91] = bytes(range(97, 123))
    for c in b".!?\r\n":
        table[c] = 10
    buf = np.frombuffer((b"\n".join(raw) + b"\n").translate(bytes(table)), np.uint8)
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1]
    inside = (buf != 32) & (buf != 10)
    edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(start) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    stop = np.flatnonzero(buf == 10)
    at = np.searchsorted(stop, start)  # the sentence end after each word
    first = np.concatenate(([True], at[1:] != at[:-1]))
    number = np.cumsum(first) - 1
    text = np.searchsorted(begin, start[first], "right") - 1
    hashed = tb.SpanHash(buf)
    codes, owner = [hashed.spans(start, end)], [number]
    for k in BEGINNINGS:
        w = np.flatnonzero(end - start > k)
        codes.append(hashed.spans(start[w], start[w] + k) ^ np.uint64(k))
        owner.append(number[w])
    code = (np.concatenate(codes) >> np.uint64(64 - BITS)).astype(np.int64)
    return code, np.concatenate(owner), text, start[first] - begin[text], stop[at[first]] - begin[text]


def noisy_or(z: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Document probabilities from sentence logits."""
    return -np.expm1(-np.bincount(text, weights=np.logaddexp(0.0, z), minlength=n))


def _features(batches):
    """(label, class size, feature codes, sentence of each) of training rows;
    a sentence's repeated codes count once."""
    for b in batches:
        d = b.to_pydict()
        raw = tb.encode(d["text"])
        out = ([], [], [], [])
        for lo, hi in tb.chunks([len(r) for r in raw]):
            code, owner, text, _, _ = sentences(raw[lo:hi])
            pair = np.unique(owner << BITS | code)
            code, owner = pair & ((1 << BITS) - 1), pair >> BITS
            cut = np.searchsorted(text[owner], np.arange(hi - lo + 1))
            for i in range(hi - lo):
                s = slice(cut[i], cut[i + 1])
                out[0].append(d["y"][lo + i])
                out[1].append(d["of"][lo + i])
                out[2].append(code[s].astype(np.int32))
                out[3].append((owner[s] - (owner[s][0] if cut[i + 1] > cut[i] else 0)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.list_(pa.int32()))],
                                         names=["y", "of", "code", "sent"])


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """text, y and the size of its class, about ``per_class`` rows a class at
    most: the share of its ids with the smallest hashes."""
    y = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
         .agg(F.max("toxic").cast("int").alias("y")))
    size = y.groupBy("y").agg(F.count(F.lit(1)).alias("of"))  # two rows
    pick = (y.join(F.broadcast(size), "y")
            .where(unit_hash("doc_id") < F.least(F.lit(1.0), per_class / F.col("of"))))
    # about 2 * per_class ids at most
    return docs.select("doc_id", "text").join(F.broadcast(pick), "doc_id").select("text", "y", "of")


def fit(rows, steps: int = STEPS):
    """(weight per code, bias) from rows of (y, of, code, sent)."""
    y = np.array([r[0] for r in rows], np.float64)
    n = len(y)
    weights = np.zeros(1 << BITS)
    if n == 0 or y.min() == y.max():
        return weights, -np.inf
    got = np.array([np.sum(y == 0), np.sum(y == 1)], np.float64)
    of = np.array([next(r[1] for r in rows if r[0] == k) for k in (0, 1)], np.float64)
    importance = np.where(y == 1, 1.0, (of[0] / got[0]) / (of[1] / got[1]))
    lens = np.array([len(r[2]) for r in rows])
    code = np.concatenate([r[2] for r in rows]).astype(np.int64)
    doc = np.repeat(np.arange(n), lens)
    # document frequency per class, and the codes that tell the classes apart
    seen = np.unique(doc << BITS | code)
    has, of_doc = seen & ((1 << BITS) - 1), seen >> BITS
    pos = np.bincount(has[y[of_doc] == 1], minlength=1 << BITS) + 0.5
    neg = np.bincount(has[y[of_doc] == 0], minlength=1 << BITS) + 0.5
    odds = np.log(pos / (got[1] + 1 - pos)) - np.log(neg / (got[0] + 1 - neg))
    z = odds / np.sqrt(1 / pos + 1 / neg)
    use = (np.abs(z) >= LEAST_Z) & (pos + neg >= LEAST_DOCS)
    sent = np.concatenate([r[3] for r in rows]).astype(np.int64)
    many = np.array([r[3].max() + 1 if len(r[3]) else 0 for r in map(lambda r: (0, 0, 0, np.asarray(r[3])), rows)])
    sent += np.repeat(np.cumsum(many) - many, lens)
    text = np.repeat(np.arange(n), many)
    k = use[code]
    code, sent = code[k], sent[k]
    kinds, code = np.unique(code, return_inverse=True)
    w, bias = np.maximum(odds[kinds], 0.0), -7.0
    g2, b2 = np.full(len(kinds), 1e-8), 1e-8
    total = importance.sum()
    for _ in range(steps):
        z = bias + np.bincount(sent, weights=w[code], minlength=len(text))
        p = noisy_or(z, text, n)
        # d loss / d z of a sentence: p_s * (1 - y / P)
        per = importance * (1 - y / np.maximum(p, 1e-9)) / total
        gz = per[text] / (1 + np.exp(-z))
        gw = np.bincount(code, weights=gz[sent], minlength=len(kinds)) + 1e-6 * w
        gb = gz.sum()
        g2 += gw * gw
        b2 += gb * gb
        w -= 0.5 * gw / np.sqrt(g2)
        bias -= 0.5 * gb / np.sqrt(b2)
    weights[kinds] = w
    return weights, float(bias)


def offending(p: np.ndarray, text: np.ndarray, whole: np.ndarray, flag: float) -> np.ndarray:
    """Which sentences carry their text's score: of a text that reaches
    ``flag``, the likeliest ones until their noisy-or reaches it, and all that
    reach it alone."""
    order = np.lexsort((np.arange(len(p)), -p, text))
    none = np.log1p(-np.minimum(p, 1 - 1e-15))[order]
    before = np.cumsum(none) - none
    first = np.flatnonzero(np.concatenate(([True], text[order][1:] != text[order][:-1]))) if len(p) else order
    before -= np.repeat(before[first], np.diff(np.append(first, len(p))))
    out = np.zeros(len(p), bool)
    out[order] = (p[order] >= flag) | (1 - np.exp(before) < flag)
    return out & (whole[text] >= flag)


def _score(model, flag: float):
    def run(batches):
        weights, bias = model.value
        for b in batches:
            raw = tb.encode(b.column("text").to_pylist())
            score, spans = [], []
            for lo, hi in tb.chunks([len(r) for r in raw]):
                code, owner, text, first, last = sentences(raw[lo:hi])
                mine = np.unique(owner << BITS | code)
                z = bias + np.bincount(mine >> BITS, weights=weights[mine & ((1 << BITS) - 1)], minlength=len(text))
                whole = noisy_or(z, text, hi - lo)
                score.append(whole)
                p = 1 / (1 + np.exp(-z))
                found = [[] for _ in range(hi - lo)]
                for s in np.flatnonzero(offending(p, text, whole, flag)):
                    r = raw[lo + text[s]]
                    a = len(r[:first[s]].decode("utf-8", "ignore"))
                    found[text[s]].append({"start": a, "end": a + len(r[first[s]:last[s]].decode("utf-8", "ignore")),
                                           "score": float(p[s])})
                spans += found
            rest = [n for n in b.schema.names if n != "text"]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in rest] + [pa.array(np.concatenate(score) if score else [], pa.float64()),
                                               pa.array(spans, kind)], names=[*rest, "score", "sentences"])
    return run


def score(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, flag: float = FLAG) -> DataFrame:
    """doc_id, score and the offending sentences (start and end character, own
    probability) of every row of ``docs``, see :func:`offending`: every text
    that scores ``flag`` has one, no other has; learned from ``labels`` (doc_id,
    toxic), which the caller has restricted."""
    spark = docs.sparkSession
    rows = (training_rows(docs, labels, per_class)
            .mapInArrow(_features, "y int, of long, code array<int>, sent array<int>")
            .toArrow())
    parts = [(y, of, np.asarray(c.values), np.asarray(s.values)) for y, of, c, s in
             zip(rows["y"].to_pylist(), rows["of"].to_pylist(), rows["code"], rows["sent"])]
    model = spark.sparkContext.broadcast(fit(parts))  # 2**18 weights
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _score(model, flag), f"doc_id {id_type}, score double, "
        "sentences array<struct<start:int,end:int,score:double>>")
