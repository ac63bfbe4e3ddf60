"""Language identification as a mixture of languages.

Training counts hashed character n-grams per language over labelled rows.
A document is a mixture: each n-gram is drawn from one of its languages.
Expectation-maximisation finds the proportions; the language set grows from
the best single one, a further one being admitted only while the gain in log
likelihood exceeds its penalty (half the logarithm of the n-gram count, plus a
margin per n-gram). The prediction is the language with the largest share.

Whether a text's language is known at all is a likelihood ratio, not a share:
the penalised likelihood of its chosen mixture against a background that takes
every n-gram code for equally likely. N-grams of no learned language cost
evidence, those of any learned language add to it, so clean texts in several
languages are known and noise or an unlearned script is not.

Defined results: null text or text without a letter is ``und`` with score 0;
so is everything if no labelled row exists. Rows with a null label are not
learned from. Training may be bounded to ``max_rows`` rows per language, the
ones with the smallest hash of doc_id and text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .staging import whole_row

UND = "und"
BITS = 16
SMOOTH = 0.5
ROUNDS = 12
MAX_ROWS = 2000
MARGIN = 0.01
EVIDENCE = 5.0  # nats by which a known language beats the background


def ngrams(raw: list[bytes]):
    """Hashed byte trigrams of texts laid end to end: (codes, offsets). One
    ends at every byte of a letter; digits, ASCII signs and blanks are one
    separator, letters A-Z are lower-cased."""
    table = bytearray(b" " * 256)
    table[97:123] = bytes(range(97, 123))
    table[65:91] = bytes(range(97, 123))
    table[128:256] = bytes(range(128, 256))
    buf = np.frombuffer((b"  " + b"  ".join(raw) + b"  ").translate(bytes(table)), np.uint8)
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    begin = np.concatenate(([0], np.cumsum(lengths + 2))) + 2
    b = buf.astype(np.uint32)
    g = b.copy()
    g[1:] |= b[:-1] << np.uint32(8)
    g[2:] |= b[:-2] << np.uint32(16)
    tri = (g * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    use = np.flatnonzero(buf != 32)
    return tri[use], np.searchsorted(use, begin)


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


def _count(langs: list[str]):
    index = {l: i for i, l in enumerate(langs)}

    def run(batches):
        total = np.zeros((len(langs), 1 << BITS), np.int64)
        for pdf in batches:
            for lo, hi, raw in tb.pieces(pdf["text"]):
                codes, off = ngrams(raw)
                who = np.array([index[x] for x in pdf["lang"].iloc[lo:hi]])
                for l in np.unique(who):
                    mine = np.repeat(who == l, np.diff(off))
                    total[l] += np.bincount(codes[mine], minlength=1 << BITS)
        yield pd.DataFrame({"lang": langs, "n": list(total)})
    return run


def unit_hash(*columns: str):
    """A hash of the columns, even over [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 33) / F.lit(float(1 << 31))


def train(labelled: DataFrame, max_rows: int | None = MAX_ROWS):
    """(languages, log likelihood per n-gram code and language). The driver
    holds one count table of 2**16 codes per language, whatever the input."""
    d = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    langs = [r[0] for r in d.select("lang").distinct().orderBy("lang").collect()]  # label set
    if not langs:
        return [], np.zeros((1 << BITS, 0), np.float32)
    if max_rows is not None:
        # a row per label; no label's rows meet in one task
        share = d.groupBy("lang").agg(F.least(F.lit(1.0), max_rows / F.count(F.lit(1))).alias("share"))
        d = d.join(F.broadcast(share), "lang").where(unit_hash("doc_id", "text") < F.col("share"))
    counts = np.zeros((len(langs), 1 << BITS), np.float64)
    parts = (d.select("text", "lang").mapInPandas(_count(langs), "lang string, n array<long>")
             .select("lang", F.posexplode("n").alias("code", "n")).where("n > 0")
             .groupBy("lang", "code").agg(F.sum("n").alias("n")).toPandas())
    index = {l: i for i, l in enumerate(langs)}
    counts[parts["lang"].map(index).to_numpy(), parts["code"].to_numpy()] = parts["n"].to_numpy()
    p = (counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * (1 << BITS))
    return langs, np.log(p.T).astype(np.float32)


def fit_mixture(logp: np.ndarray, weight: np.ndarray, margin: float = MARGIN):
    """Proportions of a document's languages (zero for those not admitted) and
    its penalised log likelihood. logp: n-gram kinds x languages."""
    langs = logp.shape[1]
    total = weight.sum()
    best = weight @ logp
    chosen = [int(np.argmax(best))]
    share = np.zeros(langs)
    share[chosen] = 1.0
    score = best[chosen[0]]
    top = logp.max(axis=1, keepdims=True)
    like = np.exp(logp - top)
    base = float(weight @ top[:, 0])
    while len(chosen) < langs:
        # the language that explains best what the chosen ones explain badly
        now = like @ share
        gain = weight @ np.log1p(0.1 * (like / now[:, None] - 1.0))
        gain[chosen] = -np.inf
        cand = chosen + [int(np.argmax(gain))]
        part = like[:, cand]
        pi = np.full(len(cand), 1.0 / len(cand))
        for _ in range(ROUNDS):
            resp = part * pi
            resp /= resp.sum(axis=1, keepdims=True)
            pi = weight @ resp / total
        ll = float(weight @ np.log(part @ pi)) + base
        if ll - score <= 0.5 * np.log(total + 1) + margin * total:
            break
        chosen, score = cand, ll
        share = np.zeros(langs)
        share[cand] = pi
    return share, score


def judge(texts, langs: list[str], table: np.ndarray):
    """(predictions, scores, mixtures, evidence) of a sequence of texts;
    evidence: log likelihood of the mixture, less a penalty per language, above
    that of the background (minus infinity for und)."""
    pred, score, shares, evidence = [], [], [], []
    for lo, hi, raw in tb.pieces(texts):
        codes, off = ngrams(raw)
        for i in range(hi - lo):
            mine = codes[off[i]:off[i + 1]]
            if not langs or len(mine) == 0 or not has_letter(texts[lo + i]):
                pred.append(UND)
                score.append(0.0)
                shares.append([])
                evidence.append(-np.inf)
                continue
            kinds, weight = np.unique(mine, return_counts=True)
            share, like = fit_mixture(table[kinds].astype(np.float64), weight.astype(np.float64))
            k = int(np.argmax(share))
            pred.append(langs[k])
            score.append(float(min(1.0, max(0.0, share[k]))))
            shares.append([(langs[j], float(share[j])) for j in np.flatnonzero(share > 0)])
            background = len(mine) * BITS * np.log(2.0)
            evidence.append(float(like + background - 0.5 * np.log(len(mine) + 1) * np.count_nonzero(share)))
    return pred, score, shares, evidence


def _predict(langs: list[str], logp):
    def run(batches):
        for b in batches:
            pred, score, shares, _ = judge(b.column("text").to_pylist(), langs, logp.value)
            rest = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in rest] + [pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                               pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                names=[*rest, "lang_pred", "score", "mixture"])
    return run


def identify(docs: DataFrame, labelled: DataFrame, max_rows: int | None = MAX_ROWS,
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row of ``docs`` (text is the only input of a
    prediction), lang_pred, score (share of that language) and mixture."""
    langs, logp = train(labelled, max_rows)
    table = docs.sparkSession.sparkContext.broadcast(logp)  # 2**16 codes a language
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(
        _predict(langs, table), f"{fields}, lang_pred string, score double, mixture map<string,double>")


def held_out(mod: int, rest: int):
    """Whether crc32 of doc_id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    """Rows whose label may be learned from."""
    return docs.where(~held_out(3, 1) & F.col("doc_id").isNotNull())


def confident(docs: DataFrame, evidence: float = EVIDENCE, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Rows of ``docs`` whose language or languages are known: the mixture
    beats the background by ``evidence``. Null texts, texts without a letter,
    random letters and unlearned scripts go; so does all if no labelled row
    exists. A text of one or two letters is known only if words of a learned
    language often begin with them. All columns stay, whatever their names."""
    langs, logp = train(learnable(docs), max_rows)
    table = docs.sparkSession.sparkContext.broadcast(logp)
    at = [c.lower() for c in docs.columns].index("text")  # the row holds it, so it moves once

    def run(batches):
        for b in batches:
            row = b.column("row")
            found = judge(row.field(at).to_pylist(), langs, table.value)[3]
            known = pa.array([e > evidence for e in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([row.filter(known)], names=["row"])
    rows = docs.select(whole_row(docs).alias("row"))
    out = rows.mapInArrow(run, T.StructType([rows.schema["row"]]))
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns])
