import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"


def corpus(seed=3, n=400):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    rows, labels = [], []
    for i in range(n):
        sents = [" ".join(word() for _ in range(rnd.randint(3, 9))) for _ in range(rnd.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            k = rnd.randrange(len(sents))
            sents[k] += " " + rnd.choice(["zonk", "zonky", "quux", "Wombat"]) + " " + word()
        rows.append((i, ". ".join(sents) + "."))
        labels.append((i, None, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, " . ! \n"), (1003, "zonk"), (1003, "plain words"), (None, "quux me"),
             (1004, "plain words. " * 20_000 + "a quux here. " + "more words. " * 100)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string").withColumn("score", F.lit("x"))
    more = labels + [(0, None, 0), (7, None, None), (None, 1, 1)]
    return docs, spark.createDataFrame(more, LABELS), dict(rows), {d: t for d, _, t in labels}


def test_held_out_documents_and_sentences(tables):
    docs, labels, texts, toxic = tables
    learn = labels.where((F.col("doc_id") % 4 != 2) | F.col("doc_id").isNull())
    got = {}
    for r in T.score(docs.repartition(3), learn).collect():
        got.setdefault(r.doc_id, []).append(r)
    held = [i for i in toxic if i % 4 == 2]
    right = [(got[i][0].score >= 0.3) == bool(toxic[i]) for i in held]
    assert np.mean(right) >= 0.97
    for i in held:
        for s in got[i][0].sentences if toxic[i] else []:
            assert any(w in texts[i][s.start:s.end].lower() for w in ("zonk", "quux", "wombat"))
    assert [got[i][0].score for i in (1000, 1001, 1002)] == [0, 0, 0]
    assert sorted(r.score >= 0.3 for r in got[1003]) == [False, True] and got[None][0].score >= 0.3
    assert got[1004][0].score >= 0.3 and len(got[1004][0].sentences) == 1
    assert all(0 <= r.score <= 1 for rs in got.values() for r in rs)


def test_bounded_sample_and_no_labels(spark, tables):
    docs, labels, _, _ = tables
    sizes = {r.y: (r["count"], r.of) for r in T.training_rows(docs, labels, 20).groupBy("y", "of").count().collect()}
    assert {y: of for y, (_, of) in sizes.items()} == {0: 320, 1: 80} and all(5 <= n <= 40 for n, _ in sizes.values())
    none = T.score(docs, labels.where("toxic = 0")).agg(F.max("score")).first()[0]
    assert none == 0
    empty = spark.createDataFrame([], docs.schema)
    assert T.score(empty, labels).count() == 0


def test_noisy_or_matches_product():
    z, text = np.array([-2.0, 0.5, 1.0, -30.0]), np.array([0, 0, 2, 3])
    p = 1 / (1 + np.exp(-z))
    want = [1 - (1 - p[0]) * (1 - p[1]), 0, p[2], p[3]]
    assert T.noisy_or(z, text, 4) == pytest.approx(want)


def test_sentences_that_carry_a_text():
    """Against a plain loop: the likeliest until they reach the flag, and all that reach it alone."""
    rnd = random.Random(4)
    text = np.sort([rnd.randrange(40) for _ in range(300)])
    p = np.array([rnd.choice([0.01, 0.1, 0.2, 0.29, 0.3, 0.9, 1.0]) for _ in text])
    whole = np.array([1 - np.prod(1 - p[text == t]) for t in range(40)])
    got = T.offending(p, text, whole, 0.3)
    for t in range(40):
        mine = sorted(np.flatnonzero(text == t), key=lambda i: (-p[i], i))
        want, free = set(), 1.0
        for i in mine if whole[t] >= 0.3 else []:
            if p[i] >= 0.3 or 1 - free < 0.3:
                want.add(i)
            free *= 1 - p[i]
        assert set(np.flatnonzero(got & (text == t))) == want
    assert len(T.offending(np.zeros(0), np.zeros(0, int), np.zeros(0), 0.3)) == 0


def test_every_flagged_document_has_a_sentence(spark, sf_small):
    from stayline.llm.queries import op1_toxicity
    for r in op1_toxicity(spark, sf_small.replace("0.001", "0.01")).collect():
        assert (r.predicted == 1) == (r.n_offending > 0) == (len(r.sentences) > 0)


def test_sentences_are_cut_and_folded():
    code, owner, text, first, last = T.sentences([b"Ab cd! x", b"", "é f\ng".encode()])
    assert text.tolist() == [0, 0, 2, 2] and first.tolist() == [0, 7, 0, 5] and last.tolist() == [5, 8, 4, 6]
    one = T.sentences([b"AB"])[0]
    assert one.tolist() == T.sentences([b"ab"])[0].tolist()
