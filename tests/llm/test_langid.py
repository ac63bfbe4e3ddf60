import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.llm import langid as L

WORDS = {"aa": "baba dada gaga lala", "bb": "xoxo zozo kiko rurur", "cc": "mnmn prpr stst vlvl"}


def text(lang, n, rnd):
    return " ".join(rnd.choice(WORDS[lang].split()) + rnd.choice(WORDS[lang].split()) for _ in range(n))


def corpus(seed=1, n=240):
    rnd = random.Random(seed)
    langs = sorted(WORDS)
    return [(i, text(langs[i % 3], rnd.randint(2, 60), rnd), langs[i % 3]) for i in range(n)]


def predict(docs, **kw):
    return {r.doc_id: r for r in L.identify(docs, L.learnable(docs), **kw).collect()}


@pytest.mark.parametrize("max_rows", [None, 30])
def test_held_out_accuracy(docs_of, max_rows):
    rows = corpus()
    got = predict(docs_of(rows).repartition(3), max_rows=max_rows)
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows)


def test_labels_of_held_out_rows_are_not_read(docs_of):
    rows = corpus()
    docs = docs_of(rows)
    wrong = docs.withColumn("lang", F.when(L.held_out(3, 1), F.lit("zz")).otherwise(F.col("lang")))
    a, b = predict(docs), predict(wrong)
    assert {k: (v.lang_pred, v.score) for k, v in a.items()} == {k: (v.lang_pred, v.score) for k, v in b.items()}


def test_mixture_shares(docs_of):
    rnd = random.Random(5)
    rows = corpus() + [(1000, text("aa", 60, rnd) + " " + text("bb", 30, rnd), None)]
    m = predict(docs_of(rows))[1000]
    assert m.lang_pred == "aa" and set(m.mixture) == {"aa", "bb"}
    assert m.mixture["bb"] == pytest.approx(1 / 3, abs=0.06) and sum(m.mixture.values()) == pytest.approx(1)


def test_em_reaches_the_maximum():
    rng = np.random.default_rng(2)
    p = rng.dirichlet(np.ones(40), 3).T
    weight = rng.multinomial(4000, p @ [0.6, 0.0, 0.4]).astype(float)
    share, score = L.fit_mixture(np.log(p), weight)
    grid = [np.array([a, b, 1 - a - b]) for a in np.linspace(0, 1, 51) for b in np.linspace(0, 1 - a, 51)]
    best = max(grid, key=lambda s: float(weight @ np.log(np.maximum(p @ s, 1e-300))))
    assert np.abs(share - best).max() < 0.08 and share[1] == 0


def test_undetermined_null_repeated_and_long(docs_of):
    rnd = random.Random(7)
    rows = corpus() + [(2000, None, "aa"), (2001, "", "aa"), (2002, "12 34 !?", "aa"), (2003, text("cc", 30_000, rnd), None),
                       (2004, "mnmn", "cc"), (2004, "mnmn", None), (None, "baba dada", None), (None, None, None)]
    docs = docs_of(rows).withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(None).cast("int"))
    out = L.identify(docs, L.learnable(docs)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (2000, 2001, 2002, 2003, 2004)] == ["und", "und", "und", "cc", "cc"]
    assert [by[i].score for i in (2000, 2001, 2002)] == [0, 0, 0]
    kept = L.confident(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {2000, 2001, 2002}
    assert kept.count() == len(rows) - 4


def test_known_languages_are_told_from_noise(docs_of):
    """Clean texts in any number of learned languages stay, noise goes; no share decides."""
    rnd = random.Random(11)
    every = [w for ws in WORDS.values() for w in ws.split()]
    clean = {3000: " ".join(text(x, 25, rnd) for x in sorted(WORDS)), 3001: " ".join(text(x, 8, rnd) for x in sorted(WORDS) * 2),
             3002: " ".join(rnd.choice(every) for _ in range(90)), 3003: "dada gaga", 3004: text("bb", 3, rnd) + " 12345 -- 99"}
    noise = {3100: "".join(rnd.choice("qwertyuiopasdfghjklzxcvbnm ") for _ in range(600)), 3101: "q", 3102: "日本語の文章はここにあります。" * 9,
             3103: "hjq wfy", 3104: "Ж" * 40}
    rows = corpus() + [(i, t, None) for i, t in {**clean, **noise}.items()]
    kept = {r.doc_id for r in L.confident(docs_of(rows)).collect()}
    assert kept == set(range(240)) | set(clean)


def test_known_rows_keep_columns_of_any_name(docs_of):
    docs = docs_of(corpus()).withColumn("a.b", F.lit(1)).withColumn("row", F.lit("r")).withColumn("c`d", F.lit(None).cast("int"))
    kept = L.confident(docs)
    assert kept.columns == docs.columns and kept.count() == 240
    assert {tuple(r)[-3:] for r in kept.collect()} == {(1, "r", None)}


def naive_counts(texts):
    """Trigram codes counted character by character."""
    out = {}
    for t in texts:
        a, b = 32, 32
        for c in t.encode():
            c = c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
            if c != 32:
                code = ((c | b << 8 | a << 16) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - L.BITS)
                out[code] = out.get(code, 0) + 1
            a, b = b, c
    return out


def test_model_matches_naive_counts(docs_of):
    rows = corpus(n=60) + [(900, "Über Älg, x9Y", "aa")]
    docs = docs_of(rows)
    langs, logp = L.train(docs, max_rows=None)
    for k, lang in enumerate(langs):
        n = naive_counts([t for _, t, x in rows if x == lang])
        total = sum(n.values()) + L.SMOOTH * (1 << L.BITS)
        want = np.log([(n.get(c, 0) + L.SMOOTH) / total for c in range(1 << L.BITS)])
        assert np.abs(logp[:, k] - want).max() < 1e-4


def test_empty_table_and_no_labels(docs_of):
    assert L.identify(docs_of([]), L.learnable(docs_of([]))).count() == 0
    got = predict(docs_of([(1, "some text", None)]))
    assert got[1].lang_pred == "und" and got[1].score == 0
