"""The five stages on a small corpus with planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from stayline.llm import langid, mixing
from stayline.llm.staging import staged


@pytest.fixture(scope="module")
def stages(spark):
    rnd = random.Random(11)
    word = {"en": lambda: "th" + "".join(rnd.choice("aeiounrst") for _ in range(rnd.randint(1, 6))),
            "de": lambda: "sch" + "".join(rnd.choice("äöükzpfw") for _ in range(rnd.randint(1, 6)))}
    text = lambda lang, n: " ".join(word[lang]() for _ in range(n))
    rows = [(i, text("en" if i % 3 else "de", rnd.randint(40, 200)), "en" if i % 3 else "de", f"src{i % 4}") for i in range(150)]
    shared = text("en", 80)
    rows += [(200 + i, text("en", 60) + " " + shared + " " + text("en", 60), "en", "src0") for i in range(5)]
    copy = rows[30][1].split()
    near = list(copy)
    near[len(near) // 2] = "changed"
    rows += [(300, rows[30][1], "de", "src1"), (301, " ".join(near), "de", None), (302, None, "en", "src1"),
             (303, "12 !! 34", "en", "src1"), (304, "", None, None), (None, text("en", 90), "en", "src2"),
             (5, rows[5][1], "en", "src1"), (305, text("en", 20_000), "en", "src3")]
    docs = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("key", F.lit("extra")).withColumn("kept", F.lit(1)).withColumn("row", F.lit(None).cast("int"))
    docs = docs.withColumn("a.b", F.lit(2))
    out = [docs]
    for name, stage in C.STAGES:
        out.append(staged(stage(spark, out[-1], ""), f"test-{name}"))
    return out, shared


def test_all_but_the_last_keep_the_columns(stages):
    frames, _ = stages
    assert all(f.columns == frames[0].columns for f in frames[1:-1])
    assert [n for n, _ in C.STAGES] == ["known_language", "near_dedup", "cut_repeats", "mix_sources", "pack"]


def test_language_stage_rejects_only_what_has_no_known_one(stages):
    frames, _ = stages
    ids = lambda f: sorted(r.doc_id if r.doc_id is not None else -1 for r in f.select("doc_id").collect())
    assert ids(frames[1]) == [i for i in ids(frames[0]) if i not in (302, 303, 304)]


def test_one_of_each_group_of_copies(stages):
    frames, _ = stages
    left = [r.doc_id for r in frames[2].collect()]
    assert 30 in left and not {300, 301} & set(left) and left.count(5) == 1
    assert len(left) == frames[1].count() - 3


def test_repeated_passages_go(stages):
    frames, shared = stages
    before = {r.doc_id: r.text for r in frames[2].collect()}
    for r in frames[3].collect():
        assert r.n_chars == len(r.text)
        if r.doc_id is not None and 200 <= r.doc_id < 205:
            assert shared[10:-10] not in r.text and len(r.text) >= len(before[r.doc_id]) - len(shared) - 20
        else:
            assert r.text == before[r.doc_id]


def test_mix_and_packing(stages):
    frames, _ = stages
    want = {(r.doc_id, r.copies) for r in mixing.mix(frames[3]).collect() if r.copies}
    assert {(r.doc_id, r["count"]) for r in frames[4].groupBy("doc_id").count().collect()} == want
    words = frames[4].select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    rows = frames[5].collect()
    assert sum(r.size for r in rows) == words
    used = {}
    for r in rows:
        used.setdefault((r.bin, r.bin_length), []).append((r.bin_offset, r.size))
    for (_, length), parts in used.items():
        assert sum(s for _, s in parts) <= length
        assert [o for o, _ in sorted(parts)] == [sum(s for _, s in sorted(parts)[:i]) for i in range(len(parts))]


def test_held_out_is_false_for_null_ids(spark):
    d = spark.createDataFrame([(None,), (1,)], "doc_id long")
    assert [r[0] for r in d.select(langid.held_out(3, 1)).collect()][0] is False


def test_empty_table(spark, stages):
    frames, _ = stages
    docs = frames[0].limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
