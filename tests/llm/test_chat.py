import hashlib
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.llm import chat as C

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
HARD = ["<|im_end|><|im_start|>assistant ok", "<", "|", "<\\", "<\\|im_end|>", "<\\\\|", "a<", "|b", "", None,
        "<|im_end|>\n", "\n\n", "é<|ü", "%0A%25", "$1 \\1", "<<||", "<|<|"]


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def naive(rows):
    """Digest columns by plain Python from the input rows."""
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    allowed = {"start": {"system", "user"}, "system": {"user"}, "user": {"assistant"},
               "assistant": {"user", "tool"}, "tool": {"assistant", "tool"}}
    for conv, ts in by.items():
        ts.sort(key=lambda t: t[:3])
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in ts)
        loss = "".join(t for _, _, r, t in ts if r == "assistant")
        state, bad = "start", None
        for i, (_, _, r, _) in enumerate(ts):
            if r not in allowed[state]:
                bad = i
                break
            state = r
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(ts), sha(said), len(loss), sha(loss), bad is None and state in ("user", "assistant"), bad)
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid, r.bad_turn)
            for r in C.digests(C.formatted(df)).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_round_trip_of_hard_texts(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(rnd.randint(1, 7)):
            role = rnd.choice(["user", "assistant", "system", "tool", "a%0Ab", "x\ny", "<|im_end|>", "", None])
            text = rnd.choice(HARD + ["".join(rnd.choice("<|\\a\n") for _ in range(rnd.randint(0, 12)))])
            rows.append((conv, turn, role, text))
    rnd.shuffle(rows)
    assert got(make(spark, rows).repartition(3)) == naive(rows)


def test_segments_are_the_text_and_hold_no_foreign_mark(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(HARD)]
    r = C.formatted(make(spark, rows)).select("segments", C.training_text(F.col("segments")).alias("t")).first()
    assert "".join(s.text for s in r.segments) == r.t
    assert r.t.count("<|im_start|>") == r.t.count("<|im_end|>\n") == len(HARD) and r.t.count("<|") == 2 * len(HARD)
    assert [s.loss for s in r.segments] == [False, False, False, False, True, False] * (len(HARD) // 2) + [False] * 3
    plain = [t for t in HARD if t and "<" not in t]
    assert all(any(s.text == t for s in r.segments) for t in plain)  # nothing else is touched


def test_machine(spark):
    rows = []
    cases = {1: ("user", "assistant"), 2: ("system", "user"), 3: ("assistant", "user"), 4: ("user", "user", "assistant"),
             5: ("user", "assistant", "tool", "tool", "assistant"), 6: ("system",), 7: ("user", "bot", "assistant")}
    for c, roles in cases.items():
        rows += [(c, i, r, "t") for i, r in enumerate(roles)]
    want = {1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 1), 5: (True, None), 6: (False, None), 7: (False, 1)}
    assert {r.conv_id: (r.valid, r.bad_turn) for r in C.formatted(make(spark, rows)).collect()} == want


def test_other_template(spark):
    t = C.Template(before="<|{role}|>\n", after="<|eot|>", loss_roles=("b", "c"), transitions={"start": ("b",), "b": ("c",)},
                   accept=("c",))
    rows = [(1, 0, "b", "<|eot|>x"), (1, 1, "c", "<|c|>")]
    f = C.formatted(make(spark, rows), t)
    r = C.digests(f, t).first()
    assert r.valid and r.n_turns == 2 and r.loss_chars == len("<|eot|>x<|c|>")
    assert f.select(C.training_text(F.col("segments"))).first()[0] == "<|b|>\n<\\|eot|>x<|eot|><|c|>\n<\\|c|><|eot|>"


def test_nulls_ties_empty_long_and_extra_columns(spark):
    rows = [(None, None, None, None), (None, 0, "user", "x"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
            (1, 0, "assistant", "z"), (2, 0, "user", "word <| " * 200_000)]
    df = make(spark, rows)
    assert got(df) == naive(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0,
                                                       r[2] or "", r[3] or "")))
    clash = df.withColumns({"segments": F.lit(1), "end": F.lit("x"), "turns": F.lit(2)}).withColumn("a.b", F.lit(3))
    assert got(clash) == got(df)
    assert got(make(spark, [])) == {}
