"""Fused checks against counting by hand, and the shape of their plan."""

import random
from collections import Counter

from pyspark.sql import functions as F

from stayline.operators import checks
from stayline.plans import q_checks as C
from stayline.plans.models import Models

UNIQUE = [({"name": "parent"}, "p", "id"), ({"name": "child"}, "c", "cid")]
RELATED = [({"name": "c-p"}, "c", "ref", "p", "id"), ({"name": "g-c"}, "g", "up", "c", "cid"),
           ({"name": "g-p"}, "g", "ref", "p", "id")]


def tables(spark, p, c, g):
    return {"p": spark.createDataFrame([(x,) for x in p], "id long"),
            "c": spark.createDataFrame(c, "cid string, ref long"),
            "g": spark.createDataFrame(g, "up string, ref long")}


def by_hand(p, c, g):
    def repeated(values):
        return sum(n > 1 for v, n in Counter(values).items() if v is not None)

    def orphans(child, parent):
        return sum(v is not None and v not in set(parent) for v in child)
    return {"parent": repeated(p), "child": repeated([x for x, _ in c]), "c-p": orphans([y for _, y in c], p),
            "g-c": orphans([x for x, _ in g], [x for x, _ in c]), "g-p": orphans([y for _, y in g], p)}


def result(frames):
    return {r.name: r.violations for r in checks.key_pass(frames, UNIQUE, RELATED).collect()}


def test_key_pass_equals_counting_by_hand(spark):
    rnd = random.Random(4)
    ids, names = [None, *range(12)], [None, "", "1", "2", "a", "b", "ä", " a"]
    for n in (0, 1, 9, 40):
        # a key with a third of the rows, keys of both domains that look alike
        p = [rnd.choice(ids) for _ in range(n // 2)]
        c = [(rnd.choice(names), rnd.choice([1, *ids, *ids[:5]])) for _ in range(n)]
        g = [("1" if rnd.random() < 0.3 else rnd.choice(names), rnd.choice(ids)) for _ in range(n)]
        assert result(tables(spark, p, c, g)) == by_hand(p, c, g)


def test_domains_follow_relationships():
    slots = sorted({("p", "id"), ("c", "cid"), ("c", "ref"), ("g", "up"), ("g", "ref")})
    of = checks.domains(slots, RELATED)
    assert of["p", "id"] == of["c", "ref"] == of["g", "ref"] != of["c", "cid"] == of["g", "up"]


def test_tally_counts_what_holds(spark):
    d = spark.createDataFrame([(1, None), (None, "x"), (3, "it's")], "a int, b string")
    got = checks.tally(d, [({"n": "a", "of": "it's"}, F.col("a") > 1), ({"n": "b", "of": "-"}, F.col("b").isNull())])
    assert {(r.n, r.of): r.violations for r in got.collect()} == {("a", "it's"): 1, ("b", "-"): 1}
    assert [r.violations for r in checks.tally(d.limit(0), [({"n": "a"}, F.col("a") > 1)]).collect()] == [0]


def test_key_checks_are_one_grouping(spark):
    """Five checks on two domains take one hash shuffle and no join."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        r = spark.range(0, 100, 1, 4)
        frames = {"p": r, "c": r.select(F.col("id").cast("string").alias("cid"), F.col("id").alias("ref")),
                  "g": r.select(F.col("id").cast("string").alias("up"), F.col("id").alias("ref"))}
        plan = checks.key_pass(frames, UNIQUE, RELATED)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_report_finds_planted_defects(spark, sf_small):
    """Row, key and count checks of the report fire together, and only they."""
    m = Models.from_driver(spark, sf_small)
    e = m.inpatient_episodes
    first, other = [r[0] for r in e.where("is_eligible_index").select("episode_id").orderBy("episode_id").limit(2).collect()]
    m.__dict__["inpatient_episodes"] = e.unionByName(e.where(F.col("episode_id") == first))
    f = m.episode_features
    m.__dict__["episode_features"] = f.withColumn("patient_id", F.when(F.col("episode_id") == other, F.lit("nobody"))
                                                  .otherwise(F.col("patient_id"))).withColumn(
        "gender", F.when(F.col("episode_id") == first, F.lit(None)).otherwise(F.col("gender")))
    found = {r.check_name: r.violations for r in C.full_report(m).collect() if r.status == "FAIL"}
    expect = {"unique_inpatient_episodes_episode_id": 1, "episodes_eligible_count": 1,
              "not_null_episode_features_gender": 1, "relationships_episode_features_patient_id_patients": 1}
    assert {k: found.get(k) for k in expect} == expect
    assert set(found) - set(expect) <= {"features_prior_episodes_match"}
    passed = {r.check_name for r in C.full_report(m, expected=e.where("is_eligible_index").count() + 1).collect()
              if r.status == "PASS"}
    assert "episodes_eligible_count" in passed and "features_row_count" not in passed
