import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from stayline.llm import merkle as M

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(digests):
    """(root, per leaf the siblings by level, each (left, right))."""
    paths = [[] for _ in digests]
    where = list(range(len(digests)))
    row = list(digests)
    while len(row) > 1:
        for p, at in zip(paths, where):
            run = row[at // 16 * 16:at // 16 * 16 + 16]
            p.append(("".join(run[:at % 16]), "".join(run[at % 16 + 1:])))
        row = [h(*row[i:i + 16]) for i in range(0, len(row), 16)]
        where = [w // 16 for w in where]
    return row[0], paths


def naive(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaf = lambda r, t: h(*map(enc, (r[0], r[3], r[2], r[4], t)))
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for s in names:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        done[s] = climb([leaf(r, r[1]) for r in trees[s]])
    root, tops = climb([done[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for r, path in zip(trees[s], done[s][1]):
            path = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            low = r[1].translate(str.maketrans(UPPER, LOWER)) if r[1] is not None else None
            acc = leaf(r, low if tampered else r[1])
            for a, b in path:
                acc = h(a, acc, b)
            out.append((r[0], leaf(r, r[1]), done[s][0], root, h(*[a + b for a, b in path]), acc, acc == root))
    return sorted(out, key=str)


def got(df, **kw):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    d = M.verified(df, tampered, {"text": F.translate("text", UPPER, LOWER)}, **kw)
    return sorted([tuple(r) for r in d.collect()], key=str)


def corpus(seed, sizes):
    rnd = random.Random(seed)
    rows = []
    for source, n in sizes:
        for _ in range(n):
            text = rnd.choice([None, "", "Abc é", "lower only", "X" * rnd.randint(1, 50)])
            rows.append((rnd.randint(0, 10 ** 6), text, rnd.choice(["en", None]), source, rnd.choice([None, 7])))
    return rows


def full(rows):
    return [(r[0], r[1], r[2], r[3], r[4]) for r in rows]


@pytest.fixture
def docs(spark):
    from .conftest import DOC_SCHEMA
    return lambda rows: spark.createDataFrame(full(rows), DOC_SCHEMA)


@pytest.mark.parametrize("seed,block,ranges", [(1, 4096, 200_000), (2, 37, 100), (3, 5, 40), (4, 16, 64)])
def test_matches_brute_force(docs, seed, block, ranges):
    sizes = [("a", 600), ("b", 1), ("é", 16), ("z", 17), (None, 30), ("", 2), ("hot", 300)] + [(f"s{i}", 3) for i in range(40)]
    rows = corpus(seed, sizes)
    assert got(docs(rows).repartition(5), block=block, range_rows=ranges) == naive(rows)


@pytest.mark.parametrize("sizes", [[("a", 1)], [("a", 16)], [("a", 17)], [("a", 257)], [("a", 1), (None, 1)],
                                   [(f"s{i}", 1) for i in range(18)]])
def test_small_trees(docs, sizes):
    rows = corpus(9, sizes)
    assert got(docs(rows), block=7, range_rows=10) == naive(rows)


def test_nulls_repeated_rows_ties_long_text_and_empty_table(docs):
    rows = [(None, None, None, None, None)] * 2 + [(5, "A", "en", "s", 1)] * 3 + [(5, "B", "en", "s", 1), (6, "Q" * 3_000_000, "en", "s", None)]
    assert got(docs(rows)) == naive(rows)
    assert got(docs([])) == []


def test_extra_columns_are_not_read(docs):
    rows = corpus(5, [("a", 40), ("b", 3)])
    d = docs(rows).withColumns({"tree": F.lit("x"), "digest": F.lit(1), "keep": F.lit(2), "pos": F.lit(0)}).withColumn("a.b", F.lit(1))
    assert got(d) == naive(rows)


def test_missing_coordinates_are_the_minimal_union():
    """Against sets: what the proofs of all leaves name, less what follows from the leaves."""
    for n in (1, 2, 15, 16, 17, 300, 4097):
        for low, high in {(0, n - 1), (0, 0), (n - 1, n - 1), (n // 3, n // 2)}:
            need, known, width, level = set(), set(range(low, high + 1)), n, 0
            while width > 1:
                runs = {i // 16 for i in known}
                need |= {(level, j) for r in runs for j in range(r * 16, min(r * 16 + 16, width))} - {(level, i) for i in known}
                known, width, level = runs, -(-width // 16), level + 1
            assert list(M.missing(low, high, n)) == sorted(need) + [(level, 0)]


def test_a_node_that_is_not_its_run_is_refused():
    nodes = {(0, i): h(str(i)) for i in range(20)}
    assert len(M.derive(dict(nodes), 0, 19, 20)) == 3
    with pytest.raises(ValueError):
        M.derive({**nodes, (2, 0): "0" * 64}, 0, 19, 20)
