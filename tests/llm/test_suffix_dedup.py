import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stayline.llm import suffix_dedup as S


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        left = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def corpus(seed, n, length):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rnd.randint(10, 60)) for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            s = rnd.choice(shared)
            parts.append(rnd.choice([text(rnd.randint(1, 40)), s, s[rnd.randint(0, 20):], s[:rnd.randint(20, 300)]]))
        docs.append(" ".join(parts))
    docs += [docs[0], docs[1], docs[1], "", None, "a" * (3 * length), "ab" * length, "x" * length, "short"]
    return docs


@pytest.mark.parametrize("seed,length,hot,task", [(1, 200, 50_000, 50_000), (2, 200, 50_000, 7), (3, 64, 2, 5)])
def test_matches_brute_force(docs_of, seed, length, hot, task):
    texts = corpus(seed, 40, length)
    docs = docs_of([(i, t) for i, t in enumerate(texts)]).repartition(3, "doc_id")
    out, kept = S.repeats(docs, length=length, hot=hot, task_suffixes=task)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()}
    assert got == dict(enumerate(brute(texts, length)))


def test_loser_tree_merges_front_coded_runs():
    rnd = random.Random(4)
    words = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    runs = []
    for k in range(7):
        part = sorted(words[k::7])
        blocks = []
        for i in range(0, len(part), 10):
            lcp, tails = S.front_code(part[i:i + 10])
            blocks.append({"lcp": lcp, "tail": tails})
        runs.append(S.Run(blocks))
    got, last = [], b""
    for top, lcp in S.merge(runs):
        assert lcp == S.shared_prefix(last, top.cur)
        last = top.cur
        got.append(last)
    assert got == sorted(words)


def test_empty_table(docs_of):
    out, kept = S.repeats(docs_of([]))
    assert out.count() == 0 and kept.count() == 0


def test_nulls_repeated_ids_and_rows(docs_of):
    t = "lorem ipsum dolor " * 30
    rows = [(None, t), (1, t), (1, "unlike"), (1, "unlike"), (2, None)]
    out, _ = S.repeats(docs_of(rows))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in out.collect())
    n = len(t)
    assert got == sorted([(True, 0, n, n), (False, 1, n, n), (False, 1, 6, 0), (False, 1, 6, 0), (False, 2, 0, 0)])
