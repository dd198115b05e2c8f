"""Ranked lexical search against a brute force over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lodestar.llm import lexical

DOCS = "doc_id long, text string, n string, terms string, item string"
ITEMS = "item_id long, text string, score string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                      re.sub("[A-Z]", lambda x: x.group().lower(), text or ""))


def brute(docs, items, k=50):
    tfs = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in tfs:
            if not c:
                continue
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def check(spark, docs, items, k=50, **options):
    got = lexical.rank(spark.createDataFrame([(*d, "a", "b", "c") for d in docs], DOCS).repartition(3),
                       spark.createDataFrame([(*i, "a") for i in items], ITEMS), k, **options)
    rows = [tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(rows, key=str) == brute(docs, items, k)


@pytest.fixture(scope="module")
def world():
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(.7))}" for _ in range(400)] + ["Été", "中文", "the", "THE", "x1"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(120)]              # copies: ties
    docs += [(2000 + i, docs[5][1] + " the" * i) for i in range(40)]  # near copies
    docs += [(7, docs[9][1]), (None, docs[5][1]), (None, "the"), (3000, None), (3001, ""), (3002, " -!- \n")]
    items = [(i, " ".join(rng.choice(words) for _ in range(25))) for i in range(12)]
    items += [(3, docs[5][1]), (20, None), (21, ""), (22, "nowhere"), (None, "the été"), (23, "x1;X1,x1")]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"tree_entries": 300, "item_bytes": 500, "tasks_per_group": 1}])
def test_against_brute_force(spark, world, options):
    check(spark, *world, **options)


def test_few_and_empty(spark, world):
    docs, items = world
    check(spark, docs, items[:3], k=2)
    check(spark, [], items)
    check(spark, docs, [])
    check(spark, [(1, None)], items)


def test_long_texts(spark):
    long = "alpha beta,gamma " * 200_000 + "ΩΩ " * 9 + "z" * (3 << 20)
    check(spark, [(1, long), (2, "alpha"), (3, "z" * (3 << 20))], [(1, "alpha ΩΩ beta"), (2, "gamma"), (3, "z" * (3 << 20))])


def test_pieces_are_cut_between_terms():
    n, found = lexical.term_counts(b"ab cd " * 600_000, {b"ab": 0, b"cd": 1, b"b": 2})
    assert n == 1_200_000 and found == {0: 600_000, 1: 600_000}


@pytest.mark.parametrize("leaf,depth", [(2, 48), (2, 3), (1, 200), (32, 48)])
def test_tree_bounds_and_search(leaf, depth):
    rng = np.random.default_rng(1)
    vectors = [np.sort(rng.choice(40, rng.integers(1, 12), replace=False)) for _ in range(400)]
    vectors += [np.arange(n) for n in range(1, 40)] + [np.arange(7)] * 90
    size = np.array([len(v) for v in vectors])
    tfs, ms = rng.integers(1, 9, size.sum()), rng.integers(50, 300, len(size))
    weights, ids = np.arange(1, 41) * 10, rng.permutation(len(size))
    tree = lexical.Tree(ids, np.ones(len(ids), bool), ms, np.concatenate([[0], np.cumsum(size)]),
                        np.concatenate(vectors), tfs, weights, leaf, depth)
    assert max(tree.depth) <= depth + 1
    leaves = [i for i in range(len(tree.lo)) if not len(tree.children[i])]
    assert sorted(d for i in leaves for d in range(tree.lo[i], tree.hi[i])) == list(range(len(size)))
    ends = np.cumsum(size)
    for _ in range(30):
        item = rng.choice(40, 6, replace=False)
        chosen = np.zeros(40, np.int64)
        chosen[item] = 1
        scores = {int(ids[i]): int((lexical.impact(weights[v], tfs[ends[i] - size[i]:ends[i]], ms[i]) * chosen[v]).sum())
                  for i, v in enumerate(vectors)}
        docs, found = tree.search(item, chosen, 10, 1)
        got = dict(zip(tree.ids[docs].tolist(), found.tolist(), strict=True))
        best = sorted((s for s in scores.values() if s), reverse=True)[:10]
        assert sorted(got.values(), reverse=True)[:10] == best
        assert all(scores[i] == s for i, s in got.items())
        assert {i for i, s in scores.items() if best and s >= best[-1] > 0} <= got.keys()
