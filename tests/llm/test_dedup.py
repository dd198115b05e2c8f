"""Operators on repeated text against brute force."""

import hashlib
import random
import re

from llm_samples import corpus, docs, edited, no_docs, prose  # noqa: F401

from lodestar.llm import jaccard, sketch, substrings, suffix_dedup
from lodestar.llm.graph import components
from lodestar.llm.sigtree import links
from lodestar.llm.suffixes import suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_order(corpus):
    return sorted(corpus, key=lambda r: (r[0] is None, r[0] or 0))


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def test_repeated_windows(docs, no_docs, corpus):
    seen, want = set(), {}
    for d, t, *_ in in_order(corpus):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            if key in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want[d] = (len(w), sum(gone), sha(kept), kept)
    got = {r.doc_id: tuple(r)[1:] for r in substrings.remove_repeats(docs).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 500
    assert substrings.remove_repeats(no_docs).count() == 0


def test_repeated_rows_are_alike(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, t), (1, t), (2, t)], "doc_id long, text string")
    for op in (substrings, suffix_dedup):
        got = sorted((r.doc_id, r.n_removed > 0) for r in op.remove_repeats(df).collect())
        assert got == [(1, False), (1, False), (2, True)]


def test_repeated_strings(docs, no_docs, corpus):
    first, want = {}, {}
    for d, t, *_ in in_order(corpus):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first.setdefault(b[i:i + 50], d) != d:
                gone[i:i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        want[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    got = {r.doc_id: tuple(r)[1:] for r in
           suffix_dedup.remove_repeats(docs, with_text=False).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 2000
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(1500):
        k = rng.randint(1, 4)
        x = [rng.randint(1, k) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def test_smallest_document_of_each_string():
    rng = random.Random(4)
    for _ in range(200):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(3, 12))) for _ in range(4)]
        ids = rng.sample(range(100), 4)
        want = [[min(ids[k] for k, t in enumerate(strings) if s[i:i + 3] in t)
                 for i in range(len(s) - 2)] for s in strings]
        assert suffix_dedup.smallest_by_suffixes(strings, ids, 3) == want


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else \
        frozenset([tuple(w)] if w else [])


def test_near_duplicates(docs, no_docs, corpus):
    sets = {d: shingles(t) for d, t, *_ in corpus}
    rank = {d: i for i, (d, *_) in enumerate(in_order(corpus))}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    n = 0
    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if rank[a] < rank[b] and x and y and 100 * len(x & y) >= 80 * len(x | y):
                n += 1
                p, q = sorted((find(a), find(b)), key=rank.get)
                root[q] = p
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard.near_duplicates(docs).collect()}
    assert got == {d: (len(sets[d]), find(d)) for d in sets} and n > 20
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_links_of_rows_without_own_ids(spark):
    """Rows are linked by their own texts; an id that two texts share
    connects them."""
    w, v = (" ".join(f"{c}{k}" for k in range(500)) for c in "wv")

    def found(*rows):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        return sorted(((r.doc_id, r.component_id) for r in jaccard.near_duplicates(df).collect()), key=str)

    more = ((3, w + " extra"), (4, v + " extra"))
    assert found((None, w), (None, v), *more) == [(3, 3), (4, 4), (None, 3), (None, 4)]
    assert found((7, w), (7, v), *more) == [(3, 3), (4, 3), (7, 3), (7, 3)]
    assert found((None, w), (None, w), (9, v), (9, "")) == [(9, 9), (9, 9), (None, None), (None, None)]


def test_only_sets_with_partners_are_sent(spark, monkeypatch):
    """Sets without a similar one stay where they are, however many shingles
    there are for each cell of a filter (here 2^20 for 2.4 million)."""
    rng = random.Random(5)
    rows = [(i, " ".join(str(rng.getrandbits(40)) for _ in range(600))) for i in range(4000)]
    rows += [(4000 + i, rows[i][1] + " more") for i in range(30)]
    sent, codes = spark.sparkContext.accumulator(0), jaccard._codes

    def counted(*args):
        run = codes(*args)

        def counting(batches):
            for batch in run(batches):
                sent.add(batch.num_rows)
                yield batch
        return counting

    monkeypatch.setattr(jaccard, "SKETCH_BITS", 20, raising=False)
    monkeypatch.setattr(jaccard, "_codes", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(df).collect()}
    assert got == {i: i - 4000 if i >= 4000 else i for i in range(4030)}
    assert 60 <= sent.value <= 120


def test_slices_and_levels(spark, monkeypatch):
    """Small blocks, buckets, pieces and parts, and a slice in which most sets
    have too few shingles, give the same groups."""
    rng = random.Random(6)
    base = [prose(rng, n) for n in (1, 2, 4, 5, 6, 9, 20, 60, 60, 200)]
    rows = [(i, edited(rng, base[i % 10], i % 4)) for i in range(200)] + [(None, base[8]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    whole = sorted(map(str, jaccard.near_duplicates(df).collect()))
    for changes in ({"SLICE": 205, "BLOCK_BYTES": 1000, "PART_SETS": 8},
                    {"SLICE": 1024, "PIECE_ITEMS": 50, "GROUP_ITEMS": 100, "HELD_ITEMS": 60}):
        for name, value in changes.items():
            monkeypatch.setattr(jaccard, name, value)
        assert sorted(map(str, jaccard.near_duplicates(df).collect())) == whole, changes


def test_blocks_of_large_groups(spark, monkeypatch):
    """A component of ties cut into many blocks gives the same groups."""
    rng = random.Random(8)
    base = [prose(rng, 60) for _ in range(3)]
    rows = [(i, edited(rng, base[i % 3], 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, jaccard.near_duplicates(df).collect()))
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    assert sorted(map(tuple, jaccard.near_duplicates(df).collect())) == whole
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 2048)
    monkeypatch.setattr(jaccard, "BLOCK_ITEMS", 200)
    assert sorted(map(tuple, jaccard.near_duplicates(df).collect())) == whole


def test_signature_trees_find_all_links():
    import numpy as np
    rng = random.Random(5)
    sets = []
    for _ in range(12):
        core = rng.sample(range(10 ** 6), rng.randint(3, 40))
        for _ in range(rng.randint(1, 30)):
            s = set(core) | set(rng.sample(range(10 ** 6), rng.randint(0, 6)))
            sets.append(np.unique((np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15))))

    def groups(pairs, n):
        label = list(range(n))
        for a, b in pairs:
            x, y = label[a], label[b]
            label = [x if v == y else v for v in label]
        seen = {}
        return [seen.setdefault(v, len(seen)) for v in label]

    n = len(sets)
    every = [(i, j) for i in range(n) for j in range(i)
             if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    assert groups(links(sets, None, 80), n) == groups(every, n) and every
    half = n // 2
    cross = [(i, j) for i, j in every if (i < half) != (j < half)]
    got = [(i, half + j) for i, j in links(sets[:half], sets[half:], 80)]
    assert groups(got, n) == groups(cross, n)


def test_sketch_only_overestimates(spark):
    import numpy as np
    from pyspark.sql import functions as F

    def items(batch):
        yield batch.column(0).to_numpy().view(np.uint64)

    df = spark.range(6000).select(F.xxhash64(F.col("id") % 4000).alias("h")).repartition(7)
    rep = sketch.repeats(df, items, 6000, levels=(2, 5))
    h = {r.h for r in df.collect()}
    twice = {r.h for r in df.groupBy("h").count().where("count > 1").collect()}
    a = np.array(sorted(h), np.int64).view(np.uint64)
    maybe = {int(x) for x in a[rep.maybe(a)].view(np.int64)}
    assert twice <= maybe and len(maybe - twice) < 50 and rep.level(a).max() <= 1
    values = np.sort(np.array([0, 0, 5, 70000, 1 << 30], np.uint32))
    assert sketch.unpack_rising(sketch.pack_rising(values)).tolist() == values.tolist()


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (5, 5)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200}
