"""Merkle fingerprints against a brute force."""

import hashlib
import random
import re

import pytest

from lodestar.llm import fingerprints, queries

KIND = "doc_id long, text string, key string, range string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(text):
    def leaves(p):
        for s in re.split(r"(?<=[.!?,;:] )", p):
            if len(s) <= 256:
                yield sha(s)
                continue
            part = ""
            for byte in s.encode():
                part += f"{byte:02X}"
                if byte & 15 in (5, 15) and len(part) > 48:
                    yield sha(part)
                    part = ""
            if part:
                yield sha(part)

    return [[list(leaves(p)) for p in re.split(r"(?<=\n)", s)] for s in re.split(r"(?<=\n\n)", text)]


def brute(rows):
    def up(t):
        return sha("".join(sha("".join(sha("".join(p)) for p in s)) for s in t))

    def like(a, b):
        a, b = ({x for s in t for p in s for x in p} for t in (a, b))
        return 2.0 * len(a & b) / (len(a) + len(b))

    out = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        a, b = tree(text), tree(edited)
        pads = [(x, y) for x, y in zip(a + [[]] * len(b), b + [[]] * len(a))][:max(len(a), len(b))]
        differing = [f"{k}.{j}" for k, (x, y) in enumerate(pads) for j in range(max(len(x), len(y)))
                     if (x[j:j + 1] or None) != (y[j:j + 1] or None)]
        out.append((doc, len(text), sha(edited), up(a), up(b), like(a, b), like(a, tree(after)), ",".join(differing)))
    return out


def check(spark, rows, monkeypatch, parts=3):
    df = spark.createDataFrame([(*r, "k", "r") for r in rows], KIND).repartition(parts)
    monkeypatch.setattr(queries, "table", lambda *a: df.select("doc_id", "text"))
    got = queries.op5_fingerprints(spark, "")
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                           "near_edited", "near_next", "differing"]
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(ordered)))


def texts(rng, n):
    alphabet = ["a", "bc ", "de. ", "f, ", "\n", "\n\n", "x" * 50, "5f", "中文", "。", "\U0001f600", "!"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("spread", [1, 1 << 50])
def test_against_brute_force(spark, monkeypatch, spread):
    rng = random.Random(3)
    ids = [(1 << 63) - 1, -(1 << 63), 1 << 62, *[spread * i - 40 for i in range(57)], None]
    rows = list(zip(ids, [*texts(rng, 58), "", None, "z" * 4000 + "\u4e2d\u6587o5" * 400], strict=True))
    check(spark, rows, monkeypatch)


@pytest.mark.parametrize("few", [1, 2, 5])
@pytest.mark.parametrize("parts", [1, 64])
def test_few_ranges_and_many(spark, monkeypatch, few, parts):
    rng = random.Random(few)
    monkeypatch.setattr(fingerprints, "RANGES_PER_PARTITION", parts)
    check(spark, list(zip(rng.sample(range(-99, 99), few), texts(rng, few), strict=True)), monkeypatch, 1)


def test_near_copies_without_spaces_or_punctuation_are_alike(spark):
    rng = random.Random(5)
    for text in ("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000)),
                 "".join(rng.choice("0123456789abcdef") for _ in range(6000)),
                 "".join(chr(rng.randrange(0x4E00, 0x9000)) + ("，" if i % 11 == 0 else "") for i in range(3000))):
        near = text[:700] + "文" + text[700:]
        df = spark.createDataFrame([(text, near)], "a string, b string")
        a, b = (fingerprints.merkle_leaves(df[c]) for c in ("a", "b"))
        assert df.select(fingerprints.likeness(a, b)).first()[0] > 0.9


def test_one_hot_id_and_many_null_ids_spread_over_ranges(spark):
    rows = [(7 if i % 2 else None, f"text {i}") for i in range(4000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.with_successor(d)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "range" in plan
    follow = {r.text: r.next_text for r in got.collect()}
    seen, at = set(), "text 0"
    while at not in seen:  # one round through all of them
        seen.add(at)
        at = follow[at]
    assert len(seen) == 4000
