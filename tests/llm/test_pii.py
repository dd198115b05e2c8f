"""Personal data: the patterns against plain ones, the field against exact
marginals, and what it adds to planted cases."""

import itertools
import random
import re
import time

import numpy as np
import pytest

from lodestar.llm import pii

KIND = "doc_id long, text string, spans string, kind string, start long"
PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub("[^0-9]", "", m)) <= 19 and checksum(m)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def checksum(m):
    total = 0
    for i, c in enumerate(reversed(re.sub("[^0-9]", "", m))):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    return sorted(((m.start(), list(PLAIN).index(k), m.end(), k) for k, (p, good) in PLAIN.items()
                   for m in re.finditer(p, text) if good(m.group())))


def base(text):
    return [(a, k - 1, b, pii.KINDS[k - 1]) for a, b, k in pii.matches(text) if k > 0]


def card(rng, n=16):
    stem = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return next(stem + c for c in "0123456789" if checksum(stem + c))


def phone(rng):
    return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"


def test_patterns_match_plain_ones():
    rng = random.Random(2)
    pieces = ["a@b.c", "x.y@z", "@", "é", " ", " ", "-", ".", "+", "1.2.3.4", "256.1.1.1", "12", "4", "(", ")",
              "+49 30 1234567", card(rng), card(rng, 14), "\n", "9" * 21, "a-b%c", "00.0.00.000"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert base(text) == plain(text), text


@pytest.mark.parametrize("unit", ["1", "1.", "a", "a@", "+1", "1-", "a.b@c.", "+", "é1", "((((1"])
def test_long_texts_take_linear_time(unit):
    began = time.time()
    text = unit * (2_000_000 // len(unit))
    pii.matches(text)
    sum(1 for _ in pii.tokens(text))
    assert time.time() - began < 20


def exact(f, w):
    n = len(f)
    total, marginal = 0.0, np.zeros((n, 5))
    own = pii._bits(np.array(f.shape, np.int64)) @ w["shape"]
    for labels in itertools.product(range(5), repeat=n):
        if any(f.label[i] > 0 and labels[i] != f.label[i] for i in range(n)):
            continue
        s = sum(own[i, x] for i, x in enumerate(labels))
        s += sum(w["chain"][labels[f.prev[i]], labels[i]] for i in range(n) if f.prev[i] >= 0)
        s += sum(w["skip"][labels[f.back[i]], labels[i]] for i in range(n) if f.back[i] >= 0)
        total += np.exp(s)
        for i, x in enumerate(labels):
            marginal[i, x] += np.exp(s)
    return marginal / total


def test_message_passing_on_trees_is_exact():
    rng = np.random.default_rng(0)
    w = {"shape": rng.normal(0, .5, (pii.N_SHAPES, 5)), "chain": rng.normal(0, 1, (5, 5)),
         "skip": np.eye(5) * 1.5}
    f = pii.Field()
    f.add("+1 (269) 555-3296 x 4.0 y 269-555-3296", [(0, 2, pii.PHONE)])
    assert f.prev == [-1, 0, 1, -1, -1] and f.back == [-1, -1, -1, -1, 2]
    assert np.allclose(pii.marginals(f, w, rounds=200, close=1e-9), exact(f, w), atol=1e-6)


def test_message_passing_with_loops_is_near_and_consistent():
    w = {"shape": np.zeros((pii.N_SHAPES, 5)), "chain": np.eye(5) * .5, "skip": np.eye(5) * 1.5}
    f = pii.Field()
    f.add("1112223 4445556 x 1112223 4445556 y 1112223", [(0, 7, pii.PHONE)])
    assert f.back == [-1, -1, 0, 1, 2] and f.prev == [-1, 0, -1, 2, -1]
    p = pii.marginals(f, w)
    assert np.abs(p - exact(f, w)).max() < .05
    assert (p[:, pii.PHONE] > .25).all() and (p.argmax(1) == pii.PHONE).all()


def corpus(rng, n=400):
    """Texts of base spans and bare numbers, with what a reader would add."""
    rows = []
    for _ in range(n):
        said = [rng.choice(["one", "and", "the", "é", "v2", "3.", "2024", "4.0", "id7", "12345"]) for _ in range(12)]
        at = rng.randrange(3, 9)
        said[at - 1] = said[at + 1] = "the"  # else a number beside it may hide it from the patterns
        said[at] = rng.choice([phone(rng), card(rng), f"a{rng.randint(1, 99)}@mail.example.com", "10.1.22.3"])
        rows.append(" ".join(said))
    return rows


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(8)
    p, c = phone(rng), card(rng)
    texts = corpus(rng) + [
        f"call {p} {c} now", f"first {p} then, far off, {p[3:]} again",
        f"cards {card(rng)} {card(rng)} both", "version 12345678901234567890123 of 2024", "", None, " \n",
        "x" * 50_000 + " 7 " * 20_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, f"call {p}"), (3, f"mail {c}"), (3, f"mail {c}")]
    df = spark.createDataFrame([(*r, "s", "k", 1) for r in rows], KIND).repartition(3)
    out = {}
    for r in pii.find(df).collect():
        out.setdefault(r["doc_id"], []).append([(s["start"], s["kind"], s["end"], s["base"]) for s in r["spans"]])
    return rows, out


def test_base_spans_stay_and_ordinary_texts_get_nothing_else(found):
    rows, out = found
    assert sum(len(x) for x in out.values()) == len(rows)
    for i, text in rows[:400]:
        want = [(a, k, b, True) for a, _, b, k in plain(text)]
        assert want in out[i]
    for i, text in rows[403:408]:
        assert out[i] == [[]], text
    assert [s[1] for s in out[None][0]] == ["phone"]


def test_added_spans(found):
    rows, out = found

    def added(i):
        return [(k, rows[i][1][a:b]) for a, k, b, given in out[i][0] if not given]

    both = rows[400][1].split(" ")
    assert added(400) == [("phone", " ".join(both[1:4])), ("card", both[4])]   # run together
    assert ("phone", rows[401][1].split("off, ")[1][:14]) in added(401)        # a distant mention
    assert added(402) == [("card", x) for x in rows[402][1].split(" ")[1:3]]


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "call 555-3296", "", "", 0)], KIND)
    assert [r["spans"] for r in pii.find(df).collect()] == [[]]
    assert pii.find(df.limit(0)).collect() == []
