"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans of four kinds (email, ip, card, phone). They miss
numbers that run together (a phone followed by a card is one match with too
many digits, and is dropped) and numbers written differently the second time.
The field labels every token that holds a digit or an ``@`` with one of the
kinds or with none:

* each token has features of its shape;
* tokens that only spaces part share a potential (the chain);
* a token shares a potential with the last one before it, at any distance,
  that is equal or has the same last seven digits (the skip edges; linking to
  the last occurrence only keeps them as many as the tokens).

Tokens of base spans are given; loopy message passing over all other tokens
of many documents at once gives each its marginals. Runs of one label that are
valid for their kind become added spans; base spans always stay.

The weights are fitted by pseudo-likelihood on the tokens of at most about
``sample_docs`` documents, labelled by the base spans; tokens of matches with
too many digits are left open there. Equal tokens in equal surroundings are
counted in Spark, and the driver gets the ``patterns`` most frequent counts.
Every document is then searched whole.

Defined results: a null or empty text has no spans; where no document has a
base span, none is added; an empty table gives an empty result; rows with the
same or no id are each searched; other columns are ignored. Patterns and
tokens are found in time linear in the text; the field takes about 1 kB a
token of the longest document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.tables import uniform

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = 1, 2, 3, 4  # labels; 0 is none, OPEN is not known
OPEN = -1
SAMPLE_DOCS = 20_000
PATTERNS = 20_000
FIELD_TOKENS = 50_000  # tokens of one round of message passing

FOUND = "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>"
COUNTED = "shape long, prev int, next int, back int, on int, label int, n long"

# The patterns of the kinds. Possessive parts and the look-behind change no
# match, they keep long runs of digits linear; the part of an email before its
# @ is found from the @ for the same reason.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TOKEN = _LOCAL | frozenset("@()")
_HIT = re.compile(r"[0-9@]")
_END = re.compile(r"[^A-Za-z0-9._%+@()-]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def digits(text: str) -> str:
    return _NO_DIGIT.sub("", text)


def luhn(number: str) -> bool:
    return sum((int(c) * (1 + i % 2) - 1) % 9 + 1 for i, c in enumerate(reversed(number)) if c != "0") % 10 == 0


def _octets(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    d = digits(text)
    return 14 <= len(d) <= 19 and luhn(d)


def _emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = at + 1  # nothing before this @ can belong to a later one
        at = text.find("@", at + 1)
    return out


def matches(text: str) -> list[tuple[int, int, int]]:
    """(start, end, label) of the base spans, by start and label; those of
    matches dropped for too many digits come with minus their label."""
    out = []
    if "@" in text:
        out += [(a, b, EMAIL) for a, b in _emails(text)]
    out += [(*m.span(), IP) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        if _is_card(m.group()):
            out.append((*m.span(), CARD))
        elif len(digits(m.group())) > 19:
            out.append((*m.span(), -CARD))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = len(digits(m.group()))
            if 10 <= n <= 15:
                out.append((*m.span(), PHONE))
            elif n > 15:
                out.append((*m.span(), -PHONE))
    return sorted(out, key=lambda s: (s[0], s[2]))


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """Runs of token characters with a digit or an @ among them."""
    at = 0
    while hit := _HIT.search(text, at):
        start = hit.start()
        while start > at and text[start - 1] in _TOKEN:
            start -= 1
        end = _END.search(text, hit.end())
        at = end.start() if end else len(text)
        yield start, at


# Numbers of digits that have a feature of their own: up to 1, 2, 3, 4, 6 ...
_SIZES = (1, 2, 3, 4, 6, 7, 9, 13, 19)
N_SHAPES = 11 + len(_SIZES) + 1


def shape(token: str) -> int:
    """The features of a token, one bit each."""
    d, core = digits(token), token.strip("._%-")
    letters = any(c.isalpha() for c in token)
    at = token.find("@")
    said = (True, at >= 0 and bool(_DOMAIN.match(token, at + 1)), at >= 0, token.startswith("+"),
            "(" in token or ")" in token, letters, core == d, "-" in core, "." in core,
            len(core) <= 15 and core.count(".") == 3 and core.replace(".", "") == d and _octets(core),
            14 <= len(d) <= 19 and luhn(d))
    size = sum(len(d) > s for s in _SIZES)
    return sum(1 << i for i, x in enumerate((*said, *(size == s for s in range(len(_SIZES) + 1)))) if x)


def _link(token: str) -> str | None:
    """What equal or similar tokens have in common; none for short ones."""
    if "@" in token:
        return token.lower()
    d = digits(token)
    return d[-7:] if len(d) >= 7 else None


class Field:
    """The tokens of some documents: their features, neighbours and labels."""

    def __init__(self):
        self.docs, self.start, self.end, self.shape = [], [], [], []
        self.prev, self.back, self.label = [], [], []

    def __len__(self) -> int:
        return len(self.start)

    def add(self, text: str, spans: list[tuple[int, int, int]]) -> None:
        first, last, seen = len(self), None, {}
        given = [[x for x in spans if x[2] == k] for k in (EMAIL, IP, CARD, PHONE, -CARD, -PHONE)]
        given = [x for x in given if x]
        reached = [0] * len(given)
        for a, b in tokens(text):
            label = 0
            for i, own in enumerate(given):  # spans of one kind follow each other
                while reached[i] < len(own) and own[reached[i]][1] <= a:
                    reached[i] += 1
                if not label and reached[i] < len(own) and own[reached[i]][0] < b:
                    label = max(own[reached[i]][2], OPEN)
            n, token = len(self), text[a:b]
            near = last is not None and 0 < a - last <= 3 and not text[last:a].strip(" ")
            self.prev.append(n - 1 if near else -1)
            key = _link(token)
            self.back.append(seen.get(key, -1) if key else -1)
            if key:
                seen[key] = n
            self.start.append(a)
            self.end.append(b)
            self.shape.append(shape(token))
            self.label.append(label)
            last = b
        self.docs.append((first, len(self)))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _bits(shapes: np.ndarray) -> np.ndarray:
    return (shapes[:, None] >> np.arange(N_SHAPES) & 1).astype(np.float64)


def fit(rows: list, steps: int = 400, rate: float = 0.1, decay: float = 1e-4) -> dict[str, np.ndarray] | None:
    """Weights of shapes, chain and skip edges by pseudo-likelihood, from
    counts of (shape, labels of the neighbours, label); drawn towards
    agreement along skip edges where the data are silent."""
    rows = [r for r in rows if r["label"] != OPEN]
    if not any(r["label"] for r in rows):
        return None
    x = _bits(np.array([r["shape"] for r in rows], np.int64))
    y, n = np.array([r["label"] for r in rows]), np.array([float(r["n"]) for r in rows])
    n /= n.sum()
    near = {}
    for c in ("prev", "next", "back", "on"):
        v = np.array([r[c] for r in rows])
        near[c] = (v[:, None] == np.arange(5)).astype(np.float64)  # a row of zeros: none, or open
    start = {"shape": np.zeros((N_SHAPES, 5)), "chain": np.zeros((5, 5)), "skip": np.eye(5) * 1.5}
    w = {k: v.copy() for k, v in start.items()}
    one, two = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    target = np.eye(5)[y]
    for step in range(1, steps + 1):
        skip = near["back"] + near["on"]
        p = _softmax(x @ w["shape"] + near["prev"] @ w["chain"] + near["next"] @ w["chain"].T + skip @ w["skip"])
        off = (p - target) * n[:, None]
        g = {"shape": x.T @ off, "chain": near["prev"].T @ off + off.T @ near["next"], "skip": skip.T @ off}
        g["skip"] = g["skip"] + g["skip"].T
        for k in w:
            d = g[k] + decay * (w[k] - start[k])
            one[k] = 0.9 * one[k] + 0.1 * d
            two[k] = 0.999 * two[k] + 0.001 * d * d
            w[k] -= rate * (one[k] / (1 - 0.9 ** step)) / (np.sqrt(two[k] / (1 - 0.999 ** step)) + 1e-9)
    return w


def marginals(f: Field, w: dict[str, np.ndarray], rounds: int = 50, damping: float = 0.5,
              close: float = 1e-3) -> np.ndarray:
    """Label probabilities of every token; tokens that have a label keep it."""
    label = np.array(f.label)
    own = _bits(np.array(f.shape, np.int64)) @ w["shape"]
    own[label > 0] = -1e3
    own[label > 0, label[label > 0]] = 0.0
    src, dst, pots, size = [], [], [], 0
    for x, pot in ((np.array(f.prev), w["chain"]), (np.array(f.back), w["skip"])):
        here = np.flatnonzero(x >= 0)
        src += [x[here], here]  # either way along each edge
        dst += [here, x[here]]
        pots += [(size, size + len(here), pot), (size + len(here), size + 2 * len(here), pot.T)]
        size += 2 * len(here)
    other = np.concatenate([np.arange(lo, hi) for i in (1, 0, 3, 2) for lo, hi, _ in [pots[i]]])
    src, dst = np.concatenate(src), np.concatenate(dst)
    message, belief = np.zeros((size, 5)), own
    for _ in range(rounds if size else 0):
        out, new = belief[src] - message[other], np.empty_like(message)
        for lo, hi, pot in pots:
            z = out[lo:hi, :, None] + pot  # by label of the sender, of the receiver
            top = z.max(1)
            new[lo:hi] = top + np.log(np.exp(z - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        new = damping * message + (1 - damping) * new
        moved, message = np.abs(new - message).max(), new
        belief = own.copy()
        np.add.at(belief, dst, message)
        if moved < close:
            break
    return _softmax(belief)


def _trim(text: str, start: int, end: int, kind: int) -> tuple[int, int]:
    opens = "+(0123456789" if kind == PHONE else "0123456789"
    while start < end and text[start] not in opens:
        start += 1
    while end > start and not text[end - 1].isdigit():
        end -= 1
    return start, end


def _valid(piece: str, kind: int, linked: bool) -> bool:
    if kind == CARD:
        return not piece.strip("0123456789 -") and _is_card(piece)
    if kind == PHONE:
        return not piece.strip("+0123456789 ().-") and (7 if linked else 10) <= len(digits(piece)) <= 15
    if kind == IP:
        return not piece.strip("0123456789.") and _octets(piece)
    return False  # whatever is a valid email is a base span


def added_spans(text: str, f: Field, first: int, last: int, label: np.ndarray) -> list[tuple[int, int, int]]:
    """Valid spans from runs of neighbouring tokens with one label, longest
    first from the left; given tokens belong to none."""
    out, i = [], first
    free = [f.label[j] <= 0 for j in range(first, last)]
    known = [f.label[j] == PHONE for j in range(first, last)]
    linked = [False] * (last - first)
    for j in range(first, last):
        if f.back[j] >= 0:
            linked[j - first] |= known[f.back[j] - first]
            linked[f.back[j] - first] |= known[j - first]
    while i < last:
        kind = int(label[i])
        if not kind or not free[i - first]:
            i += 1
            continue
        end = i + 1  # a run is short: no kind has more than 19 digits
        while end < last and end - i < 19 and f.prev[end] == end - 1 and label[end] == kind and free[end - first] \
                and not (kind == PHONE and text[f.start[end]] == "+"):
            end += 1
        for stop in range(end, i, -1):
            a, b = _trim(text, f.start[i], f.end[stop - 1], kind)
            if a < b and _valid(text[a:b], kind, any(linked[i - first:stop - first])):
                out.append((a, b, kind))
                i = stop
                break
        else:
            i += 1
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    for t in batch.column("text"):
        yield t.as_py() or ""


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in COUNTED.split(", ")]
    kinds = [pa.int64(), *[pa.int32()] * 5, pa.int64()]
    for batch in batches:
        counts = Counter()
        for text in _texts(batch):
            f = Field()
            f.add(text, matches(text))
            near = {"next": [OPEN] * len(f), "on": [OPEN] * len(f)}
            for i in range(len(f)):
                for way, ahead in (("prev", "next"), ("back", "on")):
                    j = getattr(f, way)[i]
                    if j >= 0:
                        near[ahead][j] = f.label[i]
            for i, label in enumerate(f.label):
                prev, back = (f.label[j] if j >= 0 else OPEN for j in (f.prev[i], f.back[i]))
                counts[f.shape[i], prev, near["next"][i], back, near["on"][i], label] += 1
        rows = [(*k, n) for k, n in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def _find(w: dict[str, np.ndarray] | None, least: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("spans", pa.list_(pa.struct([
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))])
        for batch in batches:
            spans, f, held = [], Field(), []

            def settle(f, held, spans):
                if not len(f):
                    return
                p = marginals(f, w)
                label = np.where(p.max(1) >= least, p.argmax(1), 0)
                for (row, text), (first, last) in zip(held, f.docs, strict=True):
                    spans[row] += [(a, b, k, False) for a, b, k in added_spans(text, f, first, last, label)]

            for row, text in enumerate(_texts(batch)):
                base = [x for x in matches(text) if x[2] > 0]
                spans.append([(a, b, k, True) for a, b, k in base])
                if w is not None:
                    f.add(text, base)
                    held.append((row, text))
                    if len(f) >= FIELD_TOKENS:
                        settle(f, held, spans)
                        f, held = Field(), []
            if w is not None:
                settle(f, held, spans)
            found = [[{"kind": KINDS[k - 1], "start": a, "end": b, "base": given}
                      for a, b, k, given in sorted(s, key=lambda x: (x[0], x[2]))] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind.field("spans").type)],
                                             ["doc_id", "spans"])
    return find


def find(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, patterns: int = PATTERNS,
         least: float = 0.5) -> DataFrame:
    """(doc_id, spans) for ``documents`` (doc_id, text); spans in code points,
    end exclusive, by start, then kind as listed in KINDS. An added span's
    tokens have their label with a probability of ``least``."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = docs.where(F.col("text").rlike("[0-9@]"))
    n = some.count()
    sample = some.where(uniform("doc_id", "text") < min(1.0, sample_docs / n)) if n else some
    rows = (sample.mapInArrow(_count, COUNTED).groupBy("shape", "prev", "next", "back", "on", "label")
            .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shape", "prev", "next", "back", "on", "label")
            .limit(patterns).collect())
    return docs.mapInArrow(_find(fit(rows), least), FOUND)
