"""Language identification with hyperdimensional profiles.

Each code point has a fixed random vector of +1 and -1 components. A letter
trigram is the product of its letters' vectors, each rotated by its place; a
document's profile is the sum of the vectors of all its trigrams (runs of
other characters count as one boundary letter). A language's prototype is the
sum of the unit profiles of its training documents, and a document gets the
language whose prototype has the largest cosine with its profile; the score is
that cosine, or 0 if it is negative.

Training reads at most about ``train_per_lang`` documents of each language
(chosen by a hash of the id), a bound on the fit alone; predictions read every
whole text. Each task sends one vector per language and chunk to the fit, and
the driver holds one vector per language, 4 bytes x ``DIMS`` each.

Defined results: a null text, or one without letters, is ``und`` with score 0;
equal cosines go to the first language by name; rows with a null id are never
held out; without training documents every prediction is ``und``; repeated
rows are predicted alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.arrays import U, mixed
from lodestar.llm.tables import uniform

DIMS = 512
TRAIN_PER_LANG = 5000
FOLDS = 5
CHUNK_CHARS = 1 << 20
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


class Profiles:
    """Profiles of many texts at once."""

    def __init__(self, dims: int = DIMS):
        self.dims = dims
        letters = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.bool_).copy()
        self._letter = letters
        self._place = np.zeros(0x110000, np.int64)

    def _vectors(self, points: np.ndarray) -> np.ndarray:
        """+1/-1 rows for code points, the same on every worker."""
        blocks = np.arange(self.dims // 64, dtype=np.uint64)
        bits = mixed(mixed(points.astype(np.uint64) + U(7))[:, None] + blocks[None, :])
        return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(profiles, number of letters) of the texts."""
        low = [f" {t.lower()} " if t else "  " for t in texts]
        sizes = np.array([len(t) for t in low])
        cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self._letter[cp]
        doc = np.repeat(np.arange(len(texts)), sizes)
        n_letters = np.bincount(doc[letter], minlength=len(texts))
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[np.cumsum(sizes) - sizes] = True
        sym = np.where(letter, cp, 0)[keep]
        doc = doc[keep]

        seen = np.zeros(0x110000, bool)
        seen[sym] = True
        alphabet = np.flatnonzero(seen)
        self._place[alphabet] = np.arange(len(alphabet))
        s, k = self._place[sym], len(alphabet)
        whole = doc[:-2] == doc[2:]
        code = ((s[:-2] * k + s[1:-1]) * k + s[2:])[whole]
        doc = doc[:-2][whole]
        if k ** 3 <= 1 << 22:
            seen = np.zeros(k ** 3, bool)
            seen[code] = True
            grams = np.flatnonzero(seen)
            place = np.zeros(k ** 3, np.int64)
            place[grams] = np.arange(len(grams))
            at = place[code]
        else:
            grams, at = np.unique(code, return_inverse=True)
        base = self._vectors(alphabet)
        turned = [np.roll(base, r, axis=1) for r in (2, 1, 0)]
        out = np.zeros((len(texts), self.dims), np.float32)
        if len(grams):
            bound = (turned[0][grams // (k * k)] * turned[1][grams // k % k]
                     * turned[2][grams % k]).astype(np.float32)
            step = max(1, (1 << 22) // len(grams))
            edges = np.searchsorted(doc, np.arange(0, len(texts) + step, step))
            for i, lo in enumerate(range(0, len(texts), step)):
                rows = min(step, len(texts) - lo)
                part = slice(edges[i], edges[i + 1])
                counts = np.bincount((doc[part] - lo) * len(grams) + at[part],
                                     minlength=rows * len(grams))
                out[lo:lo + rows] = counts.reshape(rows, -1).astype(np.float32) @ bound
        return out, n_letters


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size == 0, 1, size)


def _pieces(texts: list[str | None]) -> Iterator[slice]:
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size < CHUNK_CHARS):
            size += len(texts[hi] or "")
            hi += 1
        yield slice(lo, hi)
        lo = hi


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    profiles = Profiles()
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for part in _pieces(texts):
            unit, names = _unit(profiles.of(texts[part])[0]), np.array(langs[part], object)
            found = sorted(set(langs[part]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()),
                 pa.array([unit[names == g].sum(0).astype("<f8").tobytes() for g in found],
                          pa.binary())], names=["lang", "vec"])


def _bundle(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    total = sum((np.frombuffer(v, "<f8") for v in t["vec"].to_pylist()), np.zeros(DIMS))
    return pa.table({"lang": [key[0].as_py()], "vec": pa.array([total.tobytes()], pa.binary())})


def fit(train: DataFrame, train_per_lang: int = TRAIN_PER_LANG) -> dict[str, np.ndarray]:
    """Prototype of each language from (doc_id, text, lang)."""
    rows = train.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # one number per language, as later one vector: texts are not shuffled
    shares = [F.lit(x) for r in rows.groupBy("lang").count().collect()
              for x in (r["lang"], float(train_per_lang) / r["count"])]
    if not shares:
        return {}
    chosen = (rows.where(F.coalesce(uniform(F.col("doc_id")), F.lit(0.0))
                         < F.try_element_at(F.create_map(*shares), F.col("lang")))
              .select("text", "lang"))
    sums = chosen.mapInArrow(_sums, "lang string, vec binary")
    return {r["lang"]: np.frombuffer(r["vec"], "<f8") for r in
            sums.groupBy("lang").applyInArrow(_bundle, "lang string, vec binary").collect()}


def _label(names: list[str], prototypes: np.ndarray, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lang, score = [], []
            for part in _pieces(texts):
                p, letters = profiles.of(texts[part])
                if names:
                    cos = _unit(p.astype(float)) @ prototypes.T
                    best, top = cos.argmax(1), np.clip(cos.max(1), 0.0, 1.0)
                else:
                    best, top, letters = np.zeros(len(p), int), np.zeros(len(p)), letters * 0
                lang += [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), letters)]
                score += np.where(letters > 0, top, 0.0).tolist()
            kept = [f for f in batch.schema.names if with_text or f != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f) for f in kept), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                names=[*kept, "lang_pred", "score"])
    return run


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], *keep: Column | str,
            with_text: bool = False) -> DataFrame:
    """(*keep, lang_pred, score) per row of ``docs`` (text), and the text if
    asked for."""
    names = sorted(prototypes)
    matrix = _unit(np.stack([prototypes[n] for n in names])) if names else np.zeros((0, DIMS))
    d = docs.select(*keep, "text")
    shown = d.schema.fields if with_text else d.schema.fields[:-1]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in shown)
    return d.mapInArrow(_label(names, matrix, with_text),
                        f"{fields}, lang_pred string, score double")


def identify(docs: DataFrame, train_per_lang: int = TRAIN_PER_LANG) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of (doc_id, text, lang);
    only documents outside the held-out fold are learned from."""
    d = docs.select("doc_id", "text", "lang")
    prototypes = fit(d.where(~held_out(F.col("doc_id"))), train_per_lang)
    return predict(d, prototypes, "doc_id", held_out(F.col("doc_id")).alias("held_out"))
