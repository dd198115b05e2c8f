"""Packing documents along a space-filling curve.

Each document is tokenised once. Its token counts are hashed into a signed
vector, projected to a few dimensions and placed on a Hilbert curve; documents
are range-sorted by that key, and every range is packed in order, documents
being cut where a sequence is full. Only the last sequence of a range is not
full, so padding is at most one sequence per shuffle partition, and neighbours
in a sequence are similar documents. Equal keys (copies) are spread over
ranges by a hash of the id, so no group of copies fills a partition alone.

The tokenised table is written once to the shared folder: sampling the ranges
and a lost executor re-read ids instead of tokenising again.

Token ids are those of the given byte-level BPE file. Words are cut with that
tokenizer's pattern on code-point classes, ids of a word are kept in a bounded
cache, and only words not in it are encoded; a text that spells a special
token goes through the tokenizer itself.

Defined results: a null or empty text is the end id alone; null ids, repeated
rows and equal keys are ordinary; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.arrays import U, mixed, span_hashes
from lodestar.llm.tables import stored

SEQUENCE = 2048
END_ID = 1
DIMS, BITS, HASHED = 4, 10, 64
CHUNK_CHARS = 1 << 20
CACHE_WORDS = 400_000

TOKENS = "doc_id long, n_tokens long, curve long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")

# Code points with the White_Space property.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


class WordTokenizer:
    """Ids of many texts at once, equal to the tokenizer file's own."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._word = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary
        self._whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self._whole.get_added_tokens_decoder().values()]
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        kind = np.full(0x110000, 3, np.uint8)
        for value, cls in ((1, r"\p{L}+"), (2, r"\p{N}+")):
            for m in regex.finditer(cls, every):
                a, b = ord(every[m.start()]), ord(every[m.end() - 1])
                kind[a:b + 1] = value
        kind[0xD800:0xE000] = 3
        kind[WHITE_SPACE] = 0
        self._kind = kind
        self._clear()

    def _clear(self) -> None:
        self._at: dict[int, int] = {}
        self._off, self._len = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self._flat, self._used = [np.zeros(0, np.int64)], 0

    def cuts(self, cp: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Starts of the words in joined texts given as code points."""
        n, kind = len(cp), self._kind[cp]
        new = np.zeros(n + 1, bool)
        new[ends] = True
        doc = new[:n].copy()  # a document starts here
        doc[0] = True
        run = doc.copy()
        run[1:] |= kind[1:] != kind[:-1]
        start = run.copy()
        # the last white space before other text stands alone or joins it
        after = np.flatnonzero(run[1:] & ~doc[1:] & (kind[:-1] == 0)) + 1
        start[after - 1] = True
        joined = after[cp[after - 1] == 32]
        start[joined] = False
        # contractions: a lone ' that starts a word takes a few letters along
        quote = np.flatnonzero((cp == 39) & start & run)
        quote = quote[quote + 1 < n]
        for i in quote[run[quote + 1] & ~doc[quote + 1] & (kind[quote + 1] == 1)].tolist():
            a = chr(cp[i + 1])
            b = chr(cp[i + 2]) if i + 2 < n and not doc[i + 2] else ""
            k = 1 if a in "stmd" else 2 if a + b in ("re", "ve", "ll") else 0
            if k:
                start[i + 1] = False
                if i + 1 + k < n:
                    start[i + 1 + k] = True
        return np.flatnonzero(start)

    def _learn(self, hashes: list[int], pieces: list[str]) -> None:
        ids = [self._word(p) for p in pieces]
        lens = np.array([len(x) for x in ids], np.int64)
        base = len(self._at)
        for j, h in enumerate(hashes):
            self._at[h] = base + j
        self._off.append(self._used + np.cumsum(lens) - lens)
        self._len.append(lens)
        self._flat.append(np.fromiter((i for x in ids for i in x), np.int64, int(lens.sum())))
        self._used += int(lens.sum())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ends): without special ids added."""
        joined = "".join(texts)
        ends = np.cumsum([len(t) for t in texts])
        if not joined:
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        s = self.cuts(cp, ends)
        e = np.append(s[1:], len(cp))
        h, first, inv = np.unique(span_hashes(mixed(cp.astype(np.uint64) + U(1)), s, e),
                                  return_index=True, return_inverse=True)
        if len(self._at) + len(h) > CACHE_WORDS:
            self._clear()
        keys = h.tolist()
        miss = [j for j, k in enumerate(keys) if k not in self._at]
        if miss:
            self._learn([keys[j] for j in miss],
                        [joined[s[first[j]]:e[first[j]]] for j in miss])
            self._off = [np.concatenate(self._off)]
            self._len = [np.concatenate(self._len)]
            self._flat = [np.concatenate(self._flat)]
        at = np.fromiter((self._at[k] for k in keys), np.int64, len(keys))[inv]
        lens = self._len[0][at]
        stop = np.cumsum(lens)
        ids = self._flat[0][np.repeat(self._off[0][at] - (stop - lens), lens) + np.arange(stop[-1])]
        return ids, np.concatenate([[0], stop])[np.searchsorted(s, ends)]

    def encode_whole(self, text: str) -> list[int]:
        return self._whole.encode(text, add_special_tokens=False).ids


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows; all coordinates
    below 2**bits), by Skilling's transposed form."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            t = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed document vectors: unit length, projected to
    ``DIMS`` dimensions by fixed random directions, then cut into a grid."""
    rng = np.random.default_rng(17)
    ways = rng.standard_normal((vectors.shape[1], DIMS)) / np.sqrt(vectors.shape[1])
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    place = vectors / np.where(size == 0, 1, size) @ ways * np.sqrt(vectors.shape[1])
    cell = (np.tanh(place) + 1) / 2 * (1 << BITS)
    return hilbert_key(np.clip(cell.astype(np.int64), 0, (1 << BITS) - 1))


def _tokenise(paths: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = WordTokenizer(*paths)
        slot = (mixed(np.arange(1 << 17, dtype=np.uint64) + U(99)) % U(2 * HASHED)).astype(np.int64)
        for batch in batches:
            ids_col, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size < CHUNK_CHARS):
                    size += len(texts[hi] or "")
                    hi += 1
                part = [t or "" for t in texts[lo:hi]]
                odd = {i for i, t in enumerate(part) if any(x in t for x in tok.special)}
                flat, ends = tok.encode(["" if i in odd else t for i, t in enumerate(part)])
                each = [flat[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]
                for i in odd:
                    each[i] = np.array(tok.encode_whole(part[i]), np.int64)
                each = [np.append(x, END_ID) for x in each]
                counts = np.stack([np.bincount(slot[x], minlength=2 * HASHED) for x in each])
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids_col[lo:hi], pa.int64()),
                    pa.array([len(x) for x in each], pa.int64()),
                    pa.array(curve_keys((counts[:, :HASHED] - counts[:, HASHED:]).astype(float))),
                    pa.array([x.astype("<u2").tobytes() for x in each], pa.binary())],
                    names=["doc_id", "n_tokens", "curve", "ids"])
                lo = hi
    return run


def _pack(sequence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, used = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = np.frombuffer(blob.as_buffer(), "<u2").astype("<u4")
                at = 0
                while at < len(ids):
                    take = min(sequence - used, len(ids) - at)
                    row = (doc, at, take, zlib.crc32(ids[at:at + take]), len(ids), number, used)
                    for col, v in zip(out, row):
                        col.append(v)
                    at, used = at + take, used + take
                    if used == sequence:
                        number, used = number + 1, 0
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=[
                c.split()[0] for c in PIECES.split(", ")])
    return run


def pack(docs: DataFrame, json_path: str, ranks_path: str, pattern: str,
         sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece of a document (doc_id, text) in a sequence."""
    paths = (os.fspath(json_path), os.fspath(ranks_path), pattern)
    tokens = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                    .mapInArrow(_tokenise(paths), TOKENS), "tokens")
    spread = F.xxhash64("doc_id", "n_tokens")
    ordered = (tokens.withColumn("spread", spread).repartitionByRange("curve", "spread")
               .sortWithinPartitions("curve", "spread").select("doc_id", "ids"))
    return ordered.mapInArrow(_pack(sequence), PIECES)
