"""N-gram Jaccard self-join with signature trees.

A document's set holds its distinct shingles of ``SHINGLE`` words, as 64-bit
hashes, and has a 128-bit name; equal sets are one class, whatever rows have
it. Two sets with Jaccard >= t each miss at most ``m = n - ceil(t n)`` shingles
of the other. So a set with more than m shingles that stand in no other set
cannot be linked; this is judged on a slice of the shingles, those with a low
hash, and on all of them for the few sets that have at most m in the slice.
Blocks of documents send these to buckets once; what comes back is how many of
a set's shingles stand alone, so neither texts nor a filter of all shingles go
round, whatever the size of the input.

Among the sets that are left, one of each class, the slice comes first and
rare shingles come first in one global order, and two sets that are linked
share one of the first m + 1 in it. Sets under one shingle are tied to its
first one, per size class, instead of paired; the components of these ties
bound where links can be. Inside each, sets are compared through signature
trees (``sigtree``), which find a link between any two similar sets that are
not connected yet. Components of the links are the groups.

A component of ties beyond ``BLOCK_ITEMS`` shingles or ``BLOCK_SETS`` sets is
cut into blocks by size class and hash, and pairs of blocks with near sizes
are compared, so no task holds more than two blocks however large a group of
copies is. A tied class sends its shingles once for every block of documents
that holds it; texts are not sent again.

Defined results: a text without words, or null, has an empty set and is
linked with nothing (component: its id); with fewer words than a shingle the
whole sequence is one; every row is compared by its own text, rows without an
id too, which have the smallest id of their group, or null if no row of it has
one; an id that several texts share connects them, so all of them have the
smallest id that any of them reaches; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.arrays import U, chunks, mixed, rolled, words
from lodestar.llm.graph import components
from lodestar.llm.sigtree import links
from lodestar.llm.substrings import _columns, _planes
from lodestar.llm.tables import checkpointed

SHINGLE = 5
PERCENT = 80
SLICE = 410  # of 1,024 hashes; has to hold clearly more than 100 - PERCENT of 100
KEY_BITS = 40
BLOCK_BYTES = 1 << 24
GROUP_ITEMS = 1 << 21
PIECE_ITEMS = 1 << 19
HELD_ITEMS = 1 << 22
PART_SETS = 4096
REST = 64
BLOCK_SETS = 2048
BLOCK_ITEMS = 1 << 18

NAMES = "n_shingles long, s1 long, s2 long"
SETS = "s1 long, s2 long, codes binary"
KEYS = "bucket long, block long, entries binary"
FOUND = "kind int, block long, entries binary, runs binary"
PASSED = "node long, s1 long, s2 long, n long, alone long, rest long"
COUNTS = "part int, entries binary"
TIES = "u long, v long"


def shingle_sets(data: np.ndarray, ends: np.ndarray, shingle: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows, end of each row's)."""
    h, _, _, first = words(data, ends, lower=True)
    n_words = np.diff(first)
    n = len(h) - shingle + 1
    row = np.repeat(np.arange(len(ends)), n_words)
    if n > 0:
        whole = np.flatnonzero(row[:n] == row[shingle - 1:])
        codes, rows = mixed(rolled(h, shingle, 0x9E3779B97F4A7C15)[whole]), row[whole]
    else:
        codes, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((n_words > 0) & (n_words < shingle))
    if len(few):
        extra = []
        for i in few.tolist():
            w = h[first[i]:first[i + 1]]
            extra.append(mixed(rolled(w, len(w), 0x9E3779B97F4A7C15) + U(len(w)))[0])
        codes, rows = np.append(codes, np.array(extra, np.uint64)), np.append(rows, few)
    order = np.lexsort((codes, rows))
    codes, rows = codes[order], rows[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1])
    return codes[new], np.cumsum(np.bincount(rows[new], minlength=len(ends)))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])]


def _names(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set."""
    return (_sums(mixed(codes + U(3)), ends).view(np.int64),
            _sums(mixed(codes ^ U(0xA5A5A5A5A5A5A5A5)), ends).view(np.int64))


def _describe(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [f for f in batch.schema.names if f != "text"]
            for rows, data, ends in chunks(batch, "text"):
                codes, stop = shingle_sets(data, ends, shingle)
                s1, s2 = _names(codes, stop)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f).slice(rows.start, rows.stop - rows.start) for f in kept),
                     pa.array(np.diff(stop, prepend=0).astype(np.int64)), pa.array(s1),
                     pa.array(s2)], names=[*kept, "n_shingles", "s1", "s2"])
    return run


def _size_class(n: np.ndarray, percent: int) -> np.ndarray:
    """Sets whose sizes may be linked are at most one class apart."""
    return np.floor(np.log(np.maximum(n, 1)) / -np.log(percent / 100) + 1e-9).astype(np.int32)


def _misses(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles a set of n can have that a similar one has not."""
    return n + (-percent * n) // 100


def _unknown(s1: np.ndarray, s2: np.ndarray, among: np.ndarray, known: set) -> np.ndarray:
    """Which of the rows ``among`` have a set that is not in ``known``; adds them."""
    fresh = np.zeros(len(s1), bool)
    for i in np.flatnonzero(among).tolist():
        name = int(s1[i]), int(s2[i])
        fresh[i] = name not in known
        known.add(name)
    return fresh


def _keys(shingle: int, percent: int, buckets: int):
    """Per block and bucket the keys of its different sets, rising, with
    2 x the place of the set in the block, plus 1 beyond the slice; under a
    bucket of its own (below 0) the names and sizes of a block's sets."""
    def flush(block, held, names):
        key, place = (np.concatenate(x) for x in zip(*held))
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        edges = np.searchsorted(key * U(buckets) >> U(KEY_BITS), np.arange(buckets + 1, dtype=np.uint64))
        made = [(b, _planes(np.diff(key[x:y], prepend=U(0)), place[x:y]))
                for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
        made.append((-1 - block, _planes(*(np.concatenate(x) for x in zip(*names)))))
        for lo in range(0, len(made), 256):
            b, blobs = zip(*made[lo:lo + 256])
            yield pa.RecordBatch.from_arrays(
                [pa.array(b, pa.int64()), pa.array([block] * len(b), pa.int64()),
                 pa.array(blobs, pa.binary())], names=["bucket", "block", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 12
        size, held, names, known = 0, [], [], set()
        for batch in batches:
            for _, data, ends in chunks(batch, "text"):
                codes, stop = shingle_sets(data, ends, shingle)
                n = np.diff(stop, prepend=0).astype(np.int64)
                s1, s2 = _names(codes, stop)
                place = len(known)
                fresh = _unknown(s1, s2, n > 0, known)
                place += np.cumsum(fresh) - 1
                row = np.repeat(np.arange(len(n)), n)
                low = (codes & U(1023)) < U(SLICE)
                few = np.bincount(row[low], minlength=len(n)) <= _misses(n, percent)
                use = fresh[row] & (low | few[row])
                held.append((codes[use] >> U(64 - KEY_BITS),
                             (2 * place[row[use]] + ~low[use]).astype(np.uint32)))
                names.append((s1[fresh], s2[fresh], n[fresh]))
                size += len(data)
                if size >= BLOCK_BYTES:
                    yield from flush(block, held, names)
                    block += 1
                    size, held, names, known = 0, [], [], set()
        if held:
            yield from flush(block, held, names)
    return run


def _node(block: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (block << 26) + place


def _shared(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a bucket: the places whose keys stand in one set alone, by block
    (kind 1), and the sets of every other key, key by key (kind 2). Names of
    blocks pass (kind 0)."""
    def rows(kind, blocks, entries, runs):
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(blocks), pa.int32()), pa.array(blocks, pa.int64()),
             pa.array(entries, pa.binary()), pa.array(runs, pa.binary())],
            names=["kind", "block", "entries", "runs"])

    parts = []
    for batch in batches:
        blocks, blobs = batch.column("block").to_pylist(), batch.column("entries").to_pylist()
        if key[0].as_py() < 0:
            yield rows(0, blocks, blobs, [None] * len(blocks))
            continue
        for block, blob in zip(blocks, blobs):
            gaps, place = _columns(blob, "<u8", "<u4")
            parts.append((np.cumsum(gaps, dtype=np.uint64), place, np.full(len(place), block, np.int64)))
    if not parts:
        return
    keys, place, block = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.argsort(keys, kind="stable")
    keys, place, block = keys[order], place[order], block[order]
    head = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    count = np.diff(head, append=len(keys))

    at = head[count == 1]
    at = at[np.lexsort((place[at], block[at]))]
    first = np.flatnonzero(np.diff(block[at], prepend=-1))
    made = [(int(block[at[x]]), _planes(np.diff(place[at[x:y]], prepend=np.uint32(0))))
            for x, y in zip(first, np.append(first[1:], len(at)))]
    for lo in range(0, len(made), 256):
        blocks, blobs = zip(*made[lo:lo + 256])
        yield rows(1, blocks, blobs, [None] * len(blocks))

    many = np.repeat(count > 1, count)
    runs, sets = count[count > 1].astype(np.uint32), 2 * _node(block[many], place[many] >> 1) + (place[many] & 1)
    stop = np.cumsum(runs)
    lo = 0
    while lo < len(runs):
        done = stop[lo] - runs[lo]
        hi = max(lo + 1, int(np.searchsorted(stop, done + PIECE_ITEMS, "right")))
        yield rows(2, [key[0].as_py()], [_planes(sets[done:stop[hi - 1]])], [_planes(runs[lo:hi])])
        lo = hi


def _passing(percent: int):
    """The sets of a block that can be linked, with how many of their keys
    stand alone, in the slice and beyond it."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = []
        for batch in batches:
            for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("entries").to_pylist()):
                if kind == 0:
                    s1, s2, n = _columns(blob, "<i8", "<i8", "<i8")
                else:
                    places.append(np.cumsum(_columns(blob, "<u4")[0], dtype=np.int64))
        count = sum((np.bincount(p, minlength=2 * len(n)) for p in places), np.zeros(2 * len(n), np.int64))
        alone, rest = count[::2], count[1::2]
        at = np.flatnonzero(alone <= _misses(n, percent))
        for lo in range(0, len(at), 65536):
            x = at[lo:lo + 65536]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (_node(key[0].as_py(), x), s1[x], s2[x], n[x], alone[x], rest[x])],
                names=["node", "s1", "s2", "n", "alone", "rest"])
    return run


def _held(batch: pa.RecordBatch, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries of kind 2 whose sets are in ``nodes`` (rising): (index in
    ``nodes``, level of the key, number of the key). Levels rise with the
    number of these sets under a key; REST is added beyond the slice."""
    for entries, runs in zip(batch.column("entries"), batch.column("runs")):
        sets, = _columns(entries.as_py(), "<i8")
        length, = _columns(runs.as_py(), "<u4")
        at = np.searchsorted(nodes, sets >> 1)
        at[at == len(nodes)] = 0
        have = nodes[at] == sets >> 1 if len(nodes) else np.zeros(len(sets), bool)
        number = np.repeat(np.arange(len(length)), length)[have]
        count = np.bincount(number, minlength=len(length))[number]
        level = np.where(count <= 16, count - 1, 15 + np.ceil(np.log2(np.maximum(count, 16) / 16)).astype(np.int64))
        yield at[have], level + REST * (sets[have] & 1), number


def _counts(sets):
    """How many keys of each level each set has, by parts of the sets."""
    def flush(held):
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        part = pair // (PART_SETS * 2 * REST)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        made = [(part[x], _planes(np.diff(pair[x:y], prepend=0), n[x:y].astype(np.uint32)))
                for x, y in zip(first, np.append(first[1:], len(part)))]
        for lo in range(0, len(made), 256):
            parts, blobs = zip(*made[lo:lo + 256])
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())],
                                             names=["part", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, held, size = sets.value[0], [], 0
        for batch in batches:
            for at, level, _ in _held(batch, nodes):
                held.append(at * (2 * REST) + level)
                size += len(at)
                if size >= HELD_ITEMS:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)
    return run


def _lasts(sets, percent: int):
    """Per part of the sets the level that holds the last of each set's first
    shingles; -1 for sets that cannot be linked with any of the others."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = key[0].as_py()
        here = slice(part * PART_SETS, (part + 1) * PART_SETS)
        n, alone, rest = (x[here] for x in sets.value[1:])
        count = np.zeros(PART_SETS * 2 * REST, np.int64)
        for batch in batches:
            for blob in batch.column("entries"):
                gaps, m = _columns(blob.as_py(), "<i8", "<u4")
                count[np.cumsum(gaps) - part * PART_SETS * 2 * REST] += m
        count = count.reshape(PART_SETS, -1)[:len(n)]
        count[:, 0] += alone
        count[:, REST] += rest
        most = _misses(n, percent)
        last = (np.cumsum(count, 1) > most[:, None]).argmax(1)
        last[count[:, 0] > most] = -1
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([last.astype(np.int8).tobytes()], pa.binary())],
            names=["part", "entries"])
    return run


def _ties(sets, lasts, percent: int):
    """Under one key that is among the first ones of its sets, each size class
    to its first set, and the first sets of neighbouring classes to each other."""
    def tied(at, key, cls):
        order = np.lexsort((at, cls, key))
        key, at, cls = key[order], at[order], cls[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        head = np.flatnonzero(new)
        hub = at[head][np.cumsum(new) - 1]
        near = np.flatnonzero((key[head][1:] == key[head][:-1])
                              & (cls[head][1:] == cls[head][:-1] + 1))
        u = np.concatenate([at, at[head[near + 1]]])
        v = np.concatenate([hub, at[head[near]]])
        return np.unique(np.stack([u, v], 1)[u != v], axis=0)

    def flush(held, nodes):
        pairs = np.unique(np.concatenate(held), axis=0)
        for lo in range(0, len(pairs), 65536):
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[pairs[lo:lo + 65536, k]]) for k in (0, 1)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, n = sets.value[:2]
        last, cls, held, size = lasts.value, _size_class(n, percent), [], 0
        for batch in batches:
            for at, level, key in _held(batch, nodes):
                use = level <= last[at]
                held.append(tied(at[use], key[use], cls[at[use]]))
                size += len(held[-1])
                if size >= HELD_ITEMS:
                    yield from flush(held, nodes)
                    held, size = [], 0
        if size:
            yield from flush(held, nodes)
    return run


def _codes(names, shingle: int):
    """The shingles of the sets whose names begin with one of ``names``, once
    for a block of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, known = 0, set()
        for batch in batches:
            for _, data, ends in chunks(batch, "text"):
                codes, stop = shingle_sets(data, ends, shingle)
                s1, s2 = _names(codes, stop)
                at = np.searchsorted(names.value, s1)
                at[at == len(names.value)] = 0
                tied = names.value[at] == s1 if len(names.value) else np.zeros(len(s1), bool)
                at = np.flatnonzero(_unknown(s1, s2, tied, known))
                if len(at):
                    start = np.concatenate([[0], stop[:-1]])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s1[at]), pa.array(s2[at]),
                         pa.array([codes[a:b].tobytes() for a, b in zip(start[at], stop[at])], pa.binary())],
                        names=["s1", "s2", "codes"])
                size += len(data)
                if size >= BLOCK_BYTES:
                    size, known = 0, set()
    return run


def _compare(percent: int):
    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        left, right = (k.as_py() for k in key[1:])
        u, v = [], []
        nodes, blocks = t["node"].to_pylist(), t["block"].to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t["codes"]]
        # similar sets often share their smallest shingle: neighbours in leaves
        order = sorted(range(len(sets)), key=lambda i: (sets[i][0], len(sets[i])))
        a = [i for i in order if blocks[i] == left]
        b = None if left == right else [i for i in order if blocks[i] == right]
        if a and (b is None or b):
            for i, j in links([sets[i] for i in a], None if b is None else [sets[i] for i in b],
                              percent):
                u.append(nodes[a[i]])
                v.append(nodes[(a if b is None else b)[j]])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})
    return run


def groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
           keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, n_shingles, group) per row of ``docs`` (doc_id, text,
    *keep): a number for each set of texts that links connect; null for a text
    without words."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, "text")
    n_bytes = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    send = d.sparkSession.sparkContext.broadcast
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name != "text")
    rows = checkpointed(d.mapInArrow(_describe(shingle), f"{fields}, {NAMES}"))
    classes = checkpointed(rows.where("n_shingles > 0").groupBy("s1", "s2")
                           .agg(F.max("n_shingles").alias("n_shingles"))
                           .withColumn("node", F.monotonically_increasing_id()))

    # the sets that can be linked, and a tie between any two that can be with each other
    buckets = max(1, n_bytes // 5 * SLICE // 1024 // GROUP_ITEMS)
    keys = checkpointed(d.select("text").mapInArrow(_keys(shingle, percent, buckets), KEYS)
                        .groupBy("bucket").applyInArrow(_shared, FOUND))
    passed = checkpointed(keys.where("kind < 2").groupBy("block").applyInArrow(_passing(percent), PASSED)
                          .groupBy("s1", "s2").agg(F.min(F.struct("node", "n", "alone", "rest")).alias("x"))
                          .select("x.*", "s1", "s2"))
    keys = keys.where("kind = 2").select("entries", "runs")
    found = passed.select("node", "n", "alone", "rest").toArrow().sort_by("node")
    sets = send(tuple(c.to_numpy() for c in found.columns))
    last = np.full(len(found), -1, np.int8)
    for r in (keys.mapInArrow(_counts(sets), COUNTS).groupBy("part")
              .applyInArrow(_lasts(sets, percent), COUNTS).collect()):
        part = np.frombuffer(r["entries"], np.int8)
        last[r["part"] * PART_SETS:r["part"] * PART_SETS + len(part)] = part
    lasts = send(last)
    tied = checkpointed(components(keys.mapInArrow(_ties(sets, lasts, percent), TIES)).join(passed, "node")
                        .select("s1", "s2", F.col("component").alias("tie")))
    names = send(np.sort(tied.select("s1").toArrow()["s1"].to_numpy()))
    sets.unpersist()
    lasts.unpersist()
    shingles = (d.select("text").mapInArrow(_codes(names, shingle), SETS)
                .groupBy("s1", "s2").agg(F.any_value("codes").alias("codes")))

    # blocks of a component of ties, and the pairs of blocks with near sizes
    cls = F.floor(F.ln(F.greatest("n_shingles", F.lit(1))) / F.lit(-np.log(percent / 100))
                  + 1e-9).cast("int")
    sized = classes.join(tied, ["s1", "s2"]).withColumn("cls", cls)
    per = sized.groupBy("tie", "cls").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("items"))
    whole = per.groupBy("tie").agg(F.sum("n").alias("n_tie"), F.sum("items").alias("items_tie"))
    large = (F.col("n_tie") > BLOCK_SETS) | (F.col("items_tie") > BLOCK_ITEMS)
    per = (per.join(whole, "tie")
           .withColumn("cls2", F.when(large, F.col("cls")).otherwise(0))
           .withColumn("cut", F.when(large, F.greatest(F.ceil(F.col("n") / BLOCK_SETS),
                                                       F.ceil(F.col("items") / BLOCK_ITEMS)))
                       .otherwise(1)))
    placed = checkpointed(
        sized.join(per.select("tie", "cls", "cls2", "cut"), ["tie", "cls"])
        .select("node", "s1", "s2", "tie", "cls2", F.struct(
            "cls2", F.pmod(F.xxhash64("node"), F.col("cut")).alias("part")).alias("place")))
    blocks = placed.select("tie", "cls2", "place").distinct()
    other = blocks.select(F.col("tie").alias("_tie"), F.col("cls2").alias("_cls"),
                          F.col("place").alias("_place"))
    pairs = (blocks.join(other, (F.col("tie") == F.col("_tie"))
                         & (F.col("_cls") - F.col("cls2")).between(0, 1)
                         & (F.col("place") <= F.col("_place")))
             .select("tie", F.col("place").alias("left"), F.col("_place").alias("right")))
    ends = pairs.select("tie", "left", "right", F.explode(F.array_distinct(
        F.array("left", "right"))).alias("place"))
    work = placed.join(ends, ["tie", "place"]).select(
        "node", "s1", "s2", "tie", *[F.concat_ws("/", f"{c}.cls2", f"{c}.part").alias(c)
                                     for c in ("left", "right")],
        F.concat_ws("/", "place.cls2", "place.part").alias("block"))
    found = (work.join(shingles, ["s1", "s2"]).select("node", "tie", "left", "right", "block", "codes")
             .groupBy("tie", "left", "right").applyInArrow(_compare(percent), TIES))
    linked = components(found)
    names.unpersist()
    named = (classes.join(linked, "node", "left")
             .select("s1", "s2", F.coalesce("component", "node").alias("group")))
    return rows.join(named, ["s1", "s2"], "left").drop("s1", "s2")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text)."""
    rows = checkpointed(groups(docs, shingle, percent))
    # ids that stand for texts of several groups connect these
    shared = (rows.where("doc_id is not null and group is not null").groupBy("doc_id")
              .agg(F.min("group").alias("least"), F.max("group").alias("last")).where("least < last"))
    joined = components(rows.join(shared, "doc_id").where("group > least")
                        .select(F.col("group").alias("u"), F.col("least").alias("v")))
    rows = (rows.join(joined.withColumnRenamed("node", "group"), "group", "left")
            .withColumn("whole", F.coalesce("component", "group")))
    least = rows.where("whole is not null").groupBy("whole").agg(F.min("doc_id").alias("component_id"))
    return (rows.join(least, "whole", "left")
            .select("doc_id", "n_shingles", F.when(F.col("whole").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id")))
