"""Ranked lexical search over a document FP-tree.

The items (queries) are taken in blocks of bounded text, each block against
all documents. A document is reduced to its restricted vector: how often it
holds each term of the block. Counts over all documents give the weights.

Restricted vectors, terms in falling document frequency, share the paths of a
trie. A task builds one trie after another over its documents; a node keeps,
over its subtree, the largest tf of every term and the smallest m. Scores grow
with tf and fall with m, so these give a bound for each node, and an item
walks the trie depth first, best child first, leaving out subtrees whose bound
is under the item's k-th best score so far. That score is kept from trie to
trie. Runs of few documents are leaves, scored exactly; so is whatever lies
deeper than MAX_DEPTH, cut into leaves where it stands.

Each task gives k documents an item; the best k come from them by item and
group of tasks, then by item.

Score of a document: the sum over the item's terms, once each, of
``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
``m = 50 + (50 * n * N) div L``; N documents with a term, L their terms, n the
document's terms, all counted with repeats but N and df.

Defined results: a null or empty text has no terms, scores nothing and is not
counted; a document without an id takes part and comes last among equal
scores; documents that share an id are ranked each on its own; an item without
terms has no rows; items that share an id are each an item; long texts are
read in pieces cut between terms; empty tables give an empty result; other
columns are ignored. Integers are 64-bit: 50 * n * N has to fit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.tables import checkpointed, stored

# Bytes of a term: letters and digits of ASCII and all of other characters.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
NO_TERM = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

ITEM_BYTES = 4 << 20      # text of the items of one block
PIECE_BYTES = 1 << 20     # text split into terms at once
TREE_ENTRIES = 1 << 20    # (document, term) pairs of one trie
LEAF_DOCS = 32
MAX_DEPTH = 48
TASKS_PER_GROUP = 32

VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
HITS = "item long, item_id long, doc_id long, score long, part int"


def term_counts(text: bytes, vocabulary: dict[bytes, int]) -> tuple[int, Counter]:
    """(terms in all, how often each term of the vocabulary occurs)."""
    n, found, at = 0, Counter(), 0
    while at < len(text):
        cut = NO_TERM.search(text, min(len(text), at + PIECE_BYTES))
        end = cut.start() if cut else len(text)
        terms = TERM.findall(text[at:end].lower())
        n += len(terms)
        counts = Counter(terms)
        for t in counts.keys() & vocabulary.keys():
            found[vocabulary[t]] += counts[t]
        at = end
    return n, found


def _restricted(vocabulary: dict[bytes, int]):
    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text").cast(pa.large_binary()):
                n, found = term_counts(text.as_py() or b"", vocabulary)
                ns.append(n)
                terms += found.keys()
                tfs += found.values()
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))],
                ["doc_id", "n", "terms", "tfs"])
    return restrict


def impact(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _largest(keys: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
    """One entry per (key, term), with its largest tf."""
    order = np.lexsort((terms, keys))
    keys, terms, tfs = keys[order], terms[order], tfs[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(first)
    return keys[at], terms[at], np.maximum.reduceat(tfs, at) if len(at) else tfs


class Tree:
    """A trie over restricted vectors. ``terms`` of a document are numbers in
    falling document frequency; every document has one at least."""

    def __init__(self, ids, known, ms, starts, terms, tfs, weights, leaf: int = LEAF_DOCS,
                 max_depth: int = MAX_DEPTH):
        size = np.diff(starts)
        doc = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((terms, doc))
        terms, tfs = terms[order], tfs[order]
        paths = terms.astype(">u4")
        by_path = sorted(range(len(size)), key=lambda d: paths[starts[d]:starts[d + 1]].tobytes())
        by_path = np.array(by_path, np.int64)
        size = size[by_path]
        self.starts = np.concatenate([[0], np.cumsum(size)])
        take = np.arange(self.starts[-1]) + np.repeat(starts[by_path] - self.starts[:-1], size)
        self.ids, self.known, self.ms = ids[by_path], known[by_path], ms[by_path]
        self.terms, tfs = terms[take], tfs[take]
        doc = np.repeat(np.arange(len(size)), size)
        self.impacts = impact(weights[self.terms], tfs, self.ms[doc])
        self._grow(self._shared(size), leaf, max_depth)
        self._summarise(doc, tfs, weights)

    def _shared(self, size: np.ndarray) -> np.ndarray:
        """How many first terms each document shares with the one before."""
        shared = np.zeros(len(size), np.int64)
        at, depth = np.arange(1, len(size)), 0
        while len(at):
            at = at[(size[at] > depth) & (size[at - 1] > depth)]
            at = at[self.terms[self.starts[at] + depth] == self.terms[self.starts[at - 1] + depth]]
            depth += 1
            shared[at] = depth
        return shared

    def _grow(self, shared: np.ndarray, leaf: int, max_depth: int) -> None:
        """Nodes are runs of documents with a common path; a node stands
        after its parent."""
        self.lo, self.hi, self.parent, self.depth, self.children = [], [], [], [], []

        def node(lo: int, hi: int, parent: int) -> int:
            self.lo.append(lo)
            self.hi.append(hi)
            self.parent.append(parent)
            self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(len(self.lo) - 1)
            return len(self.lo) - 1

        todo = [node(0, len(shared), -1)]
        while todo:
            at = todo.pop()
            lo, hi = self.lo[at], self.hi[at]
            if hi - lo <= leaf:
                continue
            inner = shared[lo + 1:hi]
            if self.depth[at] >= max_depth:
                cuts = np.arange(lo + leaf, hi, leaf)
            else:  # where the common path of all of them ends
                cuts = lo + 1 + np.flatnonzero(inner == inner.min())
            open_at = lo
            for start, end in pairwise([lo, *cuts.tolist(), hi]):
                if end - start > leaf:
                    if open_at < start:
                        node(open_at, start, at)
                    todo.append(node(start, end, at))
                    open_at = end
                elif end - open_at > leaf:  # short runs that stand together are one leaf
                    node(open_at, start, at)
                    open_at = start
            if open_at < hi:
                node(open_at, hi, at)
        self.children = [np.array(c, np.int64) for c in self.children]

    def _summarise(self, doc: np.ndarray, tfs: np.ndarray, weights: np.ndarray) -> None:
        """Subtree maxima of tf by term, minima of m, and from them what each
        (node, term) can add to a score, by term."""
        count = len(self.lo)
        depth, parent = np.array(self.depth), np.array(self.parent)
        low = np.full(count, np.iinfo(np.int64).max)
        leaves = np.array([i for i in range(count) if not len(self.children[i])], np.int64)
        home = np.zeros(len(self.ms), np.int64)
        for i in leaves:
            home[self.lo[i]:self.hi[i]] = i
        np.minimum.at(low, home, self.ms)
        keys, terms, most = _largest(home[doc], self.terms, tfs)
        out, above = [(keys, terms, most)], tuple(x[:0] for x in (keys, terms, most))
        for d in range(int(depth.max()), 0, -1):
            here = depth[keys] == d
            k, t, m = (np.concatenate([x[here], y]) for x, y in zip((keys, terms, most), above, strict=True))
            nodes = np.unique(k)
            np.minimum.at(low, parent[nodes], low[nodes])
            above = _largest(parent[k], t, m)
            out.append(above)
        keys, terms, most = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.argsort(terms, kind="stable")
        self.nodes, terms = keys[order], terms[order]
        self.adds = impact(weights[terms], most[order], low[self.nodes])
        self.by_term = np.searchsorted(terms, np.arange(len(weights) + 1))

    def search(self, item: np.ndarray, chosen: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, among them the k best of at least ``floor``
        for the item's terms (``chosen`` marks them)."""
        bound = np.zeros(len(self.lo), np.int64)
        for t in item:
            at = slice(self.by_term[t], self.by_term[t + 1])
            bound[self.nodes[at]] += self.adds[at]  # a node stands once per term
        docs, scores, top, floor = [], [], np.zeros(0, np.int64), max(1, floor)
        stack = [0]
        while stack:
            node = stack.pop()
            if bound[node] < floor:
                continue
            inner = self.children[node]
            if len(inner):
                inner = inner[bound[inner] >= floor]
                stack.extend(inner[np.argsort(bound[inner], kind="stable")].tolist())
                continue
            lo, hi = self.lo[node], self.hi[node]
            entries = slice(self.starts[lo], self.starts[hi])
            found = np.add.reduceat(self.impacts[entries] * chosen[self.terms[entries]],
                                    self.starts[lo:hi] - self.starts[lo])
            good = np.flatnonzero(found >= floor)
            if not len(good):
                continue
            docs.append(lo + good)
            scores.append(found[good])
            top = np.concatenate([top, found[good]])
            if len(top) >= k:
                top = np.partition(top, len(top) - k)[len(top) - k:]
                floor = max(floor, int(top[0]))
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        return docs[scores >= floor], scores[scores >= floor]


def _first(ids, known, scores, k: int):
    at = np.lexsort((ids, ~known, ~scores))[:k]
    return ids[at], known[at], scores[at]


def _searched(items: list, rank: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int, k: int,
              entries: int):
    """``items``: (number, id, terms as numbers); ``rank``: a term's place in
    falling frequency; ``weights`` by place."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        none = (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        best = [none] * len(items)
        chosen = np.zeros(len(weights), np.int64)

        def visit(tables: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(tables)
            lengths = t["terms"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
            ms = 50 + (50 * t["n"].to_numpy() * n_docs) // n_terms
            tree = Tree(t["doc_id"].fill_null(0).to_numpy(), t["doc_id"].is_valid().to_numpy(), ms,
                        np.concatenate([[0], np.cumsum(lengths)]),
                        rank[t["terms"].combine_chunks().flatten().to_numpy()],
                        t["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64), weights)
            for i, (_, _, terms) in enumerate(items):
                ids, known, scores = best[i]
                chosen[terms] = 1
                docs, found = tree.search(terms, chosen, k, int(scores[-1]) if len(scores) == k else 1)
                chosen[terms] = 0
                if len(docs):
                    best[i] = _first(np.concatenate([ids, tree.ids[docs]]),
                                     np.concatenate([known, tree.known[docs]]),
                                     np.concatenate([scores, found]), k)

        held, size = [], 0
        for batch in batches:
            lengths = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            lo = 0
            while lo < len(lengths):  # a batch may hold several tries' worth
                room = np.cumsum(lengths[lo:])
                hi = lo + max(1, int(np.searchsorted(room, entries - size, "right")))
                held.append(batch.slice(lo, hi - lo))
                size += int(room[hi - lo - 1])
                lo = hi
                if size >= entries or lo < len(lengths):
                    visit(held)
                    held, size = [], 0
        if held:
            visit(held)
        part = TaskContext.get().partitionId()
        for (number, item_id, _), (ids, known, scores) in zip(items, best, strict=True):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(ids), pa.int64()), pa.array([item_id] * len(ids), pa.int64()),
                     pa.array(ids, mask=~known), pa.array(scores), pa.array([part] * len(ids), pa.int32())],
                    ["item", "item_id", "doc_id", "score", "part"])
    return search


def _ranked(hits: DataFrame, k: int, *keys) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _block(docs: DataFrame, rows: list, k: int, entries: int) -> DataFrame | None:
    """The hits of one block of items (number, item_id, text)."""
    wanted = [(r["item"], r["item_id"], set(TERM.findall((r["text"] or "").encode().lower()))) for r in rows]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(x[2] for x in wanted))))}
    if not vocabulary:
        return None
    vectors = stored(docs.mapInArrow(_restricted(vocabulary), VECTORS), "vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[term] = n  # as many rows as the block has terms
    rank = np.empty(len(df), np.int64)
    order = np.argsort(-df, kind="stable")
    rank[order] = np.arange(len(df))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df[order].tolist()],
                       np.int64)
    items = [(n, i, rank[[vocabulary[t] for t in terms if df[vocabulary[t]]]].astype(np.int64))
             for n, i, terms in wanted]
    items = [x for x in items if len(x[2])]
    return vectors.where(F.size("terms") > 0).mapInArrow(
        _searched(items, rank, weights, n_docs, n_terms, k, entries), HITS)


def rank(documents: DataFrame, items: DataFrame, k: int = 50, item_bytes: int = ITEM_BYTES,
         tree_entries: int = TREE_ENTRIES, tasks_per_group: int = TASKS_PER_GROUP) -> DataFrame:
    """(item_id, rank, doc_id, score): for each of ``items`` (item_id, text)
    its k best of ``documents`` (doc_id, text)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    queries = checkpointed(items.select(F.col("item_id").cast("long").alias("item_id"),
                                        F.col("text").cast("string").alias("text"))
                           .withColumn("item", F.monotonically_increasing_id()))
    size = queries.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / item_bytes))
    found = []
    for b in range(blocks):  # an item block is bounded; its documents are all
        rows = queries.where(F.pmod("item", F.lit(blocks)) == b).collect()
        hits = _block(docs, rows, k, tree_entries)
        if hits is not None:
            found.append(_ranked(hits, k, "item", F.floor(F.col("part") / tasks_per_group)))
    if not found:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    merged = _ranked(reduce(DataFrame.unionByName, found), k, "item")
    return merged.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
