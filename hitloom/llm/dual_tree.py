"""Ranked lexical search: trees over items and over documents, descended together."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hitloom.llm.common import parts, stage, text_bytes

# Bytes of item texts that are searched at once, of which a task holds the terms.
BLOCK_BYTES = 4_000_000
# Documents, and terms in them, of one document tree.
TREE_DOCS, TREE_ENTRIES = 4096, 400_000
# Children of a node of a document tree.
FAN_OUT = 16
# Parts in which the best of all tasks are merged first.
MERGE_PARTS = 64
# Sums of doubles are exact below this.
EXACT = 1 << 53

# Words: digits, letters and all bytes of characters that are not ASCII; A-Z as a-z, the others as spaces.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text with repeats, in order."""
    return text.translate(_FOLD).split()


class ItemNode:
    """Items lo … hi - 1 of the tree's order, and the terms that any of them has."""

    def __init__(self, lo: int, hi: int, terms: np.ndarray, children: list[ItemNode]):
        self.lo, self.hi, self.terms, self.children = lo, hi, terms, children


def item_tree(items: list[np.ndarray], weight: np.ndarray) -> tuple[ItemNode | None, list[int]]:
    """A binary tree over `items`, arrays of terms, and the order of the items in it.

    An item is a point with the weight of each of its terms as a coordinate, so the coordinate maxima of a
    node are the weights of all its terms. A node is split by the term whose weight and balance are largest.
    """
    order: list[int] = []

    def build(members: list[int]) -> ItemNode:
        lo = len(order)
        terms = np.unique(np.concatenate([items[i] for i in members]))
        if len(members) == 1:
            order.append(members[0])
            return ItemNode(lo, lo + 1, terms, [])
        flat = np.concatenate([items[i] for i in members])
        at, n = np.unique(flat, return_counts=True)
        even = np.minimum(n, len(members) - n)
        best = int(np.argmax(even * np.maximum(weight[at], 1)))
        if even[best] * 4 >= len(members):
            term = at[best]
            has = [bool((items[i] == term).any()) for i in members]
            left, right = [i for i, h in zip(members, has, strict=True) if h], [i for i, h in zip(members, has, strict=True) if not h]
        else:
            members = sorted(members, key=lambda i: items[i].tolist())
            left, right = members[: len(members) // 2], members[len(members) // 2 :]
        children = [build(left), build(right)]
        return ItemNode(lo, len(order), terms, children)

    used = [i for i, t in enumerate(items) if len(t)]
    return (build(used) if used else None), order


class Level:
    """Coordinate maxima of the nodes of one level of a document tree, by term."""

    def __init__(self, node: np.ndarray, term: np.ndarray, value: np.ndarray, n_nodes: int, n_terms: int):
        key = term * n_nodes + node
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.value = np.maximum.reduceat(value[order], first)
        self.node, self.term = key[first] % n_nodes, key[first] // n_nodes
        self.start = np.searchsorted(self.term, np.arange(n_terms + 1))
        self.n = n_nodes

    def bounds(self, terms: np.ndarray, weight: np.ndarray, exact: bool) -> np.ndarray:
        """For each node the sum of weight times maximum over `terms`: no document below it has more."""
        low = self.start[terms]
        n = self.start[terms + 1] - low
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        gain = np.repeat(weight[terms], n) * self.value[at]
        if exact:
            return np.bincount(self.node[at], gain, self.n).astype(np.int64)
        out = np.zeros(self.n, dtype=np.int64)
        np.add.at(out, self.node[at], gain)
        return out


class DocumentTree:
    """Levels of documents, the documents themselves first; children of a node lie side by side."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, value: np.ndarray, n_docs: int, weight: np.ndarray):
        # documents with the same strongest term lie together
        gain = weight[term] * value
        by_gain = np.lexsort((term, gain, owner))
        last = np.flatnonzero(np.diff(owner[by_gain], append=-1))
        strongest = np.full(n_docs, -1, dtype=np.int64)
        strongest[owner[by_gain[last]]] = term[by_gain[last]]
        self.order = np.argsort(strongest, kind="stable")
        place = np.empty(n_docs, dtype=np.int64)
        place[self.order] = np.arange(n_docs)
        self.levels = [Level(place[owner], term, value, n_docs, len(weight))]
        while self.levels[-1].n > 1:
            below = self.levels[-1]
            self.levels.append(Level(below.node // FAN_OUT, below.term, below.value, -(-below.n // FAN_OUT), len(weight)))

    def children(self, level: int, alive: np.ndarray) -> np.ndarray:
        return np.repeat(alive, FAN_OUT)[: self.levels[level - 1].n]


class Best:
    """The k best documents of each item so far: score, document, whether its id is null."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(n_items)]
        self.weakest = np.zeros(n_items, dtype=np.int64)

    def offer(self, item: int, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        s, d, z = (np.concatenate(p) for p in zip(self.found[item], (score, doc, null), strict=True))
        top = np.lexsort((d, z, -s))[: self.k]
        self.found[item] = s[top], d[top], z[top]
        if len(top) == self.k:
            self.weakest[item] = s[top[-1]]


def search(root: ItemNode, tree: DocumentTree, doc: np.ndarray, null: np.ndarray, weight: np.ndarray, best: Best, exact: bool) -> int:
    """Offer every document that can be among the best of an item; the number of node pairs looked at.

    A pair of nodes is left where its bound is 0 or less than the weakest k-th score of the node's items.
    The bound of one item and one document is its score.
    """
    pairs, top = 0, len(tree.levels) - 1
    todo = [(root, top, np.ones(tree.levels[top].n, dtype=bool))]
    while todo:
        node, level, alive = todo.pop()
        bound = tree.levels[level].bounds(node.terms, weight, exact)
        pairs += int(alive.sum())
        alive = alive & (bound > 0) & (bound >= best.weakest[node.lo : node.hi].min())
        if not alive.any():
            continue
        if not node.children and level == 0:
            at = np.flatnonzero(alive)
            best.offer(node.lo, bound[at], doc[at], null[at])
            continue
        if level:
            alive, level = tree.children(level, alive), level - 1
        todo += [(child, level, alive) for child in node.children or [node]]
    return pairs


def document_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n, terms, tf): all terms of a document, and how often it has those of `vocabulary`; documents
    without a term are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, size = vocabulary.get, max(len(vocabulary), 1)
        for batch in batches:
            for part in parts(batch, "text"):
                found: list[int] = []
                n = np.zeros(part.num_rows, dtype=np.int64)
                for i, text in enumerate(text_bytes(part.column(1))):
                    words = terms_of(text)
                    n[i] = len(words)
                    found.extend(map(get, words, repeat(-1)))
                term = np.array(found, dtype=np.int64)
                owner = np.repeat(np.arange(len(n)), n)[term >= 0]
                key, tf = np.unique(owner * size + term[term >= 0], return_counts=True)
                some = np.flatnonzero(n)
                cut = pa.array(np.searchsorted(key // size, np.append(some, len(n))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(some)),
                        pa.array(n[some]),
                        pa.ListArray.from_arrays(cut, pa.array((key % size).astype(np.int32))),
                        pa.ListArray.from_arrays(cut, pa.array(tf.astype(np.int64))),
                    ],
                    names=["doc", "n", "terms", "tf"],
                )

    return docs.mapInArrow(run, "doc long, n long, terms array<int>, tf array<long>")


def _search_block(docs: DataFrame, texts: list[bytes], k: int) -> DataFrame:
    """(item, doc, score): the best of each task for the texts of one block."""
    found = [sorted(set(terms_of(t))) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted({t for f in found for t in f}))}
    vectors = stage(document_vectors(docs, vocabulary), "document_vectors")
    size = vectors.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = size["rows"], size["terms"]
    frequency = np.zeros(len(vocabulary), dtype=np.int64)
    # one row at most for each term of the block
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        frequency[r["t"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for f in frequency.tolist()], dtype=np.int64)
    useful = (frequency > 0) & (weight > 0)
    items = [np.array([vocabulary[t] for t in f if useful[vocabulary[t]]], dtype=np.int64) for f in found]
    root, order = item_tree(items, weight)
    exact = max((int(weight[t].sum()) for t in items), default=0) * 1_000_000 < EXACT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(order), k)
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> None:
            if not held or root is None:
                return
            doc, null, n = (np.concatenate([h[i] for h in held]) for i in range(3))
            count, term, tf = (np.concatenate([h[i] for h in held]) for i in range(3, 6))
            held.clear()
            owner = np.repeat(np.arange(len(doc)), count)
            own = useful[term]
            owner, term, tf = owner[own], term[own], tf[own]
            if not len(term):
                return
            m = 10 + (90 * n * n_docs) // n_terms
            value = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
            tree = DocumentTree(owner, term, value, len(doc), weight)
            search(root, tree, doc[tree.order], null[tree.order], weight, best, exact)

        entries = 0
        for batch in batches:
            doc, n, terms, tf = (batch.column(i) for i in range(4))
            count = np.asarray(terms.value_lengths()).astype(np.int64)
            flat, times = np.asarray(terms.flatten()).astype(np.int64), np.asarray(tf.flatten())
            ends = np.cumsum(count)
            null, number = ~np.asarray(doc.is_valid()), np.asarray(doc.fill_null(0))
            a = 0
            while a < len(count):
                # as many documents as fit into the tree at hand, one at least
                before = ends[a] - count[a]
                b = int(np.searchsorted(ends, before + max(TREE_ENTRIES - entries, 1), "right"))
                b = min(max(b, a + 1), a + max(TREE_DOCS - sum(len(h[0]) for h in held), 1), len(count))
                held.append((number[a:b], null[a:b], np.asarray(n)[a:b], count[a:b], flat[before : ends[b - 1]], times[before : ends[b - 1]]))
                entries += int(ends[b - 1] - before)
                a = b
                if entries >= TREE_ENTRIES or sum(len(h[0]) for h in held) >= TREE_DOCS:
                    flush()
                    held.clear()
                    entries = 0
        flush()
        rows = [len(f[0]) for f in best.found]
        score, doc, null = (np.concatenate([np.zeros(0, t), *[f[i] for f in best.found]]) for i, t in ((0, np.int64), (1, np.int64), (2, bool)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(order, dtype=np.int64), rows)),
                pa.array(doc.astype(np.int64), mask=null.astype(bool)),
                pa.array(score.astype(np.int64)),
            ],
            names=["item", "doc", "score"],
        )

    return vectors.mapInArrow(run, "item long, doc long, score long")


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` documents of the highest score above 0 for each row of `items`,
    equal scores by ascending document id, null ids last.

    Terms are maximal runs of digits, letters and characters that are not ASCII, A-Z lower-cased. With N
    documents that have a term, L terms in all of them, n terms in the document and df documents that hold the
    term, a term that stands tf times in it gains w ((10^9 tf) div (1000 tf + 8 m)) for w =
    floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L; an item counts each of its terms once.

    1. Different item texts are searched in blocks of some `BLOCK_BYTES`, of which each task holds the terms.
    2. One pass over the documents counts these terms; sums over all rows give N, L and df.
    3. Each task builds trees over some thousand documents at a time, whose nodes hold coordinate maxima, and
       descends them together with the tree over the items. A pair of nodes is left where no score below it
       reaches the weakest k-th score of its items (:func:`search`), so nothing that counts is lost.
    4. The best of all tasks are merged, at most k rows for each item and task.

    Null and empty texts of documents and items have no terms and no rows; repeated rows of documents are
    documents of their own, repeated rows of items get the same rows each; long texts are counted whole; other
    columns are left out; an empty table gives an empty table.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(doc_text).cast("string").alias("text"))
    texts = items.select(F.col(item_text).cast("string").alias("item_text")).filter(F.octet_length("item_text") > 0).distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(-(-size // BLOCK_BYTES), 1)
    kind = docs.sparkSession.createDataFrame([], "item_text string, doc long, score long")
    found = None
    for block in range(blocks):
        own = texts.filter(F.pmod(F.xxhash64("item_text"), F.lit(blocks)) == block).orderBy("item_text").collect()
        if not own:
            continue
        best = _search_block(rows, [r["item_text"].encode() for r in own], k)
        # the numbers of a block's items belong to texts that the driver just sent
        named = docs.sparkSession.createDataFrame([(i, r["item_text"]) for i, r in enumerate(own)], "item long, item_text string")
        best = best.join(F.broadcast(named), "item").select("item_text", "doc", "score")
        found = best if found is None else found.unionByName(best)
    found = kind if found is None else found

    def order(*keys: str) -> Window:
        return Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc"))

    merged = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_PARTS)))
    merged = merged.withColumn("rank", F.row_number().over(order("item_text", "part"))).filter(F.col("rank") <= k)
    merged = merged.withColumn("rank", F.row_number().over(order("item_text"))).filter(F.col("rank") <= k)
    wanted, key = items.select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("wanted_text")), "item_text"
    return wanted.join(merged, wanted["wanted_text"] == merged[key]).select(
        F.col("item").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(doc_id), "score"
    )
