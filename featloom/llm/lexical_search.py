"""The best documents for each of a set of queries, by weighted term matches.

A term's weight falls with the number of documents that hold it; a document's score
for a query adds, over the query's terms, weight times a part that rises with the
term's occurrences and falls with the document's length.

1. A scan keeps of each document its id, its number of terms and its vector of terms
   restricted to those of the queries. Corpus counts and document frequencies come
   from all documents.
2. Each task builds frequent-pattern trees of ``DOCS_PER_TREE`` documents: vectors are
   ordered by document frequency, so that documents share the paths of frequent terms.
   A node holds, for the documents below it, the most occurrences of every term, the
   least length part and the least id.
3. For each query the tree is searched depth first, best child first. What a node can
   reach at most follows from its maxima; branches that cannot enter the query's best
   ``k`` of this task are left out. Documents of a leaf are scored exactly.
4. The tasks' best are ranked by query, where Spark keeps ``k`` per task and query
   before it shuffles.

Queries are taken in blocks of ``ITEMS_PER_BLOCK`` items or ``BYTES_PER_BLOCK`` of
text, read one block at a time by the driver; each block is a search of all documents.

Defined results: a null text, or one without a term, has no terms and is no hit; so is
a null or termless item. Of rows that repeat an item id each is ranked by itself, like
an item of its own. Equal scores go by id, null ids last, then by place. Empty tables
give an empty result. Other columns play no part.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from featloom.llm.common import quoted, stored

ITEMS_PER_BLOCK = 1_000
BYTES_PER_BLOCK = 1 << 20
DOCS_PER_TREE = 16_384
# Terms of all documents of a tree together, and maxima of all its nodes (of which a
# leaf's documents make two at most), by which a tree has fewer documents.
_TERMS_PER_TREE = 4_000_000
_MAXIMA_PER_TREE = 20_000_000
# A node with so few documents is not divided, neighbours with so few together are one
# leaf, and no node is divided below this depth.
_LEAF = 24
_DEPTH = 64
_LAST_ID = (1 << 63) - 1

# Terms are runs of ASCII letters and digits and of everything beyond ASCII; so in
# UTF-8 every byte of a character belongs to a term, or none does. A-Z are lowered.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split(b" ")


def _counted(text: bytes | None) -> tuple[Counter, int]:
    """Occurrences of each term, and of all together."""
    found = Counter(terms_of(text or b""))
    found.pop(b"", None)
    return found, sum(found.values())


@dataclass
class Corpus:
    docs: int  # that have a term
    terms: int  # with repeats
    frequency: np.ndarray  # documents that hold each term of the queries

    def weights(self) -> np.ndarray:
        ratio = (2.0 * self.docs + 2.0) / (2.0 * self.frequency + 1.0)
        return np.floor(1000.0 * np.log(ratio)).astype(np.int64)

    def length_part(self, n: Sequence[int]) -> np.ndarray:
        """m of documents with n terms; the product may need more than 64 bits."""
        return np.array([10 + 90 * int(x) * self.docs // self.terms for x in n], np.int64)


def _vectors(docs: DataFrame, vocabulary: Sequence[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of documents with a term: terms are places in the vocabulary."""
    held = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            kept, sizes, terms, tfs = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                found, n = _counted(text.as_py())
                if n:
                    hits = [(known[t], c) for t, c in found.items() if t in known]
                    kept.append(i)
                    sizes.append(n)
                    terms.append([t for t, _ in hits])
                    tfs.append([c for _, c in hits])
            columns = [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64())]
            columns += [pa.array(terms, ints), pa.array(tfs, ints)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    text = F.col(quoted(text_col)).cast("binary")
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), text.alias("text"))
    return stored(rows.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>"), "term-vectors")


def _corpus(vectors: DataFrame, size: int) -> Corpus:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        for batch in batches:
            found += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(found[held])], ["term", "docs"])

    docs, terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = np.zeros(size, np.int64)
    counts = vectors.select("terms").mapInArrow(run, "term long, docs long")
    for r in counts.groupBy("term").agg(F.sum("docs").alias("docs")).collect():
        frequency[r["term"]] = r["docs"]
    return Corpus(docs, terms, frequency)


class Tree:
    """Documents in the order of a frequent-pattern tree, and its nodes as arrays.

    ``terms`` and ``tfs`` hold the documents' vectors one after the other, ``sizes``
    how long each is; terms are numbered by falling frequency.
    """

    def __init__(self, ids: np.ndarray, length_part: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, width: int):
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((terms, owner))
        terms, tfs = terms[order], tfs[order]
        starts = np.cumsum(sizes) - sizes
        # Paths as byte strings, which sort as the trie is walked.
        wide = terms.astype(">u4").tobytes()
        paths = [wide[4 * a : 4 * (a + n)] for a, n in zip(starts.tolist(), sizes.tolist())]
        walk = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
        at = np.arange(sizes[walk].sum()) + np.repeat(starts[walk] - (np.cumsum(sizes[walk]) - sizes[walk]), sizes[walk])
        self.ids, self.part, self.sizes = ids[walk], length_part[walk], sizes[walk]
        self.terms, self.tfs = terms[at], tfs[at]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.width = width
        self._grow()
        self._bound()

    def _grow(self) -> None:
        """Nodes are ranges of the documents: first, end, and children of each. A node's
        documents share their path up to its depth; a chain without branches is one."""
        n = len(self.ids)
        steps = np.full((n, _DEPTH), -1, np.int64)
        column = np.arange(len(self.terms)) - np.repeat(self.starts[:-1], self.sizes)
        within = column < _DEPTH
        steps[np.repeat(np.arange(n), self.sizes)[within], column[within]] = self.terms[within]
        self.first, self.end, self.children = [0], [n], [()]
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            a, b = self.first[node], self.end[node]
            while depth < _DEPTH and steps[a, depth] == steps[b - 1, depth] and steps[a, depth] >= 0:
                depth += 1
            if b - a <= _LEAF or depth == _DEPTH or steps[b - 1, depth] < 0:
                continue
            cuts = self._apart(a, a + 1 + np.flatnonzero(np.diff(steps[a:b, depth])), b)
            if not len(cuts):
                continue
            below = range(len(self.first), len(self.first) + len(cuts) + 1)
            self.children[node] = tuple(below)
            for child, x, y in zip(below, [a, *cuts.tolist()], [*cuts.tolist(), b]):
                self.first.append(x)
                self.end.append(y)
                self.children.append(())
                stack.append((child, depth + 1))

    @staticmethod
    def _apart(a: int, cuts: np.ndarray, b: int) -> np.ndarray:
        """The cuts that stay when small neighbouring branches are one leaf."""
        kept, start, before = [], a, a
        for cut in [*cuts.tolist(), b]:
            if cut - start > _LEAF and before > start:
                kept.append(before)
                start = before
            if cut - start > _LEAF and cut < b:
                kept.append(cut)
                start = cut
            before = cut
        return np.array(kept, np.int64)

    def _bound(self) -> None:
        """Most occurrences of each term, least length part and least id, of the
        documents below each node; children come after their parents."""
        nodes = len(self.first)
        self.most = np.zeros((nodes, self.width), np.int32)
        leaf = np.zeros(len(self.ids), np.int64)
        self.least_part = np.zeros(nodes, np.int64)
        self.least_id = np.zeros(nodes, np.int64)
        for node in range(nodes):
            a, b = self.first[node], self.end[node]
            self.least_part[node], self.least_id[node] = self.part[a:b].min(), self.ids[a:b].min()
            if not self.children[node]:
                leaf[a:b] = node
        cells = np.repeat(leaf, self.sizes) * self.width + self.terms
        np.maximum.at(self.most.reshape(-1), cells, self.tfs)
        for node in range(nodes - 1, -1, -1):
            if self.children[node]:
                self.most[node] = self.most[list(self.children[node])].max(axis=0)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offers ``best`` every document that may be among them."""
        place = np.full(self.width, -1, np.int64)
        place[terms] = np.arange(len(terms))
        stack = [(int(self._reach(np.array([0]), terms, weights)[0]), 0)]
        while stack:
            reach, node = stack.pop()
            if not best.open_to(reach, self.least_id[node]):
                continue
            if not self.children[node]:
                self._offer(node, place, weights, best)
                continue
            below = np.array(self.children[node])
            reaches = self._reach(below, terms, weights)
            # The best child is taken up next.
            for i in np.argsort(reaches, kind="stable").tolist():
                if best.open_to(int(reaches[i]), self.least_id[below[i]]):
                    stack.append((int(reaches[i]), int(below[i])))

    def _reach(self, nodes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return scores(self.most[nodes[:, None], terms[None, :]], self.least_part[nodes], weights)

    def _offer(self, node: int, place: np.ndarray, weights: np.ndarray, best: Best) -> None:
        a, b = self.first[node], self.end[node]
        lo, hi = self.starts[a], self.starts[b]
        at = place[self.terms[lo:hi]]
        hit = at >= 0
        tf = np.zeros((b - a, len(weights)), np.int64)
        tf[np.repeat(np.arange(b - a), self.sizes[a:b])[hit], at[hit]] = self.tfs[lo:hi][hit]
        found = scores(tf, self.part[a:b], weights)
        for i in np.flatnonzero(found >= max(best.floor, 1)).tolist():
            best.offer(int(found[i]), int(self.ids[a + i]))


def scores(tf: np.ndarray, part: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of rows of occurrences, one column per term of the query."""
    tf = tf.astype(np.int64)
    return ((1_000_000_000 * tf) // (1000 * tf + 8 * part[:, None]) * weights).sum(axis=1)


class Best:
    """The ``k`` best hits so far: highest score, then lowest id."""

    def __init__(self, k: int):
        self.k = k
        self.heap: list[tuple[int, int]] = []
        self.floor = 0  # what a hit has to reach

    def open_to(self, reach: int, least_id: int) -> bool:
        """Whether hits with that score at most and that id at least may enter."""
        if reach <= 0:
            return False
        return len(self.heap) < self.k or (reach, -int(least_id)) > self.heap[0]

    def offer(self, score: int, doc: int) -> None:
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, (score, -doc))
        elif (score, -doc) > self.heap[0]:
            heapq.heapreplace(self.heap, (score, -doc))
        if len(self.heap) == self.k:
            self.floor = self.heap[0][0]


def _trees(batches: Iterator[pa.RecordBatch], corpus: Corpus, rank: np.ndarray) -> Iterator[Tree]:
    """Trees of a task's documents; those without a term of the queries are left out."""
    held: list[tuple[np.ndarray, ...]] = []
    most_docs = min(DOCS_PER_TREE, max(1, _MAXIMA_PER_TREE // max(len(rank), 1)) * _LEAF // 2)

    def tree() -> Tree:
        ids, n, sizes, terms, tfs = map(np.concatenate, zip(*held))
        held.clear()
        return Tree(ids, corpus.length_part(n), sizes, rank[terms], tfs, len(rank))

    for batch in batches:
        ids = batch.column(0).fill_null(_LAST_ID).to_numpy()
        n = batch.column(1).to_numpy()
        lists = batch.column(2)
        sizes = lists.value_lengths().to_numpy()
        terms, tfs = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy()
        some = sizes > 0
        ids, n, sizes = ids[some], n[some], sizes[some]
        ends = np.cumsum(sizes)
        start = 0
        while start < len(ids):
            room = most_docs - sum(len(x[0]) for x in held)
            terms_room = _TERMS_PER_TREE - sum(len(x[3]) for x in held)
            before = int(ends[start - 1]) if start else 0
            stop = min(start + room, max(start + 1, int(np.searchsorted(ends, before + terms_room, side="right"))), len(ids))
            lo, hi = before, int(ends[stop - 1])
            held.append((ids[start:stop], n[start:stop], sizes[start:stop], terms[lo:hi], tfs[lo:hi]))
            start = stop
            if sum(len(x[0]) for x in held) >= most_docs or sum(len(x[3]) for x in held) >= _TERMS_PER_TREE:
                yield tree()
    if held:
        yield tree()


def _searched(vectors: DataFrame, queries: list[np.ndarray], corpus: Corpus, k: int) -> DataFrame:
    """(item, doc, score): the best ``k`` of each task for each query."""
    weights = corpus.weights()
    # Terms by falling frequency.
    by_frequency = np.lexsort((np.arange(len(weights)), -corpus.frequency))
    rank = np.empty(len(weights), np.int64)
    rank[by_frequency] = np.arange(len(weights))
    asked = [(np.sort(rank[q]), weights[by_frequency[np.sort(rank[q])]]) for q in queries]
    held = vectors.sparkSession.sparkContext.broadcast((asked, corpus, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, corpus, rank = held.value
        best = [Best(k) for _ in asked]
        for tree in _trees(batches, corpus, rank):
            for (terms, weights), found in zip(asked, best):
                tree.search(terms, weights, found)
        hits = [(i, -doc, score) for i, found in enumerate(best) for score, doc in found.heap]
        columns = [pa.array([h[j] for h in hits], pa.int64()) for j in range(3)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "doc", "score"])

    return vectors.mapInArrow(run, "item long, doc long, score long")


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[Row]]:
    rows = items.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    block, held = [], 0
    for row in rows.toLocalIterator():
        if block and (len(block) == ITEMS_PER_BLOCK or held + len(row["text"] or b"") > BYTES_PER_BLOCK):
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row["text"] or b"")
    if block:
        yield block


def _block_hits(docs: DataFrame, block: list[Row], k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, rank, doc, score) of a block; items by their place in it."""
    found = [sorted(_counted(r["text"])[0]) for r in block]
    vocabulary = sorted({t for terms in found for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    queries = [np.array([place[t] for t in terms], np.int64) for terms in found]
    vectors = _vectors(docs, vocabulary, id_col, text_col)
    hits = _searched(vectors, queries, _corpus(vectors, len(vocabulary)), k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item, of those with a score above 0: item (its
    id), rank from 1, doc, score. Ids of documents are integers."""
    spark = docs.sparkSession
    kind = items.select(quoted(item_id)).schema.fields[0].dataType
    schema = StructType([StructField("place", LongType()), StructField("id", kind)])
    found = spark.createDataFrame([], schema).select(
        F.col("id").alias("item"), F.lit(0).alias("rank"), F.col("place").alias("doc"), F.col("place").alias("score")
    )
    for block in _blocks(items, item_id, item_text):
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(block)], schema)
        hits = stored(_block_hits(docs, block, k, id_col, text_col), "hits")
        doc = F.when(F.col("doc") != _LAST_ID, F.col("doc"))
        named = hits.join(F.broadcast(names), F.col("item") == F.col("place"))
        found = found.unionByName(named.select(F.col("id").alias("item"), "rank", doc.alias("doc"), "score"))
    return found
