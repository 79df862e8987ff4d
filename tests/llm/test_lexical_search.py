"""Ranked search against every score by hand."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from featloom.llm import lexical_search

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def expected(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n = len(held)
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n // total
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if none else d, -score))
    return ordered(out)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x or 0) for x in r])


def found(docs, items, **more):
    rows = lexical_search.ranked(docs, items, **more)
    assert rows.columns == ["item", "rank", "doc", "score"]
    return ordered(rows.collect())


@pytest.fixture(scope="module")
def made(spark):
    """Words of very uneven frequency, with copies and near copies."""
    draw = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    chance = 1 / np.arange(1, 301)
    chance /= chance.sum()
    docs = [(i, " ".join(draw.choice(words, draw.integers(1, 120), p=chance))) for i in range(900)]
    docs += [(5000 + i, docs[7][1]) for i in range(400)]
    docs += [(9000 + i, docs[8][1] + f" w{i}") for i in range(60)]
    items = [(i, " ".join(draw.choice(words, 25, p=chance))) for i in range(12)]
    items += [(50, docs[7][1]), (51, "W0 w0 w0"), (52, "unheard of"), (53, None), (54, "..."), (50, "w299")]
    return docs, items, spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)


@pytest.mark.parametrize("per_tree", [lexical_search.DOCS_PER_TREE, 50])
def test_same_as_all_scores(made, monkeypatch, per_tree):
    monkeypatch.setattr(lexical_search, "DOCS_PER_TREE", per_tree)
    docs, items, d, i = made
    assert found(d, i) == expected(docs, items)


def test_blocks_of_items(made, monkeypatch):
    docs, items, d, i = made
    monkeypatch.setattr(lexical_search, "ITEMS_PER_BLOCK", 7)
    monkeypatch.setattr(lexical_search, "BYTES_PER_BLOCK", 400)
    assert found(d, i, k=3) == expected(docs, items, 3)


def test_trees_of_few_terms(made, monkeypatch):
    docs, items, d, i = made
    monkeypatch.setattr(lexical_search, "_TERMS_PER_TREE", 500)
    monkeypatch.setattr(lexical_search, "_MAXIMA_PER_TREE", 2000)
    monkeypatch.setattr(lexical_search, "_LEAF", 3)
    monkeypatch.setattr(lexical_search, "_DEPTH", 4)
    assert found(d, i) == expected(docs, items)


def tree_of(vectors, width, part=None):
    sizes = np.array([len(v) for v in vectors])
    joined = [x for v in vectors for x in sorted(v.items())]
    part = np.full(len(vectors), 100) if part is None else part
    return lexical_search.Tree(
        np.arange(len(vectors)), part, sizes, np.array([t for t, _ in joined]), np.array([c for _, c in joined]), width
    )


def test_the_tree_shares_paths_and_leaves_branches_out(monkeypatch):
    draw = np.random.default_rng(1)
    vectors = [{int(t): int(draw.integers(1, 5)) for t in {0, 1 + i % 5, *draw.integers(6, 60, 6).tolist()}} for i in range(2000)]
    part = draw.integers(10, 400, 2000)
    tree = tree_of(vectors, 60, part)
    assert len(tree.first) < 400  # nodes
    for node, below in enumerate(tree.children):
        if below:
            assert tree.first[below[0]] == tree.first[node] and tree.end[below[-1]] == tree.end[node]
        for term in (0, 3, 40):
            held = tree.terms[tree.starts[tree.first[node]] : tree.starts[tree.end[node]]] == term
            values = tree.tfs[tree.starts[tree.first[node]] : tree.starts[tree.end[node]]][held]
            assert tree.most[node, term] == max(values, default=0)
        assert tree.least_part[node] == tree.part[tree.first[node] : tree.end[node]].min()

    scored = []
    offer = tree._offer
    monkeypatch.setattr(tree, "_offer", lambda node, *a: scored.append(tree.end[node] - tree.first[node]) or offer(node, *a))
    best = lexical_search.Best(10)
    asked, weights = np.array([0, 3]), np.array([10, 900])
    tree.search(asked, weights, best)
    tf = np.array([[vectors[d].get(int(t), 0) for t in asked] for d in range(2000)])
    whole = lexical_search.scores(tf, part, weights)
    want = sorted(range(2000), key=lambda d: (-whole[d], d))[:10]
    assert sorted((-s, -d) for s, d in best.heap) == [(-int(whole[d]), d) for d in want]
    assert sum(scored) < 500


def test_terms_are_runs_of_bytes():
    text = "Ünder_score ÀB a-b\x00c 漢字1 Z9\x7f x y"
    assert [t.decode() for t in lexical_search.terms_of(text.encode()) if t] == terms(text)


def test_length_part_of_a_large_corpus():
    corpus = lexical_search.Corpus(5 * 10**10, 10**14, np.zeros(1, np.int64))
    assert corpus.length_part([10**7]).tolist() == [10 + 90 * 10**7 * 5 * 10**10 // 10**14]


def test_odd_rows(spark):
    docs = [(None, "a b"), (None, "a b"), (3, None), (3, ""), (4, "b"), (4, "b"), (5, "..."), (6, "a " * 100_000 + "b c"), (-1, "c c")]
    items = [(None, "a"), (1, "b c"), (1, "b c"), (2, "")]
    d = spark.createDataFrame(docs, DOCS).withColumns({"x.y": F.lit(1), "_metadata": F.lit(2), "score": F.lit(3), "item_id": F.lit(4)})
    i = spark.createDataFrame(items, ITEMS).withColumns({"rank": F.lit(1), "doc": F.lit(2)})
    assert found(d, i) == expected(docs, items)
    none = spark.createDataFrame([], DOCS)
    assert found(none, i) == [] and found(d, spark.createDataFrame([], ITEMS)) == []
    assert found(d, i.select(F.col("item_id").cast("string"), "text")) == ordered(
        (None if a is None else str(a), *r) for a, *r in expected(docs, items)
    )


def test_best_are_kept_per_task_before_the_shuffle(made, monkeypatch):
    _, items, d, _ = made
    seen = []
    monkeypatch.setattr(lexical_search, "stored", lambda df, label: seen.append((label, df)) or lexical_search_stored(df, label))
    lexical_search.ranked(d, d.sparkSession.createDataFrame(items[:2], ITEMS))
    (hits,) = [df for label, df in seen if label == "hits"]
    assert "WindowGroupLimit" in plan_of(hits)


lexical_search_stored = lexical_search.stored
