"""What a task holds is bounded, however long the rows and lists are."""

import os
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from featloom.llm import alignment, common, jaccard_join, suffix_dedup
from featloom.llm import queries as llm

LEAST = 1 << 18


@pytest.fixture
def long_rows(spark, tmp_path):
    """Texts of some 10 KB, several of them near copies, in one file."""
    def text(i):
        return " ".join(f"w{(i // 2) * 7919 + j}" for j in range(1_500)) + f" end{i}"

    rows = [(i, text(i)) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "long"))
    return spark.read.parquet(str(tmp_path / "long"))


@pytest.fixture
def watched(monkeypatch, long_rows):
    """Fails a task that is handed more than some rows' bytes at a time."""
    kind = type(long_rows)
    plain = kind.mapInArrow

    def map_in_arrow(self, f, *more, **named):
        def run(batches):
            def checked():
                for b in batches:
                    if b.num_rows > 1 and b.nbytes > 2 * LEAST:
                        raise MemoryError(f"{b.num_rows} rows of {b.nbytes} bytes at a time")
                    yield b

            yield from f(checked())

        return plain(self, run, *more, **named)

    monkeypatch.setattr(kind, "mapInArrow", map_in_arrow)
    return {"spark.sql.execution.arrow.maxBytesPerBatch": str(LEAST)}


def test_the_join_gets_few_bytes_at_a_time(spark, long_rows, watched, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL_BATCHES", watched, raising=False)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    rows = jaccard_join.classes(long_rows).collect()
    assert {(r.id, r.component_id, r.links) for r in rows} == {(i, i // 2 * 2, 1) for i in range(120)}
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def test_lists_are_counted_in_parts(monkeypatch):
    """The same numbers however many entries are sorted together, and never more than that."""
    draw = np.random.default_rng(5)
    sorted_at_once = []
    plain = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorted_at_once.append(len(keys[0])) or plain(keys))
    rows = []
    for _ in range(20):
        token, owner = draw.integers(0, 4_000, 500).astype(np.uint64), draw.integers(0, 300, 500).astype(np.uint64)
        rows.append({"bucket": 0, "token": jaccard_join._six(token), "owner": jaccard_join._six(owner),
                     "known": (draw.random(500) < 0.2).tobytes(), "count": b""})
    rows.append({"bucket": 0, "token": b"", "owner": jaccard_join._six(np.array([3, 9], np.uint64)), "known": b"",
                 "count": np.array([4, 5], np.int32).tobytes()})
    table = pa.Table.from_pylist(rows, schema=jaccard_join._LISTS)

    def found(entries):
        monkeypatch.setattr(jaccard_join, "_SORTED", entries, raising=False)
        out = {}
        for r in jaccard_join._count_shared(table).to_pylist():
            out[r["owner"]] = out.get(r["owner"], 0) + r["n"]
        return out

    whole = found(1 << 30)
    sorted_at_once.clear()
    assert found(1_000) == whole and len(whole) > 200
    assert max(sorted_at_once) < 1_200


def test_the_alignment_gets_few_bytes_at_a_time(spark, long_rows, watched, monkeypatch):
    monkeypatch.setattr(alignment, "SMALL_BATCHES", watched, raising=False)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    rows = alignment.aligned(long_rows, llm.tokenizers(), digest=True).collect()
    assert sorted(r.id for r in rows) == list(range(120)) and all(r.n_a and r.n_links <= r.count_sum for r in rows)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before


def peak_mb(run) -> float:
    """Of what numpy and Python take meanwhile."""
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("class_rows", [200_000, 1])
def test_passages_get_few_bytes_at_a_time(spark, long_rows, watched, monkeypatch, class_rows):
    monkeypatch.setattr(suffix_dedup, "SMALL_BATCHES", watched, raising=False)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    texts = {r.doc_id: r.text for r in long_rows.collect()}
    found = suffix_dedup.without_repeats(long_rows, suffix_dedup.PassageSpec(class_rows=class_rows))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == before
    # What is not stored runs under the caller's settings.
    with common.settings(spark, watched):
        rows = found.collect()
    for r in rows:
        text = texts[r.doc_id]
        same = len(os.path.commonprefix([text, texts[r.doc_id ^ 1]]))
        assert (r.found.n_bytes, r.found.n_removed, r.found.n_spans) == (len(text), same, 1)
        assert r.found.kept.decode() == text[same:]
    assert len(rows) == len(texts)


def test_texts_pass_python_once_each_task(spark, long_rows, monkeypatch):
    """No task has a second Python worker behind the first, and none cuts the texts."""
    plans, plain = [], suffix_dedup.stored

    def stored(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df, label)

    monkeypatch.setattr(suffix_dedup, "stored", stored)
    out = suffix_dedup.without_repeats(long_rows, suffix_dedup.PassageSpec(class_rows=1))
    windows = next(plan for label, plan in plans if label == "passage-windows")
    assert windows.count("MapInArrow") == 1
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()


def test_hashing_texts_takes_bounded_memory():
    r = random.Random(4)
    texts = ["".join(r.choices("abcdefgh ", k=3_000)).encode() for _ in range(700)]
    spec = suffix_dedup.PassageSpec()
    suffix_dedup.anchors(texts[:1], spec)
    assert peak_mb(lambda: suffix_dedup.anchors(texts, spec)) < 50
    whole = b"".join(texts)
    assert peak_mb(lambda: suffix_dedup.anchors([whole], spec)) < 50


def test_a_large_class_is_held_as_it_came():
    """One anchor in 40,000 places, before which the texts agree in some bytes."""
    n, spec = 40_000, suffix_dedup.PassageSpec()
    draw = np.random.default_rng(7)
    right = sorted(bytes(x) for x in draw.integers(97, 105, (n, 100), dtype=np.uint8))
    left = [bytes(x) for x in draw.integers(97, 99, (n, 100), dtype=np.uint8)]
    # Two tuples agree in all bytes, two in 90 after and 20 before the anchor.
    right[11], left[11] = right[10], left[10]
    right[21], left[21] = right[20][:90] + b"z" * 10, left[20][:20] + b"z" * 80
    columns = [[5] * n, [6] * n, right, left, list(range(n)), [0] * n, [1_000] * n, [None] * n]
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, suffix_dedup._TUPLES.types)], schema=suffix_dedup._TUPLES)
    settled = {"name": 9, "sure": None, "right": None, "left": None, "k1": 9, "k2": 8, "at": 7, "upto": 300}
    batches = [*table.to_batches(10_000), pa.RecordBatch.from_pylist([settled], suffix_dedup._TUPLES)]
    found = []
    taken = peak_mb(lambda: found.extend(suffix_dedup._induce_shard(spec)(iter(batches))))
    rows = sorted(tuple(r.values()) for b in found for r in b.to_pylist())
    assert rows == sorted([(9, 8, 7, 300), *((i, 0, 900, 1_200) for i in (10, 11)), *((i, 0, 980, 1_190) for i in (20, 21))])
    assert taken < 25


@pytest.mark.parametrize("written", [True, False])
def test_remembered_units_are_bounded_in_bytes(monkeypatch, written):
    """Few long units take as much as many short ones."""
    monkeypatch.setattr(alignment, "_MOST_BYTES", 100_000, raising=False)
    tokenizers = llm.tokenizers()
    units = alignment.Units(tokenizers, written=written)
    alone = alignment.Units(tokenizers, written=written)
    for i in range(60):
        text = f"{i}" + "abcdefghij"[i % 10] * 3 * 1_500 + " the same"
        (cut,) = units.of([text])
        alone.clear()
        (want,) = alone.of([text])
        assert (units.counts[cut] == alone.counts[want]).all()
        sizes, known = np.diff(units.starts), np.diff(alone.starts)
        assert (sizes[cut] == known[want]).all()
        for u, w in zip(cut, want):
            mine = units.pairs[units.starts[u] : units.starts[u + 1]]
            assert (mine == alone.pairs[alone.starts[w] : alone.starts[w + 1]]).all()
        assert sum(map(len, units.number)) < 120_000


def test_a_table_leaves_only_the_pairs_it_lacks():
    tokenizers = llm.tokenizers()
    plain = alignment.Units(tokenizers)
    plain.of(["some words of a text"])
    pairs = np.unique(plain.pairs)
    ones = np.ones(len(pairs), np.int64)
    full = alignment.Units(tokenizers, alignment.Table.build(pairs, ones, ones))
    full.of(["some words of a text"])
    assert len(full.pairs) == 0 and (full.scores == plain.counts[:, 3:]).all()
    half = alignment.Units(tokenizers, alignment.Table.build(pairs[1:], ones[1:], ones[1:]))
    half.of(["some words of a text"])
    assert set(half.pairs.tolist()) == {int(pairs[0])}


def test_counted_pairs_are_added_up():
    draw = np.random.default_rng(3)
    counted, want = alignment._Counted(), np.zeros(1_000, np.int64)
    for _ in range(400):
        keys = np.unique(draw.integers(0, 1_000, 900))
        counted.add(keys, keys % 7 + 1)
        want[keys] += keys % 7 + 1
        assert sum(len(k) for k, _ in counted.parts) <= 300_000
    counted.merge()
    ((keys, docs),) = counted.parts
    assert (keys == np.flatnonzero(want)).all() and (docs == want[keys]).all()


def test_sets_stay_in_the_join_by_all_their_members(spark, monkeypatch):
    """Half of each text stands in others too, which no link can come of."""
    passages = [" ".join(f"p{k}w{j}" for j in range(40)) for k in range(30)]
    texts = {i: " ".join([*(f"d{i}w{j}" for j in range(60)), passages[i // 2], passages[(i // 2 + 1) % 30]]) for i in range(60)}
    texts[100] = texts[0] + " end"
    kept = {}

    def stored(df, label):
        out = common.stored(df, label)
        kept[label] = out.count()
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    rows = jaccard_join.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.id: (r.component_id, r.links) for r in rows} == {i: (0, 1) if i in (0, 100) else (i, 0) for i in texts}
    assert kept["join-found"] == 2


def test_the_join_in_passes_is_the_same(spark, long_rows):
    whole, parts = (
        sorted(map(tuple, jaccard_join.classes(long_rows, jaccard_join.JoinSpec(pass_entries=n)).select("id", "n", "component_id", "links").collect()))
        for n in (1 << 40, 0)
    )
    assert whole == parts and {r[3] for r in whole} == {1}


def test_the_join_leaves_only_what_its_result_reads(spark, long_rows):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    local = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())

    def shuffles():
        return {n for top in local for _, _, names in os.walk(top) for n in names if n.startswith("shuffle_")}

    old, old_shuffles = set(os.listdir(shared)), shuffles()
    found = jaccard_join.search_links(long_rows)
    left = sorted(x[:-33] for x in set(os.listdir(shared)) - old)
    assert left == ["component-edges", "join-documents", "join-forest"]
    until = time.time() + 30
    while shuffles() - old_shuffles and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - old_shuffles
    assert found.sets.count() == found.documents.count() == 120
