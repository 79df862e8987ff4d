"""Shards: brute force over the supplied documents, hot texts, odd rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from featloom.llm import queries as llm
from featloom.llm import sharding

SCHEMA = "doc_id long, text string"


def data(text):
    return (text or "").encode()


def expected(rows, shards):
    """Shard and slot of each (id, text): by the middle of the record or, of equal texts
    that are little, of all of them."""
    order = sorted(rows, key=lambda r: (xxhash.xxh64(data(r[1]), seed=42).intdigest() - (1 << 64) * (xxhash.xxh64(data(r[1]), seed=42).intdigest() >> 63), r[0] is None, r[0] or 0))
    size = {t: len(data(t)) + 1 for _, t in rows}
    total = sum(size[t] for _, t in rows)
    start, count = {}, Counter(t or "" for _, t in rows)
    before, out, slots = 0, [], Counter()
    for d, t in order:
        whole = count[t or ""] * size[t]
        first = start.setdefault(t or "", before)
        if whole * shards <= sharding.TOGETHER * total:
            shard = min(shards - 1, shards * (2 * first + whole) // (2 * total))
        else:
            shard = min(shards - 1, shards * (2 * before + size[t]) // (2 * total))
        out.append((d, size[t], zlib.crc32(data(t)), shard, slots[shard]))
        slots[shard] += 1
        before += size[t]
    return out


def found(df):
    return [tuple(r) for r in df.select("id", "size", "crc", "shard", "slot").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *[x or 0 for x in r]))


def test_registered_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = llm.queries()["op11_sharding"](spark, sf_dir).collect()
    want = expected([tuple(r) for r in docs.collect()], 16)
    assert ordered((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows) == ordered(want)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows are one text; some texts repeat a few times."""
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i // 7} " + "x" * (i % 90)) for i in range(3000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_a_hot_text_is_cut_and_little_groups_are_not(hot):
    rows = found(sharding.plan(hot, 16))
    want = expected([tuple(r) for r in hot.collect()], 16)
    assert ordered(rows) == ordered(want)
    sizes, slots = Counter(), defaultdict(list)
    for _, size, _, shard, slot in rows:
        sizes[shard] += size
        slots[shard].append(slot)
    mean = sum(sizes.values()) / 16
    assert max(sizes.values()) < 1.03 * mean and min(sizes.values()) > 0.97 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_ranges_fit_though_the_first_sample_is_poor(hot, monkeypatch):
    """With a sample of a key or so a range, the overfull ones are divided again."""
    want = ordered(found(sharding.plan(hot, 16)))
    monkeypatch.setattr(sharding, "PER_RANGE", 1)
    splits = []
    ranged = sharding._ranged
    monkeypatch.setattr(sharding, "_ranged", lambda k, cuts: splits.append(len(cuts)) or ranged(k, cuts))
    keys = sharding._keys(hot, "doc_id", "text", False)
    rows, sizes = sharding._split(keys, 64)
    total = sum(r["bytes"] for r in sizes)
    assert len(splits) > 1 and splits == sorted(set(splits))
    assert all(r["bytes"] <= sharding.OVERFULL * total / 64 for r in sizes) and rows.count() == 3000
    assert ordered(found(sharding.plan(hot, 16, ranges=9))) == want


def test_samples_follow_size(spark):
    rows = [(i, "x" * (4000 if i < 50 else 40)) for i in range(2000)]
    keys = sharding._keys(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", False)
    total = sum(len(t) + 1 for _, t in rows)
    drawn = sharding._sampled(keys, F.col("size") * (200 / total))
    assert 170 < len(drawn) < 230
    little = sharding._sampled(keys.where("size < 1000"), F.col("size") * (200 / total))
    assert len(np.unique(little)) == len(little) and 35 < len(little) < 80


def test_keys_sort_as_their_bytes():
    values = np.array([-(1 << 63), -5, -1, 0, 1, 7, (1 << 63) - 1])
    held = sharding._as_bytes(np.repeat(values, 7), np.tile(values, 7))
    assert (np.argsort(held, kind="stable") == np.arange(49)).all() and len(np.unique(held)) == 49


def test_odd_rows(spark):
    rows = [(None, "a"), (None, "a"), (1, None), (1, None), (2, ""), (3, "x" * 500_000), (3, "x" * 500_000), (-4, "ü")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert ordered(found(sharding.plan(df, 16))) == ordered(expected(rows, 16))
    assert found(sharding.plan(spark.createDataFrame([], SCHEMA), 4)) == []
    text_ids = df.select(F.col("doc_id").cast("string"), "text")
    assert text_ids.count() == len(found(sharding.plan(text_ids, 3)))


def test_documents_keep_columns_of_any_name(spark, tmp_path):
    rows = [(i, f"text {i % 40}", i, "y", 1, 2.5, "z") for i in range(200)]
    names = ["doc_id", "text", "shard", "x.y", "slot", "_metadata", "a`b"]
    df = spark.createDataFrame(rows, names)
    out = sharding.sharded(df, 4)
    assert out.columns[: len(names)] == names and len(out.columns) == len(names) + 2
    assert sorted(map(tuple, out.select(*[f"`{n.replace('`', '``')}`" for n in names]).collect())) == sorted(rows)
    assert sharding.sharded(df.where("doc_id < 0"), 4).count() == 0


def test_written_shards_are_in_order(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(500)], SCHEMA)
    sharding.write_shards(df, str(tmp_path / "out"), 4)
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == [f"shard={i}" for i in range(4)]
    for part in (tmp_path / "out").rglob("*.parquet"):
        slots = [r["slot"] for r in spark.read.parquet(str(part)).collect()]
        assert slots == sorted(slots)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and back.select("shard", "slot").distinct().count() == 500


def test_more_bytes_than_ten_digits_count(spark, monkeypatch):
    each = 2_000_000_000
    monkeypatch.setattr(sharding, "text_size", lambda text: F.lit(each).cast("long"))
    texts = {i: f"text {i}" for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), SCHEMA)
    rows = sharding.plan(docs, 16).collect()
    order = sorted(texts, key=lambda i: (h := xxhash.xxh64(data(texts[i]), seed=42).intdigest()) - (1 << 64) * (h >> 63))
    assert {r.id: r.shard for r in rows} == {i: 16 * (2 * n + 1) // 80 for n, i in enumerate(order)}
    assert {r.size for r in rows} == {each}
