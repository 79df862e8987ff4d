import random
from collections import Counter
from dataclasses import replace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from featloom.operators import ids as numbering, unique
from featloom.operators.ids import dense_ids, number_stored_rows, positioned
from featloom.operators.points import build_points
from featloom.sources.collection import CollectionStore
from featloom.sources.local import small_table

COLUMNS = ("a", "b")


def rows(spark, ids, factor=1.0):
    df = small_table(spark, {"id": "long"}, [(i,) for i in ids])
    return df.select(
        "id", (F.col("id") * factor).alias("a"), F.lit(1.0).alias("b"), F.lit("low").alias("energy_tier")
    )


def points(spark, ids, factor=1.0):
    return build_points(rows(spark, ids, factor), COLUMNS)


@pytest.fixture
def store(spark, tmp_path):
    return CollectionStore(spark, str(tmp_path))


def contents(store, name="c"):
    found = store.open(name).points.select("id", "payload.a").collect()
    assert len({r["id"] for r in found}) == len(found)
    return {r["id"]: r["a"] for r in found}


def test_point_shape(spark):
    point = points(spark, [3]).first()
    assert point.asDict(recursive=True) == {
        "id": 3,
        "vector": [3.0, 1.0],
        "payload": {"a": 3.0, "b": 1.0, "energy_tier": "low"},
    }
    labelled = rows(spark, [3]).drop("energy_tier").withColumn("label", F.lit(2))
    payload = build_points(labelled, COLUMNS, prediction_col="label").first()["payload"]
    assert payload.asDict() == {"a": 3.0, "b": 1.0, "cluster": 2}


def test_ids_are_dense_and_follow_the_key(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("key")).repartition(16)
    numbered = dense_ids(df, str(tmp_path / "staged"), ["key"])
    found = sorted((r["id"], r["key"]) for r in numbered.collect())
    assert [i for i, _ in found] == list(range(5000))
    assert [k for _, k in found] == sorted(k for _, k in found)


def test_ids_stay_dense_when_one_key_holds_a_third(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("key"))
    path = str(tmp_path / "staged")
    numbered = dense_ids(df.repartition(8), path, ["key"])
    assert sorted(r["id"] for r in numbered.collect()) == list(range(3000))


def test_one_key_is_shared_among_sorting_tasks(spark):
    df = spark.range(80_000).select(F.lit(1).alias("key")).repartition(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = positioned(df, ["key"]).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)])
        sizes = tasks.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 4 and max(sizes) < 30_000


def test_rows_of_one_key_keep_their_order(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") % 3).alias("key"), F.col("id").alias("n"))
    found = dense_ids(df, str(tmp_path / "staged"), ["key"]).orderBy("id").collect()
    assert [(r["key"], r["n"]) for r in found] == sorted((r["key"], r["n"]) for r in found)


def test_many_rows_are_sorted_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_TASK", 1000, raising=False)
    df = spark.range(30_000).select((F.col("id") * 7919 % 101).alias("key"), F.col("id").alias("n")).repartition(8)
    sizes = positioned(df, ["key"]).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 30 and max(sizes) < 3000 and sum(sizes) == 30_000
    found = dense_ids(df, str(tmp_path / "staged"), ["key"]).orderBy("id").collect()
    assert [r["id"] for r in found] == list(range(30_000))
    assert [r["key"] for r in found] == sorted(r["key"] for r in found)


def test_counting_rows_per_file_sorts_nothing(spark, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "files"), []
    spark.range(500).withColumnRenamed("id", "n").repartition(4).write.parquet(path)
    kind, collect = type(spark.range(1)), type(spark.range(1)).collect
    monkeypatch.setattr(kind, "collect", lambda self: plans.append(plan_of(self)) or collect(self))
    number_stored_rows(spark, path)
    assert plans and all("Aggregate" in p and "Sort" not in p for p in plans)


def test_many_ids_stay_together_in_partitions_of_bounded_size(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(unique, "_grouped", None)
    path = str(tmp_path / "files")
    rows(spark, range(950)).drop("id").repartition(7).write.parquet(path)
    numbered = number_stored_rows(spark, path, together=True)
    held = sorted(numbered.rdd.mapPartitions(lambda rows: [sorted(r["id"] for r in rows)]).collect())
    assert held == [list(range(i, min(i + 100, 950))) for i in range(0, 950, 100)]
    store.recreate("c", 2, points=build_points(numbered, COLUMNS), together=True)
    blocks = store.open("c").blocks
    assert [(b["min_id"], b["max_id"]) for b in blocks] == [(h[0], h[-1]) for h in held]


def test_ids_hold_across_the_splits_of_a_file(spark, tmp_path):
    path = str(tmp_path / "large")
    rows = spark.range(200_000).select(F.col("id").alias("n"), F.rand(1).alias("x")).coalesce(1)
    rows.write.option("parquet.block.size", 128 * 1024).parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200 * 1024)
    try:
        numbered = number_stored_rows(spark, path)
        assert numbered.rdd.getNumPartitions() > 4
        assert numbered.where("id <> n").count() == 0 and numbered.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ids_without_key_follow_the_rows(spark, tmp_path):
    numbered = dense_ids(spark.range(0, 1000, 1, 13).withColumnRenamed("id", "n"), str(tmp_path / "s"))
    assert all(r["id"] == r["n"] for r in numbered.collect())


def test_numbering_of_many_files_and_of_none(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.range(500).withColumnRenamed("id", "n").repartition(40).write.parquet(path)
    numbered = number_stored_rows(spark, path)
    assert sorted(r["id"] for r in numbered.collect()) == list(range(500))
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "n long").write.parquet(empty)
    assert number_stored_rows(spark, empty).count() == 0
    with pytest.raises(ValueError):
        number_stored_rows(spark, path, "n")


def test_numbering_does_not_shuffle_or_call_python(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.range(500).withColumnRenamed("id", "n").write.parquet(path)
    plan = plan_of(number_stored_rows(spark, path))
    assert "BroadcastHashJoin" in plan and "Python" not in plan
    assert "Exchange hashpartitioning" not in plan and "SinglePartition" not in plan


def test_numbering_never_shuffles_whatever_the_broadcast_limit(spark, tmp_path):
    path = str(tmp_path / "files")
    spark.range(500).withColumnRenamed("id", "n").write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange hash" not in plan_of(number_stored_rows(spark, path))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_numbering_refuses_files_of_several_jobs(spark, tmp_path):
    path = str(tmp_path / "files")
    for _ in range(2):
        spark.range(50).withColumnRenamed("id", "n").coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="one Spark job"):
        number_stored_rows(spark, path)


def test_recreate_probe_and_list(spark, store):
    assert not store.exists("c") and not store.has_data("c")
    assert store.list_collections().count() == 0
    store.recreate("c", 2)
    assert store.exists("c") and not store.has_data("c")
    with pytest.raises(ValueError, match="no data"):
        store.open("c")
    with pytest.raises(LookupError):
        store.open("other")
    store.write_points("c", points(spark, range(5)))
    assert store.has_data("c")
    info = store.info("c")
    assert (info.vector_size, info.distance, info.points_count) == (2, "Cosine", 5)
    store.recreate("b", 2, "Dot", points(spark, range(3)))
    assert [r["name"] for r in store.list_collections().collect()] == ["b", "c"]
    store.recreate("c", 2)
    assert not store.has_data("c") and store.has_data("b")


def test_writing_replaces(spark, store):
    store.recreate("c", 2)
    store.write_points("c", points(spark, range(5)))
    store.write_points("c", points(spark, range(3), 2.0))
    assert contents(store) == {0: 0.0, 1: 2.0, 2: 4.0}


def test_a_reader_keeps_its_version_during_the_next_write(spark, store):
    store.recreate("c", 2, points=points(spark, range(5)))
    before = store.open("c")
    store.write_points("c", points(spark, range(3)))
    assert before.points.count() == 5 and store.open("c").points.count() == 3


def test_a_failed_write_changes_nothing(spark, store):
    store.recreate("c", 2, points=points(spark, range(5)))
    wrong = points(spark, range(3)).withColumn("vector", F.array(F.lit(1.0)))
    with pytest.raises(Exception, match="vector size 1 instead of 2"):
        store.write_points("c", wrong)
    assert len(contents(store)) == 5


def test_upsert_inserts_and_replaces(spark, store):
    store.recreate("c", 2)
    store.upsert("c", points(spark, range(0, 3)))
    store.upsert("c", points(spark, range(1, 4), 10.0))
    assert contents(store) == {0: 0.0, 1: 10.0, 2: 20.0, 3: 30.0}
    store.upsert("c", points(spark, range(1, 4), 10.0))
    assert contents(store) == {0: 0.0, 1: 10.0, 2: 20.0, 3: 30.0}
    assert store.info("c").points_count == 4


def test_stored_blocks_hold_few_overlapping_ids(spark, store):
    store.recreate("c", 2, points=points(spark, range(200)).repartition(16), block_size=50)
    store.upsert("c", points(spark, range(150, 250)).repartition(16))
    blocks = store.open("c").blocks
    assert sum(b["points"] for b in blocks) == 250 and all(b["points"] <= 50 for b in blocks)
    ranges = sorted((b["min_id"], b["max_id"]) for b in blocks)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert sorted(contents(store)) == list(range(250))


def test_an_upsert_leaves_other_blocks_in_place(spark, store):
    store.recreate("c", 2, points=points(spark, range(200)).repartitionByRange(4, "id"), together=True)
    before = {b["path"] for b in store.open("c").blocks}
    store.upsert("c", points(spark, [3], 7.0))
    after = {b["path"] for b in store.open("c").blocks}
    assert len(before) == 4 and len(before & after) == 3
    store.upsert("c", points(spark, [1000]))  # beyond all blocks
    assert after < {b["path"] for b in store.open("c").blocks}
    assert contents(store)[3] == 21.0 and len(contents(store)) == 201


def test_a_reader_keeps_its_version_through_many_changes(spark, store):
    store.recreate("c", 2, points=points(spark, range(5)))
    before = store.open("c")
    for i in range(3):
        store.upsert("c", points(spark, [i, 50 + i], 9.0))
    assert {r["id"]: r["payload"]["a"] for r in before.points.collect()} == {i: float(i) for i in range(5)}


def test_the_second_of_two_writers_is_refused(spark, store):
    """Both open the same version before either writes."""
    store.recreate("c", 2, points=points(spark, range(5)))
    first, second = store.info("c"), store.info("c")
    store._replace(first, points(spark, range(3)), together=False)
    with pytest.raises(RuntimeError, match="another writer"):
        store._replace(second, points(spark, range(9)), together=False)
    assert len(contents(store)) == 3 and store.info("c").version == first.version + 1


def test_two_writers_that_commit_at_once(spark, store):
    """Neither sees the other's file before it makes its own."""
    store.recreate("c", 2, points=points(spark, range(5)))
    info = replace(store.info("c"), version=2)
    outcomes = []

    def commit(count):
        try:
            outcomes.append(store._commit(replace(info, points_count=count)).points_count)
        except RuntimeError:
            outcomes.append(None)

    store._commit(info)
    commit(7)
    commit(8)
    assert outcomes == [None, None] and store.info("c").points_count == 5
    assert store.changes("c").count() == 2


def test_an_unfinished_change_is_not_seen_and_not_passed_over(spark, store, tmp_path):
    store.recreate("c", 2, points=points(spark, range(5)))
    (left,) = (tmp_path / "_collections").rglob("version-1.json")
    (left.parent / "version-2.json").write_text('{"name": "c", "vers')
    assert store.info("c").version == 1 and len(contents(store)) == 5
    assert store.registry().first()["version"] == 1
    with pytest.raises(RuntimeError, match="version-2.json"):
        store.write_points("c", points(spark, range(3)))


def test_ids_are_unique_at_every_sink(spark, store):
    twice = points(spark, [0, 0, 2])
    with pytest.raises(ValueError, match="more than once"):
        store.recreate("c", 2, points=twice)
    store.recreate("c", 2, points=points(spark, range(3)))
    with pytest.raises(ValueError, match="more than once"):
        store.write_points("c", twice)
    assert len(contents(store)) == 3


def test_hashed_ids_make_a_handful_of_blocks(spark, store):
    ids = [(i * 2654435761 * 40503) % (1 << 60) for i in range(10_000)]
    store.recreate("c", 2, points=points(spark, ids))
    assert len(store.open("c").blocks) <= 16


def test_delete(spark, store, tmp_path):
    store.recreate("c", 2, points=points(spark, range(5)))
    store.recreate("d", 2, points=points(spark, range(5)))
    assert store.delete("c") and not store.exists("c") and not (tmp_path / "c").exists()
    assert not store.delete("c") and store.has_data("d")
    store.recreate("c", 2, points=points(spark, range(2)))
    assert len(contents(store)) == 2


def test_recreate_keeps_one_version_before(spark, store, tmp_path):
    for n in (5, 6, 7):
        store.recreate("c", 2, points=points(spark, range(n)))
        last = store.open("c")
    assert len(list((tmp_path / "c").glob("points-*"))) == 2
    store.recreate("c", 2)
    assert last.points.count() == 7 and len(list((tmp_path / "c").glob("points-*"))) == 1


def jobs_of(spark, name, run):
    """What ``run`` returns, and how many jobs it started."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(tracker.getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_a_page_over_gaps_starts_one_job(spark, store):
    store.recreate("c", 2, points=points(spark, range(0, 600, 3)), block_size=10)
    collection = store.open("c")
    page, jobs = jobs_of(spark, "page", lambda: collection.page(20, 100))
    assert [r["id"] for r in page.points] == list(range(102, 162, 3)) and page.next_offset == 162
    assert jobs == 1


def test_a_page_is_whole_where_ids_bunch(spark, store):
    """The counts promise ids that are elsewhere, so the range grows."""
    ids = [*range(10), *range(100_000, 100_300), 1_000_000]
    store.recreate("c", 2, points=points(spark, ids).coalesce(1), together=True)
    collection = store.open("c")
    found = [(len(p.points), p.next_offset) for p in collection.cursor(100)]
    assert found == [(100, 100_090), (100, 100_190), (100, 100_290), (11, None)]
    assert collection.next_offset(10) == 100_000 and collection.page(5, 2_000_000).points == []


def test_dense_ids_are_published_without_a_shuffle(spark, store):
    rows = points(spark, range(200)).repartitionByRange(4, "id")
    store.recreate("c", 2, points=rows, together=True, block_size=20)
    schema = rows.select("id").schema
    folder = store.open("c").blocks[0]["path"].rpartition("/")[0]
    files = unique.id_ranges(spark, folder, schema)
    assert all(f["steady"] for f in files)
    ranges = [(f["min_id"], f["max_id"]) for f in files]
    assert unique.shared_ranges(ranges) == []
    found, jobs = jobs_of(spark, "unique", lambda: unique.repeated_ids(spark, files, schema))
    assert not found and jobs == 0


def test_spread_ids_are_published_without_a_shuffle_of_ids(spark, store, monkeypatch):
    monkeypatch.setattr(unique, "_grouped", None)
    store.recreate("c", 2, points=points(spark, range(0, 900, 3)).repartitionByRange(4, "id"), together=True, block_size=20)
    assert len(contents(store)) == 300


@pytest.mark.parametrize("ids", [[0, 1, 1, 2], [0, 5, 5, 9], [0, 3, 6, 3], list(range(40)) + [7]])
@pytest.mark.parametrize("together", [False, True])
def test_an_id_twice_is_found_in_a_file_and_between_files(spark, store, ids, together):
    for parts in (1, 3):
        with pytest.raises(ValueError, match="more than once"):
            store.recreate("c", 2, points=points(spark, ids).repartition(parts), together=together)
    assert not store.exists("c")


def test_a_point_without_id_is_refused(spark, store):
    with pytest.raises(ValueError, match="no id"):
        store.recreate("c", 2, points=points(spark, [1, None, 3]))


def test_shared_ranges(monkeypatch):
    assert unique.shared_ranges([(5, 9), (0, 4)]) == []
    assert unique.shared_ranges([(0, 9), (3, 4), (9, 12), (4, 5)]) == [(3, 5), (9, 9)]
    draw = random.Random(5)
    for most in (64, 3):
        monkeypatch.setattr(unique, "_MOST_RANGES", most)
        for _ in range(200):
            ranges = [(a, a + draw.randrange(9)) for a in (draw.randrange(200) for _ in range(20))]
            counted = Counter(i for a, b in ranges for i in range(a, b + 1))
            found = unique.shared_ranges(ranges)
            held = {i for a, b in found for i in range(a, b + 1)}
            assert len(found) <= most and all(x[1] < y[0] for x, y in zip(found, found[1:]))
            assert {i for i, n in counted.items() if n > 1} <= held
            if most == 64:
                assert {i for i, n in counted.items() if n > 1} == held


def test_runs_across_batches():
    files = [([1, 4], [0, 1]), ([], []), ([9, 2, 3], [2, 3, 4]), ([3, 8], [5, 6]), ([50], [0]), ([51], [1])]
    batches = [pa.record_batch([pa.array(x, pa.int64()), pa.array(r, pa.int64())], ["id", "row"]) for x, r in files]
    found = [r for b in unique._runs(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert found == [(1, 9, False), (2, 3, True), (3, 8, False), (50, 51, False)]


def test_upsert_rejects_an_id_twice(spark, store):
    store.recreate("c", 2, points=points(spark, range(3)))
    with pytest.raises(ValueError, match="more than once"):
        store.upsert("c", points(spark, [7, 7]))
    assert len(contents(store)) == 3


def test_many_new_ids_take_one_shuffle(spark):
    plan = plan_of(CollectionStore.merge_many(points(spark, range(9)), points(spark, [1])))
    assert plan.count("Exchange") == 1 and "rangepartitioning(id" in plan


@pytest.mark.parametrize("step", [1, 3])
@pytest.mark.parametrize("block", [4, 1000])
@pytest.mark.parametrize("limit", [7, 10, 1000])
def test_pages_put_together_are_the_whole(spark, store, step, limit, block):
    """Without gaps in the ids and with; the last page full and not; in one
    block or across several, of which some are empty."""
    ids = [i for i in range(5, 65, step) if step == 1 or not 20 < i < 40]
    store.recreate("c", 2, points=points(spark, ids).repartition(3), block_size=block)
    collection = store.open("c")
    for pages in (
        [[r["id"] for r in page.collect()] for page in collection.pages(limit)],
        [[r["id"] for r in page.points] for page in collection.cursor(limit)],
    ):
        assert all(len(p) == limit for p in pages[:-1]) and 0 < len(pages[-1]) <= limit
        assert [i for p in pages for i in p] == list(ids)


def test_page_has_payload_without_vector(spark, store):
    store.recreate("c", 2, points=points(spark, range(20)))
    collection = store.open("c")
    page = collection.scroll(5, 10)
    assert page.columns == ["id", "payload"] and [r["id"] for r in page.collect()] == [10, 11, 12, 13, 14]
    assert collection.next_offset(5, 10) == 15
    assert collection.next_offset(5, 15) is None
    assert collection.scroll(5, 20).count() == 0


def test_page_and_scan_push_down(spark, store):
    store.recreate("c", 2, points=points(spark, range(20)), block_size=4)
    page = plan_of(store.open("c").scroll(5, 10))
    assert "TakeOrderedAndProject" in page
    assert "GreaterThanOrEqual(id,10), LessThanOrEqual(id,14)" in page
    scan = plan_of(store.open("c").scan(["a"]))
    assert "ReadSchema: struct<payload:struct<a:double>>" in scan


def test_scan_gives_doubles(spark, store):
    texts = points(spark, range(3)).withColumn(
        "payload", F.col("payload").withField("b", F.when(F.col("id") == 1, "x").otherwise("2.5"))
    )
    store.recreate("c", 2, points=texts)
    found = store.open("c").scan(["a", "b"], passthrough=["energy_tier"]).orderBy("a").collect()
    assert [(r["a"], r["b"], r["energy_tier"]) for r in found] == [
        (0.0, 2.5, "low"),
        (1.0, None, "low"),
        (2.0, 2.5, "low"),
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store.open("c").scan(["b"], strict=True).collect()
