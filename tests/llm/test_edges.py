"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import random
import tracemalloc
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.llm import bpe, exact_dedup, fingerprints, jaccard_join, language, mixing, quality, suffix_dedup
from featloom.llm import common, url_graph, warc
from featloom.llm.components import components
from featloom.sources.scratch import scratch_path

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
ROWS = [
    (1, "a b  c d e f g", "s"),
    (1, "a b  c d e f g", "s"),
    (2, "a b c d\te f g", None),
    (3, None, "s"),
    (4, "", "t"),
    (5, " \t\n", None),
    (6, "A B C D E F G", "t"),
    (None, "a b c d e f g", "s"),
    (7, "one two", "u"),
    (8, "one  two", "u"),
    (9, LONG, "u"),
    (10, LONG + " end", "t"),
    (11, "héllo wörld 日本語", "t"),
]
SCHEMA = "doc_id long, text string, source string"
# Names that are expressions, and Spark's own for a row's place.
ODD = ["x.y", "a`b", "_metadata"]
CLASHING = ["place", "row", "digest", "id", "size", "n", "name", "of", "score", "k1", "spans", "label"]


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHING:
        df = df.withColumn(c, F.lit(c))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def test_exact_dedup(odd, empty):
    rows = exact_dedup.judge(odd).collect()
    kept = sorted((r.keep_id, r.group_size) for r in rows if r.kept)
    assert kept == [(1, 4), (3, 2), (5, 1), (6, 1), (7, 2), (9, 1), (10, 1), (11, 1)]
    assert all(r.keep_id == 1 for r in rows if r.id is None)
    stay = exact_dedup.survivors(odd)
    assert stay.columns == odd.columns and stay.count() == 8
    assert all(r[c] == c for r in stay.collect() for c in CLASHING)
    assert exact_dedup.judge(empty).count() == 0


def test_exact_dedup_tells_texts_of_equal_digest_apart(odd):
    right = {(r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.judge(odd).collect()}
    weak = exact_dedup.judge(odd, digest=F.lit("same"))
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in weak.collect()} == right


def files_of(spark, rows, **more):
    """``rows`` as stored Parquet files."""
    path = scratch_path(spark, "rows")
    spark.createDataFrame(rows, "doc_id long, text string").withColumns(more).write.parquet(path)
    return spark.read.parquet(path)


def judged(df, **more):
    return sorted((r.id or 0, r.keep_id or 0, r.group_size, r.kept) for r in exact_dedup.judge(df, **more).collect())


def test_exact_dedup_goes_on_from_its_state(spark):
    """Later copies of earlier documents go, one of a smaller id too."""
    state = scratch_path(spark, "state")
    assert judged(files_of(spark, [(5, "x  a"), (6, "y"), (9, "y")]), state_path=state) == [
        (5, 5, 1, True), (6, 6, 2, True), (9, 6, 2, False),
    ]
    assert judged(files_of(spark, [(2, "x a"), (8, "x\ta"), (None, "y"), (7, "z"), (3, "z")]), state_path=state) == [
        (0, 6, 3, False), (2, 5, 3, False), (3, 3, 2, True), (7, 3, 2, False), (8, 5, 3, False),
    ]
    assert judged(files_of(spark, [(1, "z"), (4, "new")]), state_path=state) == [(1, 3, 3, False), (4, 4, 1, True)]
    assert judged(files_of(spark, []), state_path=state) == []


def test_exact_dedup_compares_texts_with_earlier_ones(spark):
    state = scratch_path(spark, "state")
    same = {"state_path": state, "digest": F.lit("same")}
    judged(files_of(spark, [(5, "x")]), **same)
    assert judged(files_of(spark, [(6, "x"), (7, "y"), (8, "y")]), **same) == [(6, 5, 2, False), (7, 7, 2, True), (8, 7, 2, False)]


def test_exact_dedup_in_several_batches(odd):
    once = judged(odd)
    assert judged(odd.repartition(7), bytes_per_batch=1) == once


@pytest.mark.parametrize("stage", [exact_dedup.survivors, jaccard_join.firsts])
def test_exploded_rows_have_places_of_their_own(spark, stage):
    """Both rows of an exploded one have the place of that one."""
    twice = files_of(spark, [(1, "a b c d e f"), (2, "u v w x y z")]).withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    assert sorted(r.doc_id for r in stage(twice).collect()) == [1, 2]
    mix = mixing.mixed(*(lambda d: (d, mixing.plan(d)))(common.located(twice.withColumns({"source": F.lit("s"), "n_chars": F.lit(1)}))))
    assert mix.count() == 4
    assert fingerprints.with_next(twice).count() == 4 and suffix_dedup.without_repeats(twice).count() == 4


def test_names_that_are_expressions(spark):
    """Of every operator that returns the columns of its documents."""
    names = {c: F.lit(i) for i, c in enumerate(ODD)}
    docs = files_of(spark, [(1, "a b c d e f"), (2, "u v w x y z"), (3, None)], source=F.lit("s"), n_chars=F.lit(1), **names)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    for df in (docs, files_of(spark, [(1, "a b c d e f"), (2, None)], source=F.lit("s"), n_chars=F.lit(1), **names)):
        located = common.located(df)
        out = {
            "survivors": exact_dedup.survivors(df), "firsts": jaccard_join.firsts(df),
            "mixed": mixing.mixed(located, mixing.plan(located)),
        }
        for name, found in out.items():
            assert found.columns == df.columns, name
            assert {tuple(r[-3:]) for r in found.collect()} == {(0, 1, 2)}, name
        pages = df.withColumns({"url": F.lit("http://a.org/x"), "html": F.col("text")})
        judged_pages = url_graph.judge(pages, [])
        assert set(ODD) <= set(judged_pages.columns) and judged_pages.count() == df.count()


def test_warc(spark):
    pages = [
        (1, "http://a/", "<p>x"), (2, None, "<p>x"), (3, "http://ü/ b", None), (4, "u", ""),
        (None, "v", "<p>x"), (5, "w", "y" * 300_000), (5, "w", "y" * 300_000),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("shard", F.lit(1))
    spec = warc.WarcSpec(shard_records=3, file_bytes=500)
    written = {}
    for _ in range(2):
        root = scratch_path(spark, "warc")
        manifest = warc.write_archives(table, root, spec)
        written[root] = sorted(tuple(r) for r in manifest.collect())
        rows = warc.read_archives(spark, root, manifest).collect()
        got = sorted((r.page_id or 0, r.record_type, r.payload_bytes, r.refers_to or 0) for r in rows)
        assert got == [
            (0, "revisit", 4, 1), (1, "response", 4, 0), (2, "revisit", 4, 1), (3, "response", 0, 0),
            (4, "revisit", 0, 3), (5, "response", 300_000, 0), (5, "revisit", 300_000, 5),
        ]
        texts = {r.page_id: bytes(r.payload) for r in rows if r.payload is not None}
        assert texts == {1: b"<p>x", 3: b"", 5: b"y" * 300_000}
    a, b = written.values()
    assert a == b and len(a) > 2
    nothing = warc.write_archives(table.limit(0), scratch_path(spark, "warc"))
    assert nothing.count() == 0


def test_warc_shards_do_not_depend_on_how_they_are_dealt(spark, monkeypatch):
    """As many tasks as files read; each record has an id of its own; ranges of several
    shards give the same bytes; nothing temporary stays."""
    pages = [(i // 2, f"http://h/{i % 5}", "same" if i % 3 else f"page {i // 2}") for i in range(90)]
    table = spark.createDataFrame(pages + [(7, "u", "same")] * 9, "page_id long, url string, html string")
    spec = warc.WarcSpec(shard_records=8, file_bytes=1500)
    made = []
    for most in (100_000, 3, 1):
        monkeypatch.setattr(warc, "MOST_RANGES", most)
        root = scratch_path(spark, "warc")
        manifest = warc.write_archives(table, root, spec)
        made.append(sorted(tuple(r) for r in manifest.collect()))
        read = warc.read_archives(spark, root, manifest)
        assert read.rdd.getNumPartitions() == min(len(made[0]), most)
        assert read.count() == 99
    assert made[0] == made[1] == made[2] and len({r[0] for r in made[0]}) > 8
    folder = Path(root.removeprefix("file:"))
    assert not (folder / "_temporary").exists()
    heads = []
    for file in folder.glob("*.warc.gz"):
        with file.open("rb") as stream:
            heads += [dict(x.split(": ", 1) for x in m.split(b"\r\n\r\n")[0].decode().split("\r\n")[1:]) for m in warc.members(stream)]
    ids = {h["WARC-Record-ID"]: h["WARC-Type"] for h in heads}
    assert len(heads) == len(ids) == 99
    assert all(ids[h["WARC-Refers-To"]] == "response" for h in heads if h["WARC-Type"] == "revisit")


def test_a_damaged_archive_is_refused():
    spec = warc.WarcSpec()
    good = warc.record(1, "u", b"payload", None, spec)
    assert warc.parse(good)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))


def test_a_replaced_archive_is_refused(spark):
    """As many valid records, but not the manifest's bytes."""
    made = []
    for text in "xy":
        root = scratch_path(spark, "warc")
        table = spark.createDataFrame([(1, "u", text), (2, "v", None)], "page_id long, url string, html string")
        made.append((root, warc.write_archives(table, root)))
    (root, manifest), (_, other) = made
    assert warc.read_archives(spark, root, manifest).count() == 2
    assert [r.records for r in manifest.collect()] == [r.records for r in other.collect()] == [2]
    with pytest.raises(Exception, match="differs from the manifest"):
        warc.read_archives(spark, root, other).collect()


def test_quality(spark, odd, empty):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (7, 0), (8, 0), (9, None), (None, 1)], "doc_id long, quality int"
    )
    model = quality.fit(odd, labels, F.lit(True))
    rows = quality.scored(odd, model, into="rating").collect()
    assert len(rows) == len(ROWS) and all(0 <= r.rating <= 1 for r in rows)
    same = [r.rating for r in rows if r.doc_id == 1]
    assert abs(same[0] - same[1]) < 1e-6
    assert quality.scored(empty, model, into="rating").count() == 0
    alone = quality.fit(odd, labels.where("quality = 1"), F.lit(True))
    assert {r.rating for r in quality.scored(odd, alone, into="rating").collect()} == {1.0}
    none = quality.fit(odd, labels.limit(0), F.lit(True))
    assert {r.rating for r in quality.scored(odd, none, into="rating").collect()} == {1.0}


def test_quality_of_a_long_text_is_that_of_its_parts():
    model, spec = quality.Model(quality.QualitySpec()), quality.QualitySpec(passage_words=10)
    text = b" ".join(b"%d" % i for i in range(2_000))
    x, owner = quality.passages([text], 10)
    _, weight, z = model.sums(x, owner, 1)
    # Cut where passages end, parts give the same sums but for what knows the length.
    assert abs(model.finish(weight, z)[0] - model._score_long(text, spec)[0]) < 1e-3


@pytest.mark.parametrize("chunk", [64, 700, 5_000])
def test_quality_encodes_a_text_in_slices_as_the_whole(chunk):
    """Slices of passages, also of passages longer than a slice."""
    model, spec = quality.Model(quality.QualitySpec()), quality.QualitySpec(passage_words=10)
    r = random.Random(8)
    words = [r.choice(["the", "the", "Ünï", "x1|", "a" * 90, "b" * 1_500]) for _ in range(499)]
    for text in ("".join(w + r.choice([" ", "  ", " \n"]) for w in words), "  \t" + " ".join(words), " " * 900, "é" * 900, "z"):
        data = text.encode()
        x, owner = quality.passages([data], 10)
        parts = list(quality.encoded(data, 10, chunk))
        assert np.array_equal(np.concatenate(parts), x)
        assert len(x) < 50 or len(parts) > 3
        _, weight, z = model.sums(x, owner, 1)
        assert abs(model.finish(weight, z)[0] - model._score_long(data, spec, chunk)[0]) < 1e-5


def test_quality_scores_a_text_above_the_slice_size_as_the_whole():
    model, spec = quality.Model(quality.QualitySpec()), quality.QualitySpec()
    text = b" ".join(b"%d" % (i * 7919 % 100_003) for i in range(400_000)) + b" !!"
    assert len(text) > 2 * quality.CHUNK
    _, weight, z = model.sums(*quality.passages([text], spec.passage_words), 1)
    assert abs(model.finish(weight, z)[0] - model.score([text], spec)[0]) < 1e-6


def test_quality_learns_from_passages_spread_over_a_text():
    text = b" ".join(b"%d" % (i * 31 % 997) for i in range(5_000))
    x, _ = quality.passages([text], 10)
    for most, chunk in ((7, 300), (7, 1 << 20), (499, 300), (500, 300), (900, 1 << 20)):
        assert np.array_equal(quality.sampled(text, 10, most, chunk), x[quality._spread(len(x), most)])
    assert len(quality.sampled(text, 10, 7)) == 7 and len(quality.sampled(b"", 10, 7)) == 1


def test_quality_learns_from_a_text_of_30_mb_in_little_memory():
    text = b"some words of a long text | " * 1_100_000
    tracemalloc.start()
    x = quality.sampled(text, 48, 128)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(x) == 128 and peak < 300 << 20


def test_quality_gradients():
    spec = quality.QualitySpec(hidden=3, attention=2)
    r = np.random.default_rng(1)
    model = quality.Model(spec)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, owner, y = r.random((5, quality.WIDTH)), np.array([0, 0, 1, 1, 1]), np.array([1.0, 0.0])

    def loss():
        _, weight, z = model.sums(x, owner, 2)
        p = model.finish(weight, z)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for k, d in model.gradients(x, owner, y).items():
        at = np.unravel_index(np.abs(d).argmax(), d.shape)
        old = model.p[k][at]
        model.p[k][at] = old + 1e-5
        up = loss()
        model.p[k][at] = old - 1e-5
        down = loss()
        model.p[k][at] = old
        assert abs((up - down) / 2e-5 - d[at]) < 1e-4


def test_language(spark, empty):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr"),
         ("el gato y el perro", "es"), ("xyz xyz xyz", "zz")] * 6)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 !!", "en"), (103, "the dog " * 200_000, None), (104, "der hund", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    model = language.fit(docs, F.lit(True))
    got = {r.doc_id: r.language for r in language.predicted(docs, model).collect()}
    assert [got[i].lang for i in (100, 101, 102)] == ["und"] * 3 and got[100].score == 0
    assert got[103].lang == "en" and got[104].lang == "de"
    assert all(got[i].lang == lang for i, _, lang in rows)
    assert language.predicted(docs.limit(0), model).count() == 0
    nothing = language.fit(docs.limit(0), F.lit(True))
    assert {r.language.lang for r in language.predicted(docs, nothing).collect()} == {"und"}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_language_inputs_do_not_depend_on_slices(size):
    texts = ["the cat", "  ab  c\t\u0130d ", "1", "a", "\u039f\u0394\u039f\u03a3 \u03a3\u0391\u03a3 x", "\U0001d400 zw\u00f6lf -- 12 \ufb01n"]
    for text in texts:
        assert (language.vector(text, 512, size) == language.vector(text, 512)).all()
    assert language.vector("", 512, size).sum() == 0


def test_fingerprints(spark, odd, empty):
    rows = fingerprints.with_next(odd).select(
        "id", "text", fingerprints.written(F.col("sketch")).alias("f"),
        fingerprints.likeness(F.col("sketch"), F.col("next_sketch")).alias("near"), "next_start",
    ).collect()
    assert len(rows) == len(ROWS)
    prints = {}
    for r in rows:
        assert prints.setdefault(r.text, r.f) == r.f and 0 <= r.near <= 1
    of = {r.id: r for r in rows}
    assert of[3].near == of[4].near == 1.0  # nothing beside nothing
    assert of[5].near == 0.0 and of[9].near > 0.9
    assert of[11].next_start == "a b"  # after the last comes the first, the null id
    assert fingerprints.with_next(empty).count() == 0


def test_sketches_merge_and_contain(spark):
    half, whole = " ".join(f"a{i}" for i in range(3000)), " ".join(f"a{i}" for i in range(6000))
    rest = " ".join(f"a{i}" for i in range(2996, 6000))
    df = spark.createDataFrame([(half, whole, rest)], "x string, y string, z string")
    for c in "xyz":
        df = fingerprints.with_sketch(df, c, f"s{c}")
    x, y, z = (F.col(f"s{c}") for c in "xyz")
    r = df.select(
        fingerprints.containment(x, y).alias("xy"), fingerprints.containment(y, x).alias("yx"),
        (fingerprints.written(fingerprints.merged(x, z)) == fingerprints.written(y)).alias("same"),
    ).first()
    assert r.xy == 1.0 and abs(r.yx - 0.5) < 0.06 and r.same


@pytest.mark.parametrize("words, fraction", [(4, 1), (60, 1), (100, 1 / 2), (200, 1 / 4), (800, 1 / 8)])
def test_likeness_by_length(spark, words, fraction):
    """A fixed share of the hashes is kept at each length, and the likeness has no
    bias and the spread of so large a sample."""
    shift, pairs = words // 4, 200
    rows = [(" ".join(f"p{p}w{i}" for i in range(words)), " ".join(f"p{p}w{i}" for i in range(shift, shift + words)))
            for p in range(pairs)]
    df = spark.createDataFrame(rows, "x string, y string").coalesce(2)
    for c in "xy":
        df = fingerprints.with_sketch(df, c, f"s{c}")
    x, y = F.col("sx"), F.col("sy")
    got = df.select("sx", fingerprints.likeness(x, y).alias("near"), fingerprints.containment(x, y).alias("part")).collect()
    a = {tuple(range(i, i + min(words, 5))) for i in range(max(words - 4, 1))}
    b = {tuple(j + shift for j in s) for s in a}
    true, kept = len(a & b) / len(a | b), fraction * len(a | b)
    assert {r.sx.limit for r in got} == {int((1 << 63) * fraction) - 1}
    assert abs(np.mean([len(r.sx.hashes) for r in got]) - fraction * len(a)) < 0.05 * len(a) * (fraction < 1) + 1e-9
    errors, shares = np.array([r.near - true for r in got]), np.array([r.part - len(a & b) / len(a) for r in got])
    if fraction == 1:
        assert not errors.any() and not shares.any()
    else:
        spread = np.sqrt(true * (1 - true) / kept)
        assert abs(errors.mean()) < 4 * spread / np.sqrt(pairs) and np.sqrt((errors**2).mean()) < 1.3 * spread
        assert abs(shares.mean()) < 0.03


def test_short_texts_in_long_ones(spark):
    """What the sketches cannot tell is null; nothing is in everything empty only."""
    rows = [(" ".join(f"a{i}" for i in range(n)), " ".join(f"a{i}" for i in range(4000))) for n in (0, 5, 40, 300)]
    df = spark.createDataFrame(rows, "x string, y string").coalesce(1)
    for c in "xy":
        df = fingerprints.with_sketch(df, c, f"s{c}")
    x, y = F.col("sx"), F.col("sy")
    got = df.select("sx", "sy", fingerprints.containment(x, y).alias("part")).collect()
    for r in got:
        comparable = [h for h in r.sx.hashes if h <= r.sy.limit]
        assert r.part == (1.0 if comparable else 0.0 if not r.sx.hashes else None)
    assert got[0].part == 0.0 and got[3].part == 1.0


def brute_passages(texts, length):
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                    np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return out


@pytest.mark.parametrize("class_rows", [100_000, 2])
def test_passages(spark, class_rows):
    """Also with every class large, and so settled window by window."""
    r = random.Random(5)
    piece = ["".join(r.choice("ab c") for _ in range(r.randint(10, 60))) for _ in range(12)]
    texts = ["".join(r.choice(piece) for _ in range(r.randint(0, 9))) for _ in range(60)]
    texts += [None, "", "x" * 500, "xy" * 100, "é" * 90, texts[0], texts[0], "a" * 19, "a" * 20, LONG[:3000]]
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)])
    spec = suffix_dedup.PassageSpec(length=20, class_rows=class_rows, task_rows=50)
    rows = {q.doc_id: q.found for q in suffix_dedup.without_repeats(docs, spec).collect()}
    for i, (gone, runs, kept) in enumerate(brute_passages([(t or "").encode() for t in texts], 20)):
        assert (rows[i].n_removed, rows[i].n_spans, bytes(rows[i].kept)) == (gone, runs, kept)


def test_passages_with_slashes_around_the_anchor(spark):
    """In large classes; windows of 20 bytes that differ only in what is left of the anchor."""
    r = random.Random(6)
    word = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    texts = []
    for _ in range(150):
        anchor, rest = word(10), word(8)
        texts += [f"a{anchor}/{rest}", f"a/{anchor}{rest}", f"{word(5)}{anchor}{word(5)}"]
    docs = frame(spark, [(i, t, None) for i, t in enumerate(texts)])
    spec = suffix_dedup.PassageSpec(length=20, class_rows=1, task_rows=50)
    rows = {q.doc_id: q.found for q in suffix_dedup.without_repeats(docs, spec).collect()}
    for i, (gone, runs, kept) in enumerate(brute_passages([t.encode() for t in texts], 20)):
        assert (rows[i].n_removed, rows[i].n_spans, bytes(rows[i].kept)) == (gone, runs, kept)


def test_passages_of_empty_table(empty):
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_urls(spark):
    rules = [url_graph.Rule("org", "/", True), url_graph.Rule("a.org", "/x", False), url_graph.Rule("bad.com", "/", False)]
    link = '<a class="q" href="{}">'
    pages = [
        (1, "http://WWW.A.org/x1", None), (2, "http://a.org", None), (3, None, None), (4, "a.org/x", ""),
        (5, "https://bad.com/", link.format("http://other.net/")), (6, "http://friend.net/", link.format("//bad.com/p")),
        (7, "http://other.net/?http://a.org/", None), (8, "http://sub.bad.com/", None), (8, "http://sub.bad.com/", None),
        (9, "http://alone.net#x/y", link.format("/own")),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_graph.judge(table, rules).collect()}
    # Blocked by the graph: 2 lies above a blocked host, 6 links to one.
    assert got == {
        1: ("www.a.org", "/x1", "a.org/x", "block"), 2: ("a.org", "", None, "block"),
        3: ("", "", None, "allow"), 4: ("", "", None, "allow"), 5: ("bad.com", "/", "bad.com/", "block"),
        6: ("friend.net", "/", None, "block"), 7: ("other.net", "/", None, "allow"),
        8: ("sub.bad.com", "/", "bad.com/", "block"), 9: ("alone.net", "", None, "allow"),
    }
    assert url_graph.judge(table, rules).count() == len(pages)
    assert url_graph.judge(table.limit(0), rules).count() == 0


def test_urls_far_from_all_seeds(spark):
    """Sixteen hosts in a row, the last blocked: who links to it, over others, is suspect."""
    rules = [url_graph.Rule("h16.net", "/", False), url_graph.Rule("good.org", "/", True)]
    pages = [(i, f"http://h{i}.net/", f'<a href="http://h{i + 1}.net/">') for i in range(1, 17)]
    pages += [(20, "http://good.org/", '<a href="http://fine.org/">'), (21, "http://fine.org/", None)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in url_graph.judge(table, rules).collect()}
    assert got == {**{i: "block" for i in range(1, 17)}, 20: "allow", 21: "allow"}
    with pytest.raises(RuntimeError, match="after 4 rounds"):
        url_graph.judge(table, rules, url_graph.GraphSpec(most_steps=4))


def test_host_scores_are_those_of_the_equations(spark):
    """Against the solution of the linear equations, on a graph with circles."""
    r, n, damping = random.Random(2), 30, 0.85
    weight = np.zeros((n, n))
    for i in range(n):
        for j in {(i + 1) % n, r.randrange(n)} - {i}:
            weight[i, j] = r.randint(1, 3)
    seed = {"trust": {0: 1, 3: 50}, "distrust": {7: 2}}
    edges = [(f"h{i}", f"h{j}", int(weight[i, j])) for i in range(n) for j in range(n) if weight[i, j]]
    seeds = [(f"h{i}", kind, s) for kind, of in seed.items() for i, s in of.items()]
    rows = url_graph.host_scores(
        spark.createDataFrame(edges, "source string, target string, weight long"),
        spark.createDataFrame(seeds, "host string, kind string, seed long"),
        url_graph.GraphSpec(),
    ).collect()
    assert len(rows) == n
    for kind, w in (("trust", weight), ("distrust", weight.T)):
        start = np.array([(1 - damping) * seed[kind].get(i, 0) for i in range(n)])
        right = np.linalg.solve(np.eye(n) - damping * (w / w.sum(axis=1, keepdims=True)).T, start)
        for q in rows:
            assert q[kind] == pytest.approx(right[int(q.host[1:])], rel=1e-6)


def test_tokens_round_trip():
    ranks = b"".join(_line(bytes([b]), b) for b in range(256))
    ranks += b"".join(_line(t, 256 + i) for i, t in enumerate([b"ab", b"bc", b"abc", b"aa", b" a"]))
    coder = bpe.Coder(ranks, r" ?\S+|\s+")
    texts = [None, "", "abc", "aaab", " abc  ab\n", "日本 abc", "a" * 3001, "b a" * 5000, "\0a b"]
    ids, counts = coder.encode(texts)
    ends = np.cumsum(counts)
    for text, end, n in zip(texts, ends, counts):
        assert coder.decode(ids[end - n : end].tolist()) == (text or "").encode()
    assert ids[: counts[2]].tolist() == [258]  # a whole token comes before its merges
    assert ids[counts[2] : counts[2] + counts[3]].tolist() == [259, 256]  # leftmost of least rank
    with pytest.raises(KeyError):
        coder.decode([9999])


@pytest.mark.parametrize("limit", [1, 3, 40, 1_000_000])
def test_long_pieces_have_the_ids_of_single_merges(monkeypatch, limit):
    """Cut where no token goes across or queued: the leftmost pair of least rank first."""
    monkeypatch.setattr(bpe, "PIECE", limit)
    tokens = [b"ab", b"bc", b"aa", b"aab", b"aaaa", b"bca", b"cd", b"abab", b"dd", b"aabc"]
    ids = {**{bytes([b]): b for b in range(256)}, **{t: 256 + i for i, t in enumerate(tokens)}}
    coder = bpe.Coder(b"".join(_line(t, i) for t, i in ids.items()), r"\S+|\s+")
    assert coder.inside.sum() == 7 and not coder.inside[ord("c"), ord("b")]

    def merged(piece):
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            ranks = [ids.get(a + b, 9_999) for a, b in zip(parts, parts[1:])]
            if not ranks or (least := min(ranks)) == 9_999:
                return [ids[p] for p in parts]
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    r = random.Random(5)
    pieces = ["".join(r.choice("aaabbcd") for _ in range(r.randint(2, 90))).encode() for _ in range(200)]
    pieces += [b"a" * 77, b"ab" * 30, "äa".encode() * 9]
    for piece, got in zip(pieces, coder.merge(pieces)):
        assert got.tolist() == ([ids[piece]] if piece in ids else merged(piece))


def test_a_run_of_a_million_letters():
    ranks = b"".join(_line(bytes([b]), b) for b in range(256)) + _line(b"aa", 256) + _line(b"aaaa", 257)
    ids, counts = bpe.Coder(ranks, r"\S+|\s+").encode(["a" * 1_000_003])
    assert counts.tolist() == [250_002] and ids[-2:].tolist() == [256, 97] and set(ids[:-2].tolist()) == {257}


def _line(token, rank):
    import base64

    return base64.b64encode(token) + b" %d\n" % rank


def test_jaccard_join(odd, empty):
    rows = jaccard_join.classes(odd).collect()
    assert len(rows) == len(ROWS)
    got = {r.id: (r.n, r.component_id, r.links) for r in rows}
    assert got[1] == got[2][:1] + (1, 4) and got[6] == (3, 1, 4) and got[None] == (3, 1, 4)
    assert got[3] == (0, 3, 0) and got[4] == (0, 4, 0) and got[5] == (0, 5, 0)
    assert got[7] == (1, 7, 1) and got[8] == (1, 7, 1)
    assert got[9][1] == got[10][1] == 9 and got[11] == (1, 11, 0)
    stay = jaccard_join.firsts(odd)
    assert stay.columns == odd.columns
    assert sorted(r.doc_id for r in stay.collect()) == [1, 3, 4, 5, 7, 9, 11]
    assert jaccard_join.classes(empty).count() == 0


@pytest.mark.parametrize("block", [500_000, 200])
def test_jaccard_join_against_all_pairs(spark, block):
    """A family of texts some of which link only through others, also in small blocks."""
    r = random.Random(3)
    texts = []
    for f in range(6):
        base = [f"{f}w{i}" for i in range(r.randint(4, 60))]
        for _ in range(12):
            words = list(base)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = f"new{r.random()}"
            texts.append(" ".join(words))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))})
    label, links = list(range(len(texts))), [0] * len(texts)

    def root(i):
        return i if label[i] == i else root(label[i])

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spec = jaccard_join.JoinSpec(block=block, frequent=3)
    rows = {q.id: q for q in jaccard_join.classes(docs, spec).collect()}
    assert [(rows[i].component_id, rows[i].links) for i in range(len(texts))] == [(root(i), links[i]) for i in range(len(texts))]


def test_jaccard_lists_meet_in_any_number_of_buckets(spark):
    """Also with more buckets than members."""
    docs = spark.createDataFrame(
        [(i, " ".join(f"{i % 5}w{j + (j == 29) * i}" for j in range(30))) for i in range(20)], "doc_id long, text string"
    )
    rows = [
        sorted(map(tuple, jaccard_join.classes(docs, jaccard_join.JoinSpec(list_entries=n)).select("id", "component_id", "links").collect()))
        for n in (2_000_000, 1)
    ]
    assert rows[0] == rows[1] and {r[1] for r in rows[0]} == set(range(5))


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    got = {r.vertex: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


def test_mix(spark, odd, empty):
    spec = mixing.MixSpec(block=7, slots_per_shard=16)
    mix = mixing.plan(odd, spec)
    rows = mixing.totals(mix).collect()
    assert len(rows) == len(ROWS)
    size = sum(r.size for r in rows)
    targets = {r.source: (r.source_size, r.target) for r in rows}
    assert abs(sum(t for _, t in targets.values()) - size) < 1e-6 * size
    assert all(t <= 3 * s + 1e-9 for s, t in targets.values())
    for source, (_, target) in targets.items():
        assert abs(sum(r.taken for r in rows if r.source == source) - target) <= 7
    assert all(r.taken <= 3 * r.size for r in rows)
    again = mixing.totals(mixing.plan(odd.repartition(3), spec)).collect()
    key = lambda r: (r.id or 0, r.size, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.totals(mixing.plan(empty, spec)).count() == 0
    blank = mixing.totals(mixing.plan(frame(spark, [(1, None, "s"), (2, "", None)]), spec)).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0), (0.0, 0)]


def test_mix_spreads_rows_of_one_id(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 50)
    rows = [(None, "w " * (i % 7), "s") for i in range(1_000)] + [(5, "x", None)] * 300
    spans = mixing.plan(spark.createDataFrame(rows, SCHEMA)).spans
    assert max(r["count"] for r in spans.groupBy("source", "range").count().collect()) <= 200
    got = spans.collect()
    for source, sizes in (("s", sorted(i % 7 for i in range(1_000))), (None, [1] * 300)):
        starts = np.cumsum([0, *sizes[:-1]]).tolist()
        assert sorted((r.start, r.size) for r in got if r.source == source) == list(zip(starts, sizes))


def test_mix_tasks_are_bounded(spark, odd, monkeypatch):
    """However many rows and slots there are, and with the same result."""
    spec = mixing.MixSpec(block=2)
    key = lambda r: (r.id or 0, r.size, r.taken)
    right = sorted(map(key, mixing.totals(mixing.plan(odd, spec)).collect()))
    most = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, value in (("RANGE_ROWS", 1), ("CHUNK", 100), ("TASKS", 2)):
        monkeypatch.setattr(mixing, name, value)
    mix = mixing.plan(odd, spec)
    assert mix.spans.agg(F.max("range")).first()[0] < most
    assert 1 < mix.slots.rdd.getNumPartitions() <= most
    assert sorted(map(key, mixing.totals(mix).collect())) == right


def test_mixed_odd_rows(odd, empty):
    """The mix's texts are the words that ``totals`` counts, with the other columns as they were."""
    spec = mixing.MixSpec(block=7)
    for table in (odd, empty):
        docs = common.located(table)
        mix = mixing.plan(docs, spec)
        out = mixing.mixed(docs, mix, spec)
        assert out.columns == table.columns
        words = {}
        for r in out.collect():
            assert r.place == "place" and 1 <= len(r.text.split()) <= 7
            words[r.doc_id, r.source] = words.get((r.doc_id, r.source), 0) + len(r.text.split())
        taken = {}
        for r in mixing.totals(mix).where("taken > 0").collect():
            taken[r.id, r.source] = taken.get((r.id, r.source), 0) + r.taken
        assert words == taken and bool(taken) == (table is odd)


def test_permutations_are_permutations(spark):
    for n in (1, 2, 10, 1000):
        image = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(99).cast("long")).alias("p"))
        assert sorted(r.p for r in image.collect()) == list(range(n))


def test_plans_of_native_operators_have_no_python(spark, sf_dir):
    from featloom.llm import queries

    for name in ("op1_exact_dedup", "op5_fingerprints", "op10_mix"):
        plan = queries.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
