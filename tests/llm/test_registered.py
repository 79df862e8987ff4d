"""The registered queries on the supplied tables: against SQL, brute force or held-out labels."""

import base64
import glob
import hashlib
import os
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as registered
import corpus_pipeline
from featloom.llm import bpe, queries as llm

QUERIES = llm.queries()
SQL = llm.oracle_sql()
SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS FROM '{path}'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.sql("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY 1").fetchall())


def test_eleven_are_registered():
    names = registered.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.sql(SQL[name])
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    a = sorted(repr([r[c] for c in columns]) for r in ours.collect())
    b = sorted(repr([r[theirs.columns.index(c)] for c in columns]) for r in theirs.fetchall())
    assert a == b


def test_quality_of_held_out_documents(spark, sf_dir, duck):
    labels = dict(duck.sql("SELECT doc_id, quality FROM labels").fetchall())
    rows = QUERIES["op3_quality"](spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    known = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert len(known) > 5
    assert np.mean([p == y for p, y in known]) > 0.9


def test_language_of_held_out_documents(spark, sf_dir, duck):
    langs = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = [r for r in QUERIES["op4_language"](spark, sf_dir).collect() if r.held_out]
    assert len(rows) > 20
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows]) > 0.93


def shingles(text):
    w = WORD.findall(text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def test_fingerprints(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, sf_dir).collect()}
    ids = sorted(texts)
    errors, by_text = [], {}
    for i, d in enumerate(ids):
        text, following = texts[d], texts[ids[(i + 1) % len(ids)]]
        n = len(text) // 4
        edited = text[: len(text) - n] + following[:n]
        r = rows[d]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        a, b = shingles(text), shingles(edited)
        errors.append(abs(r.near_edited - len(a & b) / max(len(a | b), 1)))
    assert np.mean(errors) < 0.1


def test_repeated_passages(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in QUERIES["op6_suffix_dedup"](spark, sf_dir).collect()}
    data = {d: t.encode() for d, t in texts.items()}
    seen = Counter(b[i : i + 200] for b in data.values() for i in range(len(b) - 199))
    for d, b in data.items():
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        r = rows[d]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), int(gone.sum()), runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_tokens(spark, sf_dir, texts):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op8_bpe"](spark, sf_dir).collect():
        text = texts[r.doc_id]
        ids = coder.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_tokens_of_long_pieces():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        content = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours = bpe.coder(content, public_tokenizers.PATTERN)
    r = np.random.default_rng(4)
    for kind in ("abcdefghijklmnopqrstuvwxyz", "e", "ab", "日本語中文的是了", "éèü", "=-*#", " \n\t", "qzxjk"):
        text = "".join(r.choice(list(kind), 6_000))
        assert ours.encode([text])[0].tolist() == theirs.encode_ordinary(text)


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    """Each stage against a plain version of it on what the stage before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = (before.collect(), docs.collect())
        if name != "bpe":
            assert docs.columns == columns

    before, after = kept["quality"]
    assert {r.doc_id for r in after} < {r.doc_id for r in before}
    assert set(after) <= set(before)

    before, after = kept["exact_dedup"]
    least = {}
    for r in before:
        key = SPACE.sub(" ", r.text)
        least[key] = min(least.get(key, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(least.values())

    before, after = kept["jaccard_join"]
    sets = {r.doc_id: shingles(r.text) for r in before}
    label = {d: d for d in sets}

    def root(d):
        return d if label[d] == d else root(label[d])

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in after) == [d for d in ids if root(d) == d]

    before, after = kept["mix"]
    whole = {r.doc_id: r for r in before}
    words = Counter()
    for r in after:
        assert r.text in whole[r.doc_id].text
        assert (r.n_chars, r.source, r.lang) == (len(r.text), whole[r.doc_id].source, whole[r.doc_id].lang)
        words[r.doc_id] += len(WORD.findall(r.text))
    sizes = {d: len(WORD.findall(r.text)) for d, r in whole.items()}
    assert all(words[d] <= 3 * sizes[d] for d in words)
    assert abs(sum(words.values()) - sum(sizes.values())) < 0.1 * sum(sizes.values())

    before, after = kept["bpe"]
    assert len(before) == len(after) and all(r.round_trip and r.n_tokens == len(r.ids) for r in after)
