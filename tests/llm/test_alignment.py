"""Aligned tokens against whole texts encoded one by one, and the pair table."""

import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from featloom.llm import alignment
from featloom.llm import queries as llm
from featloom.llm.perfect_hash import PerfectHash, Table

SCHEMA = "doc_id long, text string"
HARD = [
    "Hello  world, 'tis \n\n a <|endoftext|> test <0x41> é 漢字 \x00 ok",
    " leading", "trailing  ", "trailing \n", "\n\nfirst", "a\n\nb \n c\t d\t\n e", "tab\tand \xa0 nbsp　wide",
    "x" * 300, "   ", "\n", " ", "a b" * 50, "日本語テキスト " * 9, "don't we're I'll 12345 67 ...!!! ??", "<s> </s> <unk>",
    "piece ▁ mark", "full ｗｉｄｔｈ", "😀😀 emoji 👩‍👩‍👧", "a\x1cb c\x1d d", "line break  x", "é" * 40, "=" * 200 + " " + "-" * 99, "soft­hyphen zero​width",
]


class Plain:
    """Whole texts by the libraries themselves, groups by hand."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
            self.names = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
        self.level = alignment._byte_level()

    def groups(self, text):
        if not text:
            return []
        data = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        a_bytes = [bytes(self.level[c] for c in self.names[i]) for i in a]
        b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in b)
        ]
        if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
            return []
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        out, i, j = [], 0, 0
        for cut in sorted(set(a_ends.tolist()) & set(b_ends.tolist())):
            x, y = [], []
            while i < len(a) and a_ends[i] <= cut:
                x.append(a[i])
                i += 1
            while j < len(b) and b_ends[j] <= cut:
                y.append(b[j])
                j += 1
            out.append((x, y))
        return out

    def rows(self, docs):
        """Of (id, text): what the operator is to return."""
        groups = [self.groups(t) for _, t in docs]
        held = Counter()
        for g in groups:
            held.update({(x, y) for xs, ys in g for x in xs for y in ys})
        most = defaultdict(int)
        for (x, _), n in held.items():
            most[x] = max(most[x], n)
        out = []
        for (d, _), g in zip(docs, groups):
            links = [(x, y) for xs, ys in g for x in xs for y in ys]
            text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in g)
            out.append((
                d, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links),
                sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), text,
            ))
        return out, held, most


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def tokenizers():
    return llm.tokenizers()


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, *[x if x is not None else 0 for x in r]))


@pytest.fixture(scope="module")
def supplied(spark, sf_dir, plain):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs, *plain.rows([tuple(r) for r in docs.collect()])


def test_registered_query(spark, sf_dir, supplied):
    _, want, _, _ = supplied
    rows = llm.queries()["op12_alignment"](spark, sf_dir)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want]
    assert by_id(rows.collect()) == by_id(hashed)


def test_pair_table(supplied, tokenizers, monkeypatch):
    """With few rows a vector, so that the vectors are summed in a tree."""
    docs, _, held, most = supplied
    monkeypatch.setattr(alignment, "BUCKETS", 5)
    monkeypatch.setattr(alignment, "ROWS_PER_VECTOR", 300)
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "_COUNTED", 20_000)
    found = alignment.pair_counts(docs.repartition(6), tokenizers).collect()
    assert {(r.a, r.b): r.docs for r in found} == dict(held) and len(found) == len(held)
    assert all(r.best == (r.docs == most[r.a]) and r.pair == r.a * 65536 + r.b for r in found)


@pytest.mark.parametrize("frequent", [0, 200])
def test_pairs_beyond_the_table_are_joined(supplied, tokenizers, monkeypatch, frequent):
    docs, want, _, _ = supplied
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    assert by_id(alignment.aligned(docs, tokenizers).collect()) == by_id(want)


@pytest.mark.parametrize("limits", [(1 << 16, 400_000, 8), (3, 4, 8), (40, 100, 0)])
def test_hard_texts(spark, plain, tokenizers, monkeypatch, limits):
    """Also with few units encoded together and remembered."""
    monkeypatch.setattr(alignment, "_TOGETHER", limits[0])
    monkeypatch.setattr(alignment, "_MOST_UNITS", limits[1])
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "a b"), (None, "a b"), (7, None), (7, None), (8, "")]
    units = alignment.Units(tokenizers)
    for _, text in rows:
        (cut,) = units.of([text or ""])
        groups = b";".join(units.groups[u] for u in cut) if (units.counts[cut, 0] >= 0).all() else b""
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain.groups(text))
        assert groups.decode() == want, text
    if limits[2]:
        want, _, _ = plain.rows(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        assert by_id(alignment.aligned(df, tokenizers).collect()) == by_id(want)


def test_large_groups_pair_their_distinct_ids(tokenizers):
    units = alignment.Units(tokenizers)
    a, b = np.array([5] * 20 + [7] * 30), np.array([1] * 40 + [2] * 10)
    one = np.array([50])
    pairs, times, sizes = units._linked(a, b, one, one, np.array([0]), 1)
    assert dict(zip(pairs.tolist(), times.tolist())) == {5 << 16 | 1: 800, 5 << 16 | 2: 200, 7 << 16 | 1: 1200, 7 << 16 | 2: 300}
    assert sizes.tolist() == [4]


def test_long_texts_and_odd_tables(spark, plain, tokenizers):
    long = "".join(f"word{i % 977} and{i % 13}\n" for i in range(60_000))
    df = spark.createDataFrame([(1, long, 5), (2, "word1 and1", 6)], "doc_id long, text string, `x.y` int")
    got = alignment.aligned(df.withColumns({"pairs": F.lit(1), "_metadata": F.lit(2)}), tokenizers).collect()
    assert by_id(got) == by_id(plain.rows([(1, long), (2, "word1 and1")])[0])
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment.aligned(empty, tokenizers).collect() == []
    nothing = spark.createDataFrame([("k", None)], "doc_id string, text string")
    assert [tuple(r) for r in alignment.aligned(nothing, tokenizers).collect()] == [("k", 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    draw = np.random.default_rng(n)
    keys = np.unique(draw.integers(-(1 << 62), 1 << 62, n))
    hashed = PerfectHash.build(keys)
    assert sorted(hashed.find(keys)) == list(range(len(keys)))
    assert sum(hashed.sizes) * 64 <= 6 * len(keys) + 64 * 30
    again = PerfectHash.of(hashed.sizes, hashed.words)
    assert (again.find(keys) == hashed.find(keys)).all()
    table = Table.build(keys, keys * 2)
    at = table.places(keys)
    assert (table.keys[at] == keys).all() and (table.values[0][at] == keys * 2).all()
    other = np.setdiff1d(draw.integers(-(1 << 62), 1 << 62, 1000), keys)
    assert (table.places(other) == -1).all()


def test_ranks_and_library_agree(tokenizers, sf_dir, spark):
    """A by ranks is used for short units, and gives what the library gives."""
    plain = alignment.Tokenizers(tokenizers.a_json, tokenizers.b_model)
    assert tokenizers.a_ranks is not None and plain.a_ranks is None
    other = json.loads(tokenizers.a_json)
    other["model"]["merges"][0], other["model"]["merges"][1] = other["model"]["merges"][1], other["model"]["merges"][0]
    assert alignment.Tokenizers(json.dumps(other), tokenizers.b_model, tokenizers.a_pattern).a_ranks is None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    for text in [" " + (r.text or "") for r in docs] + HARD:
        assert tokenizers.encode_a(text, 0) == plain.encode_a(text, 0) == tokenizers.encode_a(text, 10_000)


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="not distinct"):
        PerfectHash.build(np.array([4, 4]))
