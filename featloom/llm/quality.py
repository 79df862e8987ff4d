"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``passage_words`` words. Every passage is encoded
(pairs of neighbouring characters by kind of character, word repetition, word
length) and mapped to a hidden vector by a learned layer; a learned gated attention,
softmax over passages of w . (tanh(V h) * sigmoid(U h)), weighs the passages; the
document's score is a logistic function of the weighted vector. Only document
labels are known: what a junk passage is, the attention learns.

The model is learned on the driver from at most about ``per_class`` labelled
documents of each class (a documented bound; which ones is a function of the id
alone) and ``learned_passages`` of each document, spread evenly over the whole text;
they are encoded on the executors, a long text in slices, so a labelled text of any
length takes little memory there and at the driver. Scores are then corrected to the share of the
classes among all labelled documents. Every passage of every document is scored;
the attention is summed up passage group by passage group, so a long text needs
little more memory than a short one. Groups are cut between passages and know how
many the document has, so the inputs are the same as of the whole text at once.

Defined results: a null text counts as empty, and an empty text is one passage
without words; documents without a label or with a null label are not learned from;
with fewer than two classes to learn from the score is the share of label 1 (1 with
no labels at all). Repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from featloom.llm.words import CHUNK, in_chunks, is_space, words_of

# Kinds of bytes: 0-1 lower-case letters (vowels or not), 2 upper case, 3 digits,
# 4 space, 5 line break, 6-14 single marks, 15 any other.
_KIND = np.full(256, 15, np.uint8)
_KIND[97:123] = 1
_KIND[[97, 101, 105, 111, 117]] = 0
_KIND[128:] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[32, 9]] = 4
_KIND[[10, 11, 12, 13]] = 5
for _i, _mark in enumerate(".,!|?:;-#"):
    _KIND[ord(_mark)] = 6 + _i
PAIRS = 256
WIDTH = PAIRS + 5


@dataclass(frozen=True)
class QualitySpec:
    passage_words: int = 48
    per_class: int = 1_500
    # Passages of a document that are learned from, spread evenly over it.
    learned_passages: int = 128
    hidden: int = 24
    attention: int = 16
    epochs: int = 12
    # With few documents, more epochs: at least so many steps.
    steps: int = 800
    batch: int = 32
    rate: float = 0.01
    seed: int = 11


def passages(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Encoded passages of all texts, and the text each belongs to."""
    w = words_of(texts)
    counts = np.bincount(w.text, minlength=len(texts))
    groups = np.maximum(1, -(-counts // size))
    first_group = np.cumsum(groups) - groups
    owner = np.repeat(np.arange(len(texts)), groups)
    first_word = np.cumsum(counts) - counts
    of_word = first_group[w.text] + (np.arange(len(w.text)) - first_word[w.text]) // size
    n = len(owner)
    # A byte belongs to the passage of the last word that has begun, or the text's first.
    begins = np.concatenate([w.text_starts, w.starts])
    passage = np.concatenate([first_group, of_word])
    order = np.argsort(begins, kind="stable")
    begins, passage = begins[order], passage[order]
    # At equal places the word comes after its text's begin.
    of_byte = np.repeat(passage, np.diff(np.append(begins, len(w.buffer))))
    kind = _KIND[w.buffer].astype(np.int64)
    pair = of_byte[:-1] * PAIRS + kind[:-1] * 16 + kind[1:]
    # A text's last pair is with the break after it, not with the next text.
    pair = np.delete(pair, w.text_starts[1:] - 1)
    pairs = np.bincount(pair, minlength=n * PAIRS)[: n * PAIRS].reshape(n, PAIRS)
    x = np.zeros((n, WIDTH), np.float32)
    x[:, :PAIRS] = np.sqrt(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1))
    if len(of_word):
        hashes = w.hashes()
        in_passage = np.bincount(of_word, minlength=n)
        order = np.lexsort((hashes, of_word))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (of_word[order][1:] != of_word[order][:-1])
        distinct = np.bincount(of_word[order][new], minlength=n)
        same = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
        repeated = np.bincount(of_word[1:][same], minlength=n)
        letters = np.bincount(of_word, weights=w.ends - w.starts, minlength=n)
        some = np.maximum(in_passage, 1)
        x[:, PAIRS] = distinct / some
        x[:, PAIRS + 1] = repeated / some
        x[:, PAIRS + 2] = np.minimum(letters / some / 10, 3)
        x[:, PAIRS + 3] = in_passage / size
    x[:, PAIRS + 4] = np.log1p(np.bincount(owner, minlength=len(texts)))[owner] / 5
    return x, owner


class Model:
    """Encoder, gated attention and classifier, with their gradients."""

    NAMES = ("e", "eb", "v", "vb", "u", "ub", "w", "c", "cb")

    def __init__(self, spec: QualitySpec):
        r = np.random.default_rng(spec.seed)
        h, a = spec.hidden, spec.attention
        draw = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        zero = lambda *s: np.zeros(s, np.float32)
        self.p = dict(e=draw(WIDTH, h) * 3, eb=zero(h), v=draw(h, a), vb=zero(a), u=draw(h, a), ub=zero(a),
                      w=draw(a), c=draw(h), cb=zero(1))
        self.shift, self.constant = 0.0, None

    def _forward(self, x: np.ndarray):
        p = self.p
        h = np.tanh(x @ p["e"] + p["eb"])
        t = np.tanh(h @ p["v"] + p["vb"])
        g = 1 / (1 + np.exp(-(h @ p["u"] + p["ub"])))
        return h, t, g, (t * g) @ p["w"]

    def gradients(self, x: np.ndarray, owner: np.ndarray, y: np.ndarray):
        """Gradients of the mean loss over bags 0..len(y)-1; owner is sorted."""
        p, n = self.p, len(y)
        h, t, g, s = self._forward(x)
        starts = np.searchsorted(owner, np.arange(n))
        a = np.exp(s - np.maximum.reduceat(s, starts)[owner])
        a /= np.add.reduceat(a, starts)[owner]
        z = np.add.reduceat(a[:, None] * h, starts)
        score = 1 / (1 + np.exp(-(z @ p["c"] + p["cb"])))
        d = (score - y) / n
        dz = d[:, None] * p["c"]
        da = (h * dz[owner]).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, starts)[owner])
        dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
        dh = (a[:, None] * dz[owner] + dt @ p["v"].T + dg @ p["u"].T) * (1 - h * h)
        return dict(e=x.T @ dh, eb=dh.sum(0), v=h.T @ dt, vb=dt.sum(0), u=h.T @ dg, ub=dg.sum(0),
                    w=(t * g).T @ ds, c=z.T @ d, cb=d.sum(keepdims=True))

    def fit(self, x: np.ndarray, owner: np.ndarray, y: np.ndarray, spec: QualitySpec) -> None:
        r = np.random.default_rng(spec.seed)
        starts = np.searchsorted(owner, np.arange(len(y) + 1))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        each = -(-len(y) // spec.batch)
        epochs = max(spec.epochs, -(-spec.steps // each))
        total = epochs * each
        for _ in range(epochs):
            order = r.permutation(len(y))
            for at in range(0, len(y), spec.batch):
                bags = order[at : at + spec.batch]
                rows = np.concatenate([np.arange(starts[b], starts[b + 1]) for b in bags])
                own = np.repeat(np.arange(len(bags)), starts[bags + 1] - starts[bags])
                step += 1
                rate = spec.rate * (1 - 0.9 * step / total)
                for k, d in self.gradients(x[rows], own, y[bags]).items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    q[k] = 0.999 * q[k] + 0.001 * d * d
                    up = m[k] / (1 - 0.9**step) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8)
                    self.p[k] = (self.p[k] - rate * up - 1e-5 * self.p[k]).astype(np.float32)

    def sums(self, x: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per bag: largest attention, and the weights' and weighted vectors' sums to it."""
        h, _, _, s = self._forward(x)
        starts = np.searchsorted(owner, np.arange(n))
        top = np.maximum.reduceat(s, starts)
        a = np.exp(s - top[owner])
        return top, np.add.reduceat(a, starts), np.add.reduceat(a[:, None] * h, starts)

    def finish(self, weight: np.ndarray, z: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(weight), self.constant)
        logit = (z / weight[:, None]) @ self.p["c"] + self.p["cb"] + self.shift
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -50, 50)))

    def score(self, texts: Iterable[bytes], spec: QualitySpec) -> np.ndarray:
        out = []
        for group in in_chunks(texts, CHUNK // 2):
            if len(group) == 1 and len(group[0]) > CHUNK:
                out.append(self._score_long(group[0], spec))
            else:
                _, weight, z = self.sums(*passages(group, spec.passage_words), len(group))
                out.append(self.finish(weight, z))
        return np.concatenate(out) if out else np.zeros(0)

    def _score_long(self, text: bytes, spec: QualitySpec, chunk: int = CHUNK) -> np.ndarray:
        top, weight, z = None, 0.0, 0.0
        for x in encoded(text, spec.passage_words, chunk):
            t, a, b = self.sums(x, np.zeros(len(x), np.int64), 1)
            if top is None:
                top = t
            new = np.maximum(top, t)
            old, now = np.exp(top - new), np.exp(t - new)
            weight, z, top = weight * old + a * now, z * old[:, None] + b * now[:, None], new
        return self.finish(weight, z)


def encoded(text: bytes, size: int, chunk: int = CHUNK) -> Iterator[np.ndarray]:
    """The rows that ``passages`` has for one text, of about ``chunk`` bytes at a time."""
    bounds = np.append(_passage_starts(text, size, chunk), len(text))
    n = len(bounds) - 1
    at = 0
    while at < n:
        upto = int(np.searchsorted(bounds, bounds[at] + chunk, side="right")) - 1
        if upto <= at:
            upto = at + 1
            x = _long_passage(text, int(bounds[at]), int(bounds[upto]), size, chunk)
        else:
            # With the next passage's first byte, whose row is left out: the pair before it counts.
            x = passages([text[bounds[at] : bounds[upto] + 1]], size)[0][: upto - at]
        x[:, PAIRS + 4] = np.log1p(n) / 5
        yield x
        at = upto


def sampled(text: bytes, size: int, most: int, chunk: int = CHUNK) -> np.ndarray:
    """The rows of ``most`` passages of a text at even distances; of all, if there are fewer."""
    if len(text) <= chunk:
        x = passages([text], size)[0]
        return x[_spread(len(x), most)]
    wanted = _spread(len(_passage_starts(text, size, chunk)), most)
    found, at = [], 0
    for x in encoded(text, size, chunk):
        found.append(x[wanted[(wanted >= at) & (wanted < at + len(x))] - at])
        at += len(x)
    return np.concatenate(found)


def _spread(n: int, most: int) -> np.ndarray:
    return np.arange(n) if n <= most else np.arange(most) * n // most


def _passage_starts(text: bytes, size: int, chunk: int) -> np.ndarray:
    """Where the passages of a text begin; the first has what is before its words, too."""
    data = np.frombuffer(text, np.uint8)
    found, words, before = [], 0, True
    for at in range(0, len(data), chunk):
        space = is_space(data[at : at + chunk])
        starts = np.flatnonzero(~space & np.append(before, space[:-1])) + at
        found.append(starts[-words % size :: size].copy())
        words, before = words + len(starts), space[-1]
    starts = np.concatenate([np.zeros(1, np.int64), *found])
    return starts[:1] if len(starts) == 1 else np.append(0, starts[2:])


def _long_passage(text: bytes, start: int, stop: int, size: int, chunk: int) -> np.ndarray:
    """The row of one passage longer than ``chunk``: pairs are counted part by part."""
    data, pairs = np.frombuffer(text, np.uint8), np.zeros(PAIRS, np.int64)
    for at in range(start, stop, chunk):
        end = min(at + chunk, stop)
        part = data[at : end + 1] if end < len(data) else np.append(data[at:end], np.uint8(10))
        kind = _KIND[part].astype(np.int64)
        pairs += np.bincount(kind[:-1] * 16 + kind[1:], minlength=PAIRS)
    # bytes.split() parts at the same six bytes as words_of.
    words = text[start:stop].split()
    some = max(len(words), 1)
    x = np.zeros((1, WIDTH), np.float32)
    x[0, :PAIRS] = np.sqrt(pairs / max(pairs.sum(), 1))
    x[0, PAIRS] = len(set(words)) / some
    x[0, PAIRS + 1] = sum(a == b for a, b in zip(words, words[1:])) / some
    x[0, PAIRS + 2] = min(sum(map(len, words)) / some / 10, 3)
    x[0, PAIRS + 3] = len(words) / size
    return x


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    spec: QualitySpec = QualitySpec(),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """A model from the labelled rows for whose id ``learn`` holds."""
    known = labels.where(learn & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("of"), F.col(label_col).cast("int").alias("y")
    )
    counts = {r.y: r[1] for r in known.groupBy("y").agg(F.count("*")).collect()}
    model = Model(spec)
    if len(counts) < 2:
        model.constant = float(next(iter(counts), 1))
        return model
    draw = (F.xxhash64(F.lit(spec.seed), F.col("of").cast("string")) % 1_000_003 + 1_000_003) % 1_000_003
    share = F.when(F.col("y") == 1, min(1.0, spec.per_class / counts[1])).otherwise(min(1.0, spec.per_class / counts[0]))
    # At most about two classes' bound of rows.
    chosen = F.broadcast(known.where(draw < share * 1_000_003).distinct())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py().encode() for t in batch.column(1))
            x = [sampled(t, spec.passage_words, spec.learned_passages).astype(np.float16).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.binary())], ["of", "y", "x"])

    rows = (
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(chosen, F.col("id") == F.col("of"))
        .select(F.col("of").cast("string"), "text", "y")
        .mapInArrow(encode, "of string, y int, x binary")
        .collect()
    )
    rows.sort(key=lambda r: (r.of, r.y, r.x))
    if len({r.y for r in rows}) < 2:
        model.constant = counts[1] / (counts[0] + counts[1])
        return model
    bags = [np.frombuffer(r.x, np.float16).reshape(-1, WIDTH) for r in rows]
    y = np.array([r.y for r in rows], np.float32)
    x = np.concatenate(bags).astype(np.float32)
    owner = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    model.fit(x, owner, y, spec)
    learned = y.mean() / (1 - y.mean())
    model.shift = float(np.log(counts[1] / counts[0]) - np.log(learned))
    return model


def scored(
    docs: DataFrame, model: Model, spec: QualitySpec = QualitySpec(), text_col: str = "text", into: str = "score"
) -> DataFrame:
    """``docs`` with the score, 0 to 1, in a column ``into``."""
    # Size bound: the model's few thousand weights.
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pickle.loads(shared.value)
        for texts in batches:
            data = ((t.as_py() or "").encode() for t in texts)
            yield pa.array(own.score(data, spec), pa.float64())

    return docs.withColumn(into, score(F.col(text_col)))
