"""Language identification in two steps: family, then language within it.

A text is described by its letters: hashed runs of one to three characters, other
characters counting as one space, as square roots of relative frequencies, which
gives vectors of length 1 whatever the length of the text. A linear support vector
machine per family (one against the rest) names the family; within it one machine
per pair of languages votes, ties going to the larger sum of margins.

The machines are learned from at most about ``per_language`` texts of each
language (a documented bound; which ones is a function of the id alone) by
stochastic subgradient steps on the driver, in an order fixed by the seed; texts
are turned to vectors on the executors. Everything is scored.

Defined results: null texts and texts without any letter are ``und`` with score 0;
rows without a language are not learned from; a language without a known family is
one of its own; with nothing to learn from, every text is ``und``. Repeated rows
are scored each. Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from featloom.llm.words import mix

# ISO 639-1 codes of common languages by family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
}
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_ALPHA = np.array([chr(i).isalpha() for i in range(1 << 16)])


@dataclass(frozen=True)
class LanguageSpec:
    width: int = 2048
    per_language: int = 800
    epochs: int = 12
    penalty: float = 1e-4
    seed: int = 7
    families: dict = field(default_factory=lambda: FAMILIES)


def vector(text: str, width: int, slice_size: int = 1 << 20) -> np.ndarray:
    """Hashed letter runs of a text; length 1, or 0 for a text without letters."""
    counts = np.zeros(width, np.int64)
    # In slices, so that memory does not grow with the text; the last two codes go
    # on to the next slice, so that runs over a cut count as elsewhere.
    before = np.array([32], np.uint64)
    for at in range(0, len(text), slice_size):
        # The lower case of a capital sigma would depend on the letters around it.
        part = text[at : at + slice_size].replace("\u03a3", "\u03c3").lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = (codes >= 1 << 16) | _ALPHA[np.minimum(codes, (1 << 16) - 1)]
        codes = np.where(letter, codes, 32)
        spaced = codes == 32
        # Runs of non-letters are one space.
        codes = codes[~(spaced & np.concatenate([[before[-1] == 32], spaced[:-1]]))].astype(np.uint64)
        if at + slice_size >= len(text):
            codes = np.append(codes, np.uint64(32))
        held = len(before)
        codes = np.concatenate([before, codes])
        two = codes[:-1] * np.uint64(1_000_003) + codes[1:]
        three = two[:-1] * np.uint64(1_000_003) + codes[2:]
        one, two, three = codes[held:], two[held - 1 :], three[max(held - 2, 0) :]
        for runs in (one[one != 32], two + np.uint64(1 << 40), three + np.uint64(1 << 50)):
            counts += np.bincount((mix(runs) % np.uint64(width)).astype(np.int64), minlength=width)
        before = codes[-2:]
    total = counts.sum()
    return np.sqrt(counts / total if total else counts).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, spec: LanguageSpec) -> np.ndarray:
    """Weights, the last a bias, of a linear machine for y in {-1, 1}; both classes
    weigh the same. Averaged subgradient steps."""
    order = np.random.default_rng(spec.seed)
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    w = np.zeros(x.shape[1])
    mean, steps, t = np.zeros_like(w), 0, 0
    for epoch in range(spec.epochs):
        for rows in np.array_split(order.permutation(len(x)), max(1, len(x) // 16)):
            t += 1
            rate = 2.0 / (1 + 0.02 * t)
            wrong = rows[(x[rows] @ w) * y[rows] < 1]
            w *= 1 - rate * spec.penalty
            if len(wrong):
                w += rate * ((weight * y)[wrong] @ x[wrong]) / len(rows)
            if epoch >= spec.epochs // 2:
                mean += w
                steps += 1
    return (mean / max(steps, 1)).astype(np.float32)


@dataclass
class LanguageModel:
    width: int
    families: list[str]
    family_weights: np.ndarray
    members: dict[str, list[str]]
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not _LETTER.search(text):
            return UNKNOWN, 0.0
        x = np.append(vector(text, self.width), np.float32(1))
        margins = self.family_weights @ x
        best = int(margins.argmax())
        sure = _sigmoid(margins[best])
        votes = {m: [0, 0.0] for m in self.members[self.families[best]]}
        for (a, b), w in self.pairs.items():
            if a in votes and b in votes:
                margin = float(w @ x)
                winner = a if margin >= 0 else b
                votes[winner][0] += 1
                votes[a][1] += margin
                votes[b][1] -= margin
        chosen = min(votes, key=lambda m: (-votes[m][0], -votes[m][1], m))
        if len(votes) > 1:
            sure *= _sigmoid(votes[chosen][1] / (len(votes) - 1))
        return chosen, sure


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-2 * np.clip(x, -30, 30))))


def fit_model(x: np.ndarray, langs: list[str], spec: LanguageSpec) -> LanguageModel:
    of = {code: name for name, codes in spec.families.items() for code in codes}
    members: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        members.setdefault(of.get(lang, f"only {lang}"), []).append(lang)
    families = sorted(members)
    own = np.array([of.get(lang, f"only {lang}") for lang in langs])
    langs = np.array(langs)
    if len(families) > 1:
        weights = np.stack([fit_svm(x, np.where(own == f, 1.0, -1.0), spec) for f in families])
    else:
        weights = np.zeros((len(families), x.shape[1] + 1), np.float32)
    pairs = {}
    for group in members.values():
        for a, b in combinations(group, 2):
            rows = (langs == a) | (langs == b)
            pairs[a, b] = fit_svm(x[rows], np.where(langs[rows] == a, 1.0, -1.0), spec)
    return LanguageModel(spec.width, families, weights, members, pairs)


def fit(
    docs: DataFrame,
    learn: Column,
    spec: LanguageSpec = LanguageSpec(),
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """A model from the rows of ``docs`` for which ``learn`` holds."""
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).agg(F.count("*")).collect()}
    chance = F.lit(0.0)
    for lang, n in counts.items():
        chance = F.when(F.col(lang_col) == lang, min(1.0, spec.per_language / n)).otherwise(chance)
    draw = (F.xxhash64(F.lit(spec.seed), F.col(id_col).cast("string")) % 1_000_003 + 1_000_003) % 1_000_003
    sample = rows.where(draw < chance * 1_000_003).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("id")
    )
    width = spec.width

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts, ids = (batch.column(i).to_pylist() for i in range(3))
            kept = [i for i, t in enumerate(texts) if _LETTER.search(t)]
            data = [vector(texts[i], width).tobytes() for i in kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in kept], pa.string()), pa.array([ids[i] for i in kept], pa.string()),
                 pa.array(data, pa.binary())], ["lang", "id", "x"],
            )

    got = sample.mapInArrow(described, "lang string, id string, x binary").collect()
    got.sort(key=lambda r: (r.lang, r.id or "", r.x))
    x = np.stack([np.frombuffer(r.x, np.float32) for r in got]) if got else np.zeros((0, width), np.float32)
    return fit_model(x, [r.lang for r in got], spec)


def predicted(docs: DataFrame, model: LanguageModel, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct ``into`` of lang and score."""
    # Size bound: languages in a family, squared, times the width.
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = pickle.loads(shared.value)
        for texts in batches:
            found = [own.predict(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["lang", "score"],
            )

    return docs.withColumn(into, predict(F.col(text_col)))
