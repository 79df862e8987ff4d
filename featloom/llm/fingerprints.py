"""Threshold-scaled sketches of documents, by DataFrame functions only.

A text's shingles are its runs of five words (lower-cased; fewer words: the whole
sequence as one), hashed to 63 bits. The sketch keeps every hash below a fixed
fraction of the range. The fractions are a ladder, 1, 1/2, 1/4 and 1/8: a text's is
the smallest by which it can expect to keep ``floor`` hashes, so 1/8 from 256
different shingles on and 1 below 64. The number of shingles alone decides, never
their hashes, so a sketch is a fair sample of its text. It carries its limit, the
number up to which it has every hash: sketches merge by taking the smaller limit
and the union of the hashes up to it, and two sketches, of texts however unequal in
length, are compared by the hashes up to the smaller limit, a fair sample of the
shingles of both. Between texts below 64 shingles the likeness is exact.

Written as a string: limit and hashes in hexadecimal, ``limit:hash,hash,...``.

Defined results: a null text counts as empty; an empty text has no shingles, a
likeness of 1 to another without any and 0 to all others. Repeated rows are
documents of their own, ordered by where they are stored. Null ids come first. The
containment of a short text none of whose hashes lies below the other's limit is
null: the sketches do not tell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from featloom.llm.common import SPACE, located, place
from featloom.operators.ids import dense_ids
from featloom.sources.scratch import scratch_path

TOP = (1 << 63) - 1


@dataclass(frozen=True)
class SketchSpec:
    words: int = 5
    fraction: float = 1 / 8
    floor: int = 32

    @property
    def ladder(self) -> list[float]:
        """Fractions from the smallest on, each twice the one before, up to 1."""
        steps = [self.fraction]
        while steps[-1] < 1:
            steps.append(min(1.0, 2 * steps[-1]))
        return steps

    def limit(self, shingles: Column) -> Column:
        """The largest hash kept of a text with so many different shingles."""
        *steps, _ = self.ladder
        limit = F.lit(TOP)
        for fraction in reversed(steps):
            below = int((1 << 63) * fraction)
            limit = F.when(shingles >= self.floor / fraction, below - 1).otherwise(limit)
        return limit


def with_sketch(df: DataFrame, text: str, out: str, spec: SketchSpec = SketchSpec()) -> DataFrame:
    """``df`` with a column ``out``: struct of limit and sorted hashes of column ``text``."""
    words = F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")
    k = spec.words
    hashed, many, limit = f"{out}_words", f"{out}_all", f"{out}_limit"
    window = F.sequence(F.lit(0), F.size(hashed) - k)
    shingles = F.transform(
        window, lambda i: F.xxhash64(*(F.col(hashed)[i + j] for j in range(k))).bitwiseAND(TOP)
    )
    few = F.when(F.size(hashed) > 0, F.array(F.xxhash64(hashed).bitwiseAND(TOP))).otherwise(
        F.array().cast("array<bigint>")
    )
    kept = F.sort_array(F.filter(many, lambda h: h <= F.col(limit)))
    return (
        df.withColumn(hashed, F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn(many, F.array_distinct(F.when(F.size(hashed) >= k, shingles).otherwise(few)))
        .withColumn(limit, spec.limit(F.size(many)))
        .withColumn(out, F.struct(F.col(limit).alias("limit"), kept.alias("hashes")))
        .drop(hashed, many, limit)
    )


def _upto(sketch: Column, limit: Column) -> Column:
    return F.filter(sketch["hashes"], lambda h: h <= limit)


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two sketches."""
    limit = F.least(a["limit"], b["limit"])
    x, y = _upto(a, limit), _upto(b, limit)
    common = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - common
    return F.when(union == 0, 1.0).otherwise(common / F.greatest(union, F.lit(1)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that are also b's; null if none of a's hashes
    can be compared."""
    limit = F.least(a["limit"], b["limit"])
    x, y = _upto(a, limit), _upto(b, limit)
    nothing = F.when(F.size(y) == 0, 1.0).otherwise(0.0)
    return F.when(F.size(a["hashes"]) == 0, nothing).when(
        F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.lit(1))
    )


def merged(a: Column, b: Column) -> Column:
    """Sketch of two texts together."""
    limit = F.least(a["limit"], b["limit"])
    both = F.array_union(_upto(a, limit), _upto(b, limit))
    return F.struct(limit.alias("limit"), F.sort_array(both).alias("hashes"))


def written(sketch: Column) -> Column:
    hashes = F.array_join(F.transform(sketch["hashes"], lambda h: F.hex(h)), ",")
    return F.concat(F.hex(sketch["limit"]), F.lit(":"), hashes)


def with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spec: SketchSpec = SketchSpec()
) -> DataFrame:
    """A row per document: id, text, sketch, and of the next by id (after the last
    the first) the sketch and as many characters as a quarter of this text has.

    Only keys are sorted over all rows. Texts are dealt out by their place once;
    from there the next document's start goes back to the one before it.
    """
    spark = docs.sparkSession
    docs = located(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(F.col(id_col).alias("id"), place().alias("place"), F.length(text).alias("chars"))
    numbered = dense_ids(keys, scratch_path(spark, "fingerprint-keys"), ["id", "place"], id_col="n")
    total = numbered.count()
    before = numbered.select(
        ((F.col("n") + 1) % max(total, 1)).alias("then"),
        F.col("id").alias("of_id"), F.col("place").alias("of"),
        F.floor(F.col("chars") / 4).cast("int").alias("wanted"),
    )
    order = numbered.select("n", F.col("place").alias("at")).join(before, F.col("n") == F.col("then"))
    base = with_sketch(docs.select(place().alias("place"), text.alias("body")), "body", "sketch", spec)
    starts = base.join(order, F.col("place") == F.col("at")).select(
        "of_id", "of",
        F.expr("substring(body, 1, wanted)").alias("next_start"),
        F.col("sketch").alias("next_sketch"),
    )
    return base.join(starts, F.col("place") == F.col("of")).select(
        F.col("of_id").alias("id"), F.col("body").alias("text"), "sketch", "next_start", "next_sketch"
    )
