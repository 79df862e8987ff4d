"""Mixing sources to target weights, in blocks of a fixed number of words.

1. The documents of a source, in pseudorandom order, are laid end to end and cut
   into blocks of ``block`` words; a document's place is its first word's number.
   The running sum is taken within small ranges of the order and over the ranges'
   sums, so a source with any share of the rows is spread over tasks, and so are
   rows without an id or of the same.
2. Each source gets a number of slots: its target in blocks, at most
   ``max_epochs`` times what it has. Slots are dealt to output shards by a
   pseudorandom permutation of all slots, so a shard's source counts are a
   multinomial draw under the condition that the corpus's totals are met: a
   source's words come as near to its target as whole blocks can.
3. Slot j of a source with n blocks is block p(j mod n), p a pseudorandom
   permutation for each round through the source (swap-or-not, computed from the
   index alone), and slots and blocks are joined by (source, block).

Only DataFrame functions are used, and all is a function of ids, texts and the
seed: reruns agree, however the rows are partitioned.

Defined results: a null text has no words; empty documents and sources take
nothing; null is a source, the last; a null id is hashed like any other; repeated
rows are documents of their own; with no words at all, targets are 0. One row per
source passes through one task, so sources may number in the millions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from featloom.llm.common import SPACE, WORD, located, named_back, place, quoted, stored

PRIME = 2147483647
ROUNDS = 12
RANGE_ROWS = 5_000
CHUNK = 65_536
# At most so many tasks for each of the session's shuffle partitions.
TASKS = 16


@dataclass(frozen=True)
class MixSpec:
    weights: Sequence[int] = (5, 2, 1)
    max_epochs: int = 3
    block: int = 128
    slots_per_shard: int = 4096
    seed: int = 17


@dataclass(frozen=True)
class Mix:
    """spans: a row per document. slots: a row per block taken (source, block,
    epoch, shard, slot). pieces: a row per document and block of it."""

    spans: DataFrame
    slots: DataFrame
    pieces: DataFrame


def round_numbers(rounds: int = ROUNDS) -> list[tuple[int, int, int, int]]:
    """Four multipliers below the prime for each round, from one recurrence."""
    x, out = 20_231, []
    for _ in range(rounds):
        row = []
        for _ in range(4):
            x = (x * 48_271 + 11) % PRIME
            row.append(x)
        out.append(tuple(row))
    return out


def hashed(text: Column) -> Column:
    """60 bits of MD5 as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def permuted(x: Column, n: Column, seed: Column) -> Column:
    """Image of x under a pseudorandom permutation of 0..n-1, by swap-or-not rounds."""
    rounds = F.array(*(F.struct(*(F.lit(v).cast("long").alias(k) for k, v in zip("abcd", r))) for r in round_numbers()))

    def step(at: Column, r: Column) -> Column:
        high = (seed * r["a"] + r["b"]) % PRIME
        low = (seed * r["c"] + r["d"]) % PRIME
        other = ((high * 2147483648 + low) % n + n - at) % n
        larger = F.greatest(at, other)
        mixed = ((larger % PRIME) * low + high) % PRIME
        return F.when(F.floor(mixed / 32768) % 2 == 1, other).otherwise(at)

    return F.aggregate(rounds, x.cast("long"), step)


def source_targets(sizes: DataFrame, spec: MixSpec) -> DataFrame:
    """A row per source of ``sizes`` (source, size): docs, source_size, target."""
    by_rank = Window.orderBy(F.col("source").isNotNull().desc(), "source")
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("rank"))
    everywhere = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = F.array(*map(F.lit, spec.weights))
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        .withColumn("rank", F.row_number().over(by_rank) - 1)
        .withColumn("weight", F.element_at(weights, (F.col("rank") % len(spec.weights) + 1).cast("int")))
        .withColumn("cap", spec.max_epochs * F.col("source_size"))
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    shared = ranked.withColumn(
        "share",
        (F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(onward),
    ).withColumn("order", F.row_number().over(by_ratio))
    fits = F.col("share") * F.col("weight") <= F.col("cap")
    level = F.min_by("share", F.when(fits, F.col("order"))).over(everywhere)
    return shared.select(
        "source", "docs", "source_size",
        F.least(F.col("cap").cast("double"), level * F.col("weight")).alias("target"),
    )


def plan(
    docs: DataFrame,
    spec: MixSpec = MixSpec(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> Mix:
    docs = located(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    sizes = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            hashed(F.concat(F.lit(f"{spec.seed}/"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))).alias("h"),
            F.xxhash64(text).alias("text_hash"),
            place().alias("place"),
        ),
        "mix-sizes",
    )
    sources = stored(
        source_targets(sizes, spec)
        .withColumn("blocks", F.ceil(F.col("source_size") / spec.block))
        .withColumn(
            "slots",
            F.when(F.col("source_size") == 0, 0).otherwise(
                F.least(
                    F.floor(F.col("target") * F.col("blocks") / F.col("source_size") + 0.5),
                    F.col("blocks") * spec.max_epochs,
                )
            ),
        )
        .withColumn("seed", hashed(F.concat(F.lit(f"{spec.seed}:"), F.coalesce("source", F.lit("")))) % PRIME),
        "mix-sources",
    )
    spans = stored(_spans(sizes, sources), "mix-spans")
    return Mix(spans, _slots(sources, spec), _pieces(spans, spec))


def _tasks(sources: DataFrame, count: str, each: int) -> int:
    """A task for ``each`` of what ``count`` counts, within what a driver can schedule."""
    total = sources.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    return min(int(total // each) + 1, TASKS * int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _spans(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sizes`` with each document's first word's number in its source.

    A range is one task's; its running sum is over sorted rows, which Spark spills.
    """
    order = ("h", "id", "size", "text_hash", "place")
    tasks = _tasks(sources, "docs", RANGE_ROWS)
    # By the whole order, as many rows may share an id. Stored, so that ranges stay as they were drawn.
    ranged = stored(
        sizes.repartitionByRange(tasks, "source", *order).withColumn("range", F.spark_partition_id()), "mix-ranges"
    )
    of = sources.select(F.col("source").alias("of"), "source_size", "target")
    rows = ranged.join(of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("source", "range")
        .agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("of"), F.col("range").alias("in"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("from"))
    )
    earlier = (
        Window.partitionBy("source", "range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = rows.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    return within.join(
        starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in"))
    ).select("id", "source", "size", "source_size", "target", "place", "range", (F.col("start") + F.col("from")).alias("start"))


def _slots(sources: DataFrame, spec: MixSpec) -> DataFrame:
    tasks = _tasks(sources, "slots", CHUNK)
    first = Window.orderBy(F.col("source").isNotNull().desc(), "source").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chunks = (
        sources.withColumn("first", F.coalesce(F.sum("slots").over(first), F.lit(0)))
        .withColumn("all_slots", F.sum("slots").over(every))
        .where("slots > 0")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(CHUNK).cast("long"))))
        .repartition(tasks, "source", "chunk")
    )
    slots = chunks.withColumn(
        "j", F.explode(F.sequence("chunk", F.least(F.col("chunk") + CHUNK, F.col("slots")) - 1))
    )
    epoch = F.floor(F.col("j") / F.col("blocks"))
    seed = (F.col("seed") + epoch * 7919) % PRIME
    position = permuted(F.col("first") + F.col("j"), F.col("all_slots"), F.lit(spec.seed).cast("long"))
    return slots.select(
        "source",
        permuted(F.col("j") % F.col("blocks"), F.col("blocks"), seed).alias("block"),
        epoch.alias("epoch"),
        F.floor(position / spec.slots_per_shard).alias("shard"),
        (position % spec.slots_per_shard).alias("slot"),
    )


def _pieces(spans: DataFrame, spec: MixSpec) -> DataFrame:
    end = F.col("start") + F.col("size")
    return (
        spans.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / spec.block), F.floor((end - 1) / spec.block))))
        .select(
            "source", "block", "start", "place",
            (F.greatest(F.col("start"), F.col("block") * spec.block) - F.col("start")).alias("first_word"),
            (F.least(end, (F.col("block") + 1) * spec.block)
             - F.greatest(F.col("start"), F.col("block") * spec.block)).alias("words"),
        )
    )


def totals(mix: Mix) -> DataFrame:
    """A row per document: id, source, size, source_size, target, taken."""
    # Merge joins: the size of exploded rows is guessed from the few they come of.
    times = mix.slots.groupBy(F.col("source").alias("of"), F.col("block").alias("at")).agg(
        F.count("*").alias("times")
    )
    taken = (
        mix.pieces.join(times.hint("merge"), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
        .groupBy(F.col("source").alias("of"), F.col("start").alias("at"))
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    mine = (
        F.col("source").eqNullSafe(F.col("of"))
        & (F.col("start") == F.col("at"))
        & (F.col("size") > 0)
    )
    return mix.spans.join(taken, mine, "left").select(
        "id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mixed(
    docs: DataFrame, mix: Mix, spec: MixSpec = MixSpec(), text_col: str = "text", chars_col: str = "n_chars"
) -> DataFrame:
    """The mix itself: ``docs``' columns, a row per document and block taken, text
    being the words in the block with the white space after them; ``docs`` and
    ``spec`` must be what the plan was made of. ``chars_col``, if there is one,
    counts anew.

    A text is cut once, at its block bounds; its parts then meet the slots that
    took them, so the work is in proportion to the text's length.
    """
    columns = docs.columns
    slots = mix.slots.select(F.col("source").alias("of"), F.col("block").alias("at"), F.struct("shard", "slot").alias("take"))
    per_block = (
        mix.pieces.join(
            slots.hint("merge"), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "left"
        )
        .groupBy("place", "block", "words")
        .agg(F.sort_array(F.collect_list("take")).alias("takes"))
    )
    per_document = per_block.groupBy("place").agg(
        F.sort_array(F.collect_list(F.struct("block", "takes"))).alias("blocks"),
        F.min_by("words", "block").alias("first_words"),
    )
    gap, letter = SPACE[:-1], WORD[:-1]
    run = rf"(?:{letter}++{gap}*+)"
    to_first_bound = F.concat(F.lit(rf"\A{gap}*+{run}{{1,"), F.col("first_words"), F.lit("}+"))
    first = F.regexp_substr("body", to_first_bound)
    others = [quoted(c) for c in columns if c != text_col]
    rows = (
        docs.select(place().alias("in"), F.col(text_col).alias("body"), F.struct(*others, F.lit(0)).alias("row"))
        .join(per_document, F.col("in") == F.col("place"))
        .select("row", "blocks", "body", first.alias("first"))
        .select(
            "row", "blocks", "first",
            F.expr("substring(body, length(first) + 1)").alias("rest"),
        )
        .select(
            "row",
            F.explode(
                F.arrays_zip(
                    F.concat(F.array("first"), F.regexp_extract_all("rest", F.lit(rf"{run}{{1,{spec.block}}}+"), F.lit(0))).alias("text"),
                    F.col("blocks.takes").alias("takes"),
                )
            ).alias("part"),
        )
        .select("row", F.col("part.text").alias("text"), F.explode("part.takes"))
    )
    new = {text_col: F.col("text")}
    if chars_col in columns:
        new[chars_col] = F.length("text").cast(dict(docs.dtypes)[chars_col])
    return named_back(rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in columns)))


def _permuted_sql(columns: str, x: str, n: str, seed: str) -> str:
    """Nested selects, one per round; ``{t}`` stands for the innermost table."""
    sql = "{t}"
    for a, b, c, d in round_numbers():
        keyed = (
            f"SELECT *, ({seed} * {a} + {b}) % {PRIME} AS hi, ({seed} * {c} + {d}) % {PRIME} AS lo FROM ({sql})"
        )
        paired = f"SELECT *, ((hi * 2147483648 + lo) % {n} + {n} - {x}) % {n} AS other FROM ({keyed})"
        sql = (
            f"SELECT {columns}, CASE WHEN (((greatest({x}, other) % {PRIME}) * lo + hi) % {PRIME} // 32768) % 2 = 1 "
            f"THEN other ELSE {x} END AS {x} FROM ({paired})"
        )
    return sql


def sql(spec: MixSpec = MixSpec()) -> str:
    """``totals`` over the table documents, in DuckDB's SQL."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(spec.weights))
    md5 = "('0x' || substr(md5({}), 1, 15))::BIGINT"
    blocks = _permuted_sql("source, blocks, round_seed", "pos", "blocks", "round_seed").format(
        t="SELECT source, blocks, (seed + j // blocks * 7919) % 2147483647 AS round_seed, "
        "j % blocks AS pos FROM taken_slots"
    )
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
         {md5.format(f"'{spec.seed}/' || coalesce(doc_id::VARCHAR, 'null')")} AS h
  FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source
), capped AS (
  SELECT *, CASE rank % {len(spec.weights)} {weight} END AS weight, source_size * {spec.max_epochs} AS cap
  FROM ranked
), shared AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, rank
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS share,
         row_number() OVER (ORDER BY cap / weight, rank) AS place
  FROM capped
), sources AS (
  SELECT *, ceil(source_size / {spec.block})::BIGINT AS blocks,
         least(cap::DOUBLE, (SELECT min_by(share, place) FROM shared WHERE share * weight <= cap) * weight) AS target
  FROM shared
), slotted AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE
           least(floor(target * blocks / source_size + 0.5)::BIGINT, blocks * {spec.max_epochs}) END AS slots,
         {md5.format(f"'{spec.seed}:' || coalesce(source, '')")} % {PRIME} AS seed
  FROM sources
), taken_slots AS (
  SELECT source, blocks, seed, unnest(range(slots)) AS j FROM slotted WHERE slots > 0
), times AS (
  SELECT source, pos AS block, count(*) AS times FROM ({blocks}) GROUP BY ALL
), spans AS (
  SELECT doc_id, source, size,
         (sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS start
  FROM d
), pieces AS (
  SELECT *, unnest(range(start // {spec.block}, (start + size - 1) // {spec.block} + 1)) AS block
  FROM spans WHERE size > 0
), taken AS (
  SELECT p.source, p.start,
         sum((least(p.start + size, (p.block + 1) * {spec.block}) - greatest(p.start, p.block * {spec.block})) * times)::BIGINT AS taken
  FROM pieces p JOIN times t ON p.source IS NOT DISTINCT FROM t.source AND p.block = t.block
  GROUP BY ALL
)
SELECT s.doc_id, s.size, z.source_size, z.target, coalesce(t.taken, 0) AS taken
FROM spans s
JOIN slotted z ON s.source IS NOT DISTINCT FROM z.source
LEFT JOIN taken t ON s.source IS NOT DISTINCT FROM t.source AND s.start = t.start AND s.size > 0
"""
