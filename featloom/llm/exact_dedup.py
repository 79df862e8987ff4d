"""Exact duplicates by stateful streaming, with full texts compared on every hit.

1. A key row per document (digest of the normalised text, id, content locator)
   is written and read as a stream. A streaming aggregation without watermark
   keeps, per digest, the smallest id, where its content lies, and a count. The
   state lives in RocksDB on disk, is never expired, and is stored below the
   cluster's checkpoint folder. Later documents can be judged against it: the
   state's keys have one source folder, to which each call adds its own, and of
   equal texts the one that an earlier call let stay does so for good.
   Copies are combined before the shuffle, so one text may hold any share of rows.
2. The state is read back as a table. Of digests seen more than once, the text of
   the document that stays is fetched by its locator, from an earlier call's files
   if it is there, and joined to all documents
   of the digest (an outer join, so Spark splits hot digests among tasks), and
   the texts themselves are compared. Rows whose text differs in spite of an
   equal digest are grouped by digest and text.

Only DataFrame functions are used.

Defined results: a null text counts as empty, and all empty texts are equal; a
null id sorts after every other; of rows that repeat an id and a text one stays,
the first by place in its file; an empty table gives an empty result. Other
columns, whatever their names, pass through ``survivors`` unchanged.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from featloom.llm.common import SPACE, located, named_back, place, quoted, settings, stored
from featloom.sources.scratch import scratch_path

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # For all state partitions of an executor together.
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    # Logs grow as they are written: with many state partitions, space set aside
    # for each would be many times what they hold.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _calls_before(spark: SparkSession, source: str) -> int:
    """How many calls have added to a source folder."""
    try:
        last = spark.read.parquet(source).agg(F.max("call")).first()[0]
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None
    return 0 if last is None else last + 1


def run_state(keys: DataFrame, state_path: str, bytes_per_batch: int) -> DataFrame:
    """Adds ``keys`` (digest, id, place) to the state at ``state_path`` and returns
    the whole state: digest, first (of the earliest call the smallest id, its place
    and the number of its call), copies."""
    spark = keys.sparkSession
    staged = f"{state_path}-keys"
    keys = keys.withColumn("call", F.lit(_calls_before(spark, staged)).cast("int"))
    keys.write.mode("append").parquet(staged)
    with settings(spark, _STATE):
        query = (
            spark.readStream.schema(keys.schema)
            .option("maxBytesPerTrigger", bytes_per_batch)
            .parquet(staged)
            .groupBy("digest")
            .agg(
                F.min(F.struct("call", F.col("id").isNull().alias("no_id"), "id", "place")).alias("first"),
                F.count("*").alias("copies"),
            )
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state_path)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return _read_state(spark, state_path)


def _read_state(spark: SparkSession, path: str) -> DataFrame:
    state = spark.read.format("statestore").load(path)
    first, copies = (f.name for f in state.schema["value"].dataType.fields)
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col(f"value.{first}").alias("first"),
        F.col(f"value.{copies}").alias("copies"),
    )


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    digest: Column | None = None,
    state_path: str | None = None,
    bytes_per_batch: int = 64 << 30,
) -> DataFrame:
    """A row per document: id, keep_id, group_size, kept, digest; with ``carry``
    also row, the document's columns, null if it goes.

    ``digest`` replaces SHA-256 of the normalised text, named ``normal``. With a
    ``state_path`` of earlier calls, copies of their documents go too, and group_size
    counts all calls; their files must still be there. Rows are then told apart by
    their files, so no call may be given a file of an earlier one.
    """
    spark = docs.sparkSession
    docs = located(docs)
    columns = [quoted(c) for c in docs.columns]
    text = f"row.{quoted(text_col)}"
    digest = sha256_of(F.col("normal")) if digest is None else digest
    whole = F.struct(*columns) if carry else F.struct(quoted(id_col), quoted(text_col))
    base = docs.select(
        F.col(quoted(id_col)).alias("id"), normalised(F.col(quoted(text_col))).alias("normal"),
        place().alias("place"), whole.alias("row"),
    ).select(digest.alias("digest"), "id", "place", "row")

    state = run_state(
        base.select("digest", "id", "place"),
        state_path or scratch_path(spark, "dedup-state"),
        bytes_per_batch,
    )
    seen_again = state.where("copies > 1").select(
        F.col("digest").alias("of"), F.col("first.place").alias("at"), "copies"
    )
    # The key is named anew by an expression, so that these rows are dealt out
    # again and a hot digest can be split in either join.
    firsts = (
        base.join(seen_again, F.col("digest") == F.col("of"))
        .where(F.col("place") == F.col("at"))
        .select(
            F.concat("digest", F.lit("")).alias("of"),
            F.col("id").alias("first_id"),
            F.col("place").alias("first_place"),
            normalised(F.col(text)).alias("first_normal"),
            "copies",
        )
    )
    if state_path:
        firsts = firsts.unionByName(_earlier_firsts(docs, state, base, text_col))
    normal = normalised(F.col(text))
    hit = F.col("of").isNotNull()
    kept = ~hit | (F.col("place") == F.col("first_place"))
    differs = hit & (normal != F.col("first_normal"))
    compared = base.join(firsts, F.col("digest") == F.col("of"), "left").select(
        "id",
        F.when(hit, F.col("first_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        kept.alias("kept"),
        "digest",
        "place",
        differs.alias("differs"),
        F.when(differs, normal).alias("normal"),
        *([F.when(kept | differs, F.col("row")).alias("row")] if carry else []),
    )
    compared = stored(compared, "dedup-compared")
    out = ["id", "keep_id", "group_size", "kept", "digest"] + ["row"] * carry
    if compared.where("differs").isEmpty():
        return compared.select(out)
    return _settle_collisions(compared).select(out)


def _earlier_firsts(docs: DataFrame, state: DataFrame, base: DataFrame, text_col: str) -> DataFrame:
    """Of this call's digests whose first document came in an earlier call, that one's
    id, place and text, read from the files it names: a path per file at the driver."""
    spark = docs.sparkSession
    here = docs.select(F.col("_metadata.file_path").alias("file")).distinct()
    met = (
        state.where("copies > 1")
        .join(here, F.col("first.place.file") == F.col("file"), "left_anti")
        .join(base.select(F.col("digest").alias("met")).distinct(), F.col("digest") == F.col("met"), "left_semi")
    )
    met = stored(met.select("digest", "first", "copies"), "dedup-earlier")
    files = [r[0] for r in met.select("first.place.file").distinct().collect()]
    text = StructType([docs.schema[text_col]])
    earlier = spark.read.schema(text).parquet(*files) if files else stored(spark.createDataFrame([], text), "none")
    texts = earlier.select(place().alias("at"), normalised(F.col(quoted(text_col))).alias("first_normal"))
    return met.join(texts, F.col("first.place") == F.col("at")).select(
        F.col("digest").alias("of"), F.col("first.id").alias("first_id"),
        F.col("first.place").alias("first_place"), "first_normal", "copies",
    )


def _settle_collisions(compared: DataFrame) -> DataFrame:
    """Groups anew rows whose text is not that of their digest's first document."""
    odd = compared.where("differs")
    groups = odd.groupBy("digest", "normal").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "place")).alias("first"),
        F.count("*").alias("n"),
    )
    again = odd.join(groups, ["digest", "normal"]).select(
        *(c for c in compared.columns if c not in ("keep_id", "group_size", "kept")),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("place") == F.col("first.place")).alias("kept"),
    )
    if "row" in compared.columns:
        again = again.withColumn("row", F.when(F.col("kept"), F.col("row")))
    fewer = odd.groupBy(F.col("digest").alias("of")).agg(F.count("*").alias("less"))
    rest = (
        compared.where(~F.col("differs"))
        .join(fewer, F.col("digest") == F.col("of"), "left")
        .withColumn("group_size", F.col("group_size") - F.coalesce("less", F.lit(0)))
    )
    return rest.select(compared.columns).unionByName(again.select(compared.columns))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    return named_back(judge(docs, id_col, text_col, carry=True).where("kept").select("row.*"))
