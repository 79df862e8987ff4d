"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from featloom.sources.scratch import scratch_path

# White space as the contracts define it: space and \t \n \v \f \r, ASCII only.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of rows that Spark hands to Python at a time. Without it a batch is 10,000 rows,
# however long, in the task's JVM and in its worker.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}

# Shuffle files go when the step that wrote them is over. Without it they stay until the
# driver happens to collect its garbage, those of many steps at once.
SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: cuts lineage,
    and a lost executor cannot change rows that later steps rely on."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(table: DataFrame) -> None:
    """Removes a table that ``stored`` wrote, or the ones that ``table`` reads directly.
    Nothing that is still to be computed may read them."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        if re.search(r"/[^/]+-[0-9a-f]{32}$", folder):
            place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            place.getFileSystem(conf).delete(place, True)


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


# Spark's name for a stored row's place, and what a column of that name is called
# while its place is needed.
METADATA = "_metadata"
_RENAMED = "_metadata__column"

# Steps over a scan that neither repeat its rows nor bring in others.
_ROW_BY_ROW = {"Project", "Filter", "SubqueryAlias", "LogicalRelation", "View"}


def _is_one_scan(df: DataFrame) -> bool:
    """Whether each row is a different row of one stored table."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in _ROW_BY_ROW and node.children().size() == 1:
        node = node.children().head()
    return node.nodeName() == "LogicalRelation" and node.children().isEmpty()


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as stored files, so that each row, repeated ones too, has a place:
    a scan, filtered or projected at most, as it is; anything else (an ``explode``
    gives several rows one place) is stored. A column ``_metadata`` would hide the
    place, so it has another name until ``named_back``."""
    if METADATA in (c.lower() for c in docs.columns):
        docs = docs.withColumnRenamed(METADATA, _RENAMED)
    if _is_one_scan(docs):
        try:
            docs.select("_metadata.file_path", "_metadata.row_index")
            return docs
        except AnalysisException:
            pass
    return stored(docs, "located")


def named_back(df: DataFrame) -> DataFrame:
    """``df`` with the column that ``located`` renamed under its own name."""
    return df.withColumnRenamed(_RENAMED, METADATA) if _RENAMED in df.columns else df


def place() -> Column:
    """File and row of a stored row."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like those asked for that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    return [n if n.lower() not in taken else f"{n}_{uuid.uuid4().hex[:8]}" for n in names]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block; what they were comes back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def held_out(id_col: Column) -> Column:
    """The evaluation fold: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))
