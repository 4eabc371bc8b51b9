"""What the operators of this subpackage share: tables, materialisation and word rules."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The characters that separate words, for Java's regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
#: Lets Spark delete the shuffle files of a query when it ends, not when the driver's memory next runs short.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of a batch for Python, and rows that a Parquet reader decodes at once. Spark's own bounds are rows alone (10,000 and 4,096), so with
#: texts a task holds several times 16 MB outside the heap and as arrays too large for the heap's regions, beside a heap that takes what it may.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20), "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def bound_batches(spark: SparkSession) -> None:
    """Bounds batches for the session, where it has no bounds of its own: a result is run by whoever writes it. Results don't depend on batches."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local master may go without that setting; it gets a temporary folder.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="quire-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def materialize(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back, which cuts the lineage. Its shuffle files are deleted once it is written.

    A lost executor costs at most the tasks that were running: finished tables stay. `replaces` is a table of
    an earlier call that nothing reads any more; it is deleted once df is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quire-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)
    if replaces is not None:
        discard(replaces)
    out = spark.read.schema(df.schema).parquet(path)
    out._quire_path = path
    return out


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished tables now, not when the driver's memory next runs short."""
    gc.collect()
    spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Deletes the table behind a DataFrame that materialize gave; others are left alone."""
    path = getattr(df, "_quire_path", None)
    if path is not None:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def words_of(text: Column) -> Column:
    """The words of a text, in order; a null or blank text has none. JVM side."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(text, UPPER, LOWER)


#: Bytes of text to a hash bucket; there are LEAST_BUCKETS or more, so that the top byte of a hash lies in its bucket's number.
BUCKET_BYTES, LEAST_BUCKETS = 1 << 22, 256


def bucket_count(docs: DataFrame) -> int:
    """Hash buckets, a power of two, for the bytes of docs' texts."""
    text_bytes = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    return max(LEAST_BUCKETS, 1 << (text_bytes // BUCKET_BYTES).bit_length())


def dealt(rows: DataFrame, key: str, tasks: int) -> DataFrame:
    """rows by a key over at least so many partitions, whatever their number of bytes."""
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks), key)


def is_small(df: DataFrame, most_rows: int) -> bool:
    """Whether df has at most most_rows rows; reads no more than needed to tell."""
    return df.limit(most_rows + 1).count() <= most_rows


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with a number after those that df has already; column names are compared as Spark does, without case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        tried, k = name, 0
        while tried.lower() in taken:
            k += 1
            tried = f"{name}_{k}"
        taken.add(tried.lower())
        out.append(tried)
    return out


def named(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of(df: DataFrame) -> list[Column]:
    return [named(c) for c in df.columns]


def _bytes_of(name: str, kind: T.DataType) -> Column:
    """About how many bytes a value takes in memory."""
    at = named(name)
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(at), F.lit(0)).cast("long") + 16
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.octet_length(F.to_json(F.struct(at))) if isinstance(kind.elementType, T.StructType | T.ArrayType | T.StringType) else F.size(at) * 8, F.lit(0)).cast("long") + 16
    return F.lit(8).cast("long")


#: A table of more bytes than this isn't broadcast.
MOST_BROADCAST = 64 << 20


def table_bytes(df: DataFrame) -> int:
    """About how many bytes the rows of df take in memory."""
    each = F.lit(32).cast("long")
    for field in df.schema.fields:
        each = each + _bytes_of(field.name, field.dataType)
    return int(df.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0])


def guarded_broadcast(df: DataFrame, most_bytes: int | None = None) -> DataFrame:
    """A broadcast hint where the bytes are checked to be within the bound, else df as it is.

    Reads df once to tell, so df should be a written table or small to make. Beyond the bound the
    join falls back to a shuffle that adaptive execution can split.
    """
    return F.broadcast(df) if table_bytes(df) <= (MOST_BROADCAST if most_bytes is None else most_bytes) else df
