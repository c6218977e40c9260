"""What the operators of this subpackage share: the word rule, and tables written between jobs."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a longest run of characters other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"\x20\x09-\x0D"


#: An Arrow batch in what is written between jobs takes so many rows and about so many bytes: that bounds what a task
#: holds outside the heap and in Python, however long texts and sets are.
BATCH_ROWS, BATCH_BYTES = 1000, 1 << 20
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Unset is allowed in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = getattr(spark, "_skylattice_folder", None)
    if made is None:
        made = spark._skylattice_folder = "file://" + tempfile.mkdtemp(prefix="spark-")
    return made


def written(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage, survives lost executors. by: a column
    whose values get folders of their own, so that a filter on it reads no more than it asks for."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = {name: spark.conf.get(name) for name in BATCHES}
    try:
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        df.write.parquet(path, partitionBy=by)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing to be computed reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Memory that Python has freed, to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """For functions of mapInArrow: a Python worker outlives its task, so what the task has freed goes back to the system
    when it ends, however many workers an executor keeps."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()

    return wrapped


def word_count(text):
    """Words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def by_batch(df: DataFrame, columns: list, schema: str, start, rows: int = 1000) -> DataFrame:
    """Arrow batches through plain Python. start() is called once a task and gives work(*columns), which takes lists of
    at most `rows` values and returns one sequence per column of schema. Nulls arrive as None, integers exactly."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = to_arrow_schema(StructType.fromDDL(schema))

    @tidy
    def run(batches):
        import pyarrow as pa

        work = start()
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                out = work(*[c.to_pylist() for c in batch.slice(k, rows).columns])
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, wanted, strict=True)], schema=wanted)

    return df.select(*columns).mapInArrow(run, schema)


def label_sample(labels: DataFrame, label: str, most: int, fold: tuple[int, int] | None = None) -> DataFrame:
    """(doc_id, _y): at most `most` rows labelled 0 or 1, those whose doc_id hashes lowest. fold = (modulus, remainder)
    names the held-out fold by crc32 of doc_id as text; its labels are never taken. A bound on what a model is fitted
    on, not on what it is applied to."""
    y = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("_y"))
    if fold:
        y = y.where(~held_out(F.col("doc_id"), *fold))
    return y.orderBy(F.xxhash64("doc_id"), "doc_id", "_y").limit(most)


def held_out(doc_id, modulus: int, held: int):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == held, F.lit(False))
