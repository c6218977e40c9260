"""The batch operators that make sense over unbounded catalogues and pixel feeds. Late rows are those behind the
watermark; they are left out, or told apart where an operator keeps its own state."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import confusion, scores


def new_items(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """items(id, sensing, ...): each id once, as far as the watermark reaches back."""
    return stream.withWatermark("sensing", late).dropDuplicatesWithinWatermark(["id"])


def daily_agreement(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """pairs(ts, predicted, reference): scores of each day, given out once it is behind the watermark."""
    days = stream.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w")).agg(*confusion())
    return days.withColumns(scores()).select(F.col("w.start").alias("day"), "total", *scores())


def epoch_pairs(stream: DataFrame) -> DataFrame:
    """slc(stack, epoch: long) -> (stack, first, second, late): each epoch with the one before it. The state of a stack is
    its last epoch, one number however long the stream runs. An epoch not above it, or seen twice, comes late: it is
    given out with late true and without a first, and changes nothing. Run it by run_available, or set the state store's
    provider yourself."""
    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Pairs(StatefulProcessor):
        def init(self, handle) -> None:
            self.last = handle.getValueState("last", "epoch long")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            epochs = np.sort(np.concatenate([part["epoch"].to_numpy("int64") for part in rows]))
            known = self.last.get()[0] if self.last.exists() else None
            # Late: not above what is known, or the same as the one before in this batch.
            late = np.diff(epochs, prepend=epochs[0] - 1) == 0
            if known is not None:
                late |= epochs <= known
            fresh = epochs[~late]
            first = pd.array([None] * len(epochs), dtype="Int64")
            first[~late] = pd.array([known, *fresh[:-1]] if len(fresh) else [], dtype="Int64")
            if len(fresh):
                self.last.update((int(fresh[-1]),))
            yield pd.DataFrame({"stack": key[0], "first": first, "second": epochs, "late": late})

        def close(self) -> None:
            pass

    schema = "stack long, first long, second long, late boolean"
    return stream.where("epoch is not null").groupBy("stack").transformWithStateInPandas(Pairs(), schema, "append", "none")


def table_stream(spark: SparkSession, path: str, files_a_batch: int | None = None) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream of its files, oldest first; all that are there make one
    batch, or files_a_batch of them at a time. A stream takes a single file by a pattern only, so the last letter of the
    path is put into brackets."""
    path = path.rstrip("/")
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, folder: str) -> DataFrame:
    """What a stream gives out of all that is there now, written as Parquet under `folder` with its checkpoint: run again
    on the same folder, it goes on where it ended. State is kept in RocksDB, beside the heap."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        query = (
            stream.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
