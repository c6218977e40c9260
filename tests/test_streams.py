"""Streams over several batches: late rows, state that expires, and a second run from the checkpoint."""

import os
from collections import Counter

from skylattice.streaming import streams


def put(spark, folder, name, rows, schema):
    """One more file of a table, newer than those before."""
    os.makedirs(folder, exist_ok=True)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}-{name}")
    part = next(f for f in os.listdir(f"{folder}-{name}") if f.endswith(".parquet"))
    at = 1_700_000_000 + 60 * len(os.listdir(folder))
    os.rename(f"{folder}-{name}/{part}", f"{folder}/{name}.parquet")
    os.utime(f"{folder}/{name}.parquet", (at, at))


def test_new_items_over_batches(spark, tmp_path):
    folder, schema = f"{tmp_path}/items", "id string, day string"
    put(spark, folder, "a", [("a", "2024-01-01"), ("b", "2024-01-02"), ("a", "2024-01-05")], schema)
    put(spark, folder, "b", [("a", "2024-01-20"), ("c", "2024-03-20")], schema)

    def run():
        items = streams.table_stream(spark, folder, 1).selectExpr("id", "cast(day as timestamp) as sensing")
        return Counter(r.id for r in streams.run_available(streams.new_items(items), f"{tmp_path}/run").collect())

    assert run() == {"a": 1, "b": 1, "c": 1}
    assert run() == {"a": 1, "b": 1, "c": 1}  # nothing new
    # The watermark is at 2024-02-19: d is behind it, and a has been forgotten.
    put(spark, folder, "c", [("d", "2024-01-03"), ("a", "2024-03-25"), ("c", "2024-03-26")], schema)
    assert run() == {"a": 2, "b": 1, "c": 1}


def test_daily_agreement_over_batches(spark, tmp_path):
    folder, schema = f"{tmp_path}/pairs", "t string, predicted int, reference int"
    put(spark, folder, "a", [("2024-01-01 10:00:00", 1, 1), ("2024-01-02 10:00:00", 1, 0)], schema)
    put(spark, folder, "b", [("2024-01-01 23:00:00", 1, 0), ("2024-01-05 00:00:00", 0, 0)], schema)
    put(spark, folder, "c", [("2024-01-05 01:00:00", 0, 0)], schema)
    put(spark, folder, "d", [("2024-01-01 11:00:00", 1, 1), ("2024-01-07 00:00:00", 0, 0)], schema)
    pairs = streams.table_stream(spark, folder, 1).selectExpr("cast(t as timestamp) as ts", "predicted", "reference")
    got = {str(r.day)[:10]: (r.total, r.precision) for r in streams.run_available(streams.daily_agreement(pairs), f"{tmp_path}/run").collect()}
    # The last file's row of 1 January comes behind the watermark of the 4th, which holds a batch after it was reached.
    assert got == {"2024-01-01": (2, 0.5), "2024-01-02": (1, 0.0), "2024-01-05": (2, 0.0)}


def test_epoch_pairs_over_batches(spark, tmp_path):
    folder, schema = f"{tmp_path}/epochs", "stack long, epoch long"
    put(spark, folder, "a", [(1, 30), (1, 10), (1, 30), (2, 5), (3, None)], schema)
    put(spark, folder, "b", [(1, 20), (1, 50), (1, 40), (2, 5)], schema)

    def run():
        out = streams.run_available(streams.epoch_pairs(streams.table_stream(spark, folder, 1)), f"{tmp_path}/run")
        return Counter((r.stack, r.first, r.second, r.late) for r in out.collect())

    want = Counter([(1, None, 10, False), (1, 10, 30, False), (1, None, 30, True), (2, None, 5, False), (1, None, 20, True), (1, 30, 40, False), (1, 40, 50, False), (2, None, 5, True)])
    assert run() == want
    put(spark, folder, "c", [(1, 45), (1, 60)], schema)
    assert run() - want == Counter([(1, None, 45, True), (1, 50, 60, False)])
