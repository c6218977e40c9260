"""What goes to Python at a time."""

from pyspark.sql import functions as F

import corpus_pipeline
from skylattice.llm.shared import written


def _sizes(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])


def test_batches_are_bounded_by_bytes_as_well_as_rows(spark):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(n) for n in names]
    for chars, most in ((5_000, 300), (10, 1000)):
        texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), chars).alias("text"))
        sizes = texts.mapInArrow(_sizes, "rows long, bytes long")
        got = [written(sizes).collect()]
        assert [spark.conf.get(n) for n in names] == before
        try:
            corpus_pipeline.small_batches(spark)
            got.append(sizes.collect())
        finally:
            for n, value in zip(names, before, strict=True):
                spark.conf.set(n, value)
        for rows in got:
            assert sum(r.rows for r in rows) == 3000
            assert max(r.rows for r in rows) <= most and max(r.bytes for r in rows) < 1.2 * (1 << 20)
