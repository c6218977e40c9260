"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from skylattice.llm.mixing import mixed_texts
from skylattice.llm.ngram_join import one_of_each
from skylattice.llm.packing import pack_documents
from skylattice.llm.quality_rules import passing
from skylattice.llm.repeats import PASSAGE, without_repeats
from skylattice.llm.shared import BATCHES, read_table, written


def small_batches(spark):
    """The pipeline owns its session: rows hold whole texts, so few of them go to Python at a time."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


def quality(spark, docs, sf_dir):
    """Documents that the base rules or the learned decision list reject go."""
    small_batches(spark)
    return passing(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near copies the document with the least doc_id stays: five-word shingles, 0.8 or more."""
    small_batches(spark)
    return one_of_each(docs, words=5, percent=80)


def repeated_passages(spark, docs, sf_dir):
    """Bytes inside 240-byte strings that start anywhere else too are cut out: so long is a passage of over 50 words."""
    small_batches(spark)
    return without_repeats(docs, length=PASSAGE)


def mixing(spark, docs, sf_dir):
    """Sources are mixed to their target weights, in blocks of 1024 words."""
    small_batches(spark)
    return mixed_texts(docs, block_words=1024)


def packing(spark, docs, sf_dir):
    """The mixed texts are packed into sequences of at most 2048 tokens. Workers of all the stages before are still
    there, so each keeps few words: twice 8,000."""
    small_batches(spark)
    return pack_documents(docs, cache_words=8_000)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixing),
    ("best-fit packing", packing),
]

#: SQL expresses neither a learned list nor tokenization; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
