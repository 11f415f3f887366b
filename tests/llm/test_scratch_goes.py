"""What a stage stores on its way goes as soon as nothing reads it."""

import os
import random
import time

from stridelake.llm import near_copies
from stridelake.llm.common import Scratch


def shuffled(spark) -> int:
    """Bytes of shuffle files of the session."""
    tops = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs())
    return sum(os.path.getsize(os.path.join(d, f)) for top in tops for d, _, files in os.walk(str(top)) for f in files if f.startswith("shuffle") and os.path.exists(os.path.join(d, f)))


def test_a_saved_frame_leaves_no_shuffle_files(spark):
    spark.sparkContext._jvm.System.gc()
    time.sleep(2)
    before, scratch = shuffled(spark), Scratch(spark, "test-shuffles")
    saved = scratch.save(spark.range(1_000_000).repartition(5, "id"), "rows")
    for _ in range(50):  # they are deleted in the background
        if shuffled(spark) <= before + 100_000:
            break
        time.sleep(0.2)
    assert shuffled(spark) <= before + 100_000
    assert saved.count() == 1_000_000


def test_tables_of_near_copies_go_when_they_are_read_no_more(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(k, " ".join(rng.choices("abcdefghij", k=60))) for k in range(60)] + [(99, "a b c d e f g"), (98, "A b c d e f g")], "doc_id long, text string")
    scratch = Scratch(spark, "test-tables")
    got = near_copies.near_copies(docs, scratch)
    left = set(os.listdir(scratch.root.removeprefix("file://")))
    assert not left & {"close-0", "shingles", "first", "signed", "met"}, left
    assert {r["doc_id"] for r in got.collect()} == {*range(60), 98}
