"""Shuffle files of a stored frame do not outlive its query in a block that frees them."""

import time

from pyspark.sql import functions as F

from tidegate.session import FREE_SHUFFLES, freed_shuffles, scratch, stored


def shuffle_files(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = kept.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())
            if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_query(spark):
    before, rows = shuffle_files(spark), spark.range(1000).withColumn("k", F.col("id") % 7)
    with scratch(spark), freed_shuffles(spark):
        counts = stored(rows.groupBy("k").count(), "counts")
        assert counts.count() == 7
        deadline = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < deadline:
            time.sleep(0.2)
        assert not left


def test_setting_is_restored(spark):
    before = spark.conf.get(FREE_SHUFFLES)
    try:
        with freed_shuffles(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
            raise ValueError
    except ValueError:
        assert spark.conf.get(FREE_SHUFFLES) == before
    spark.conf.set(FREE_SHUFFLES, "true")
    with freed_shuffles(spark):
        pass
    assert spark.conf.get(FREE_SHUFFLES) == "true"
    spark.conf.unset(FREE_SHUFFLES)
