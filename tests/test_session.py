"""Session settings."""

import time


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffled_rows_go_when_a_query_ends(spark, tmp_path):
    before = shuffle_files(spark)
    for name in ("first", "second"):
        rows = spark.range(1000).groupBy("id").count().repartition(3, "count")
        rows.write.parquet(f"{tmp_path}/{name}")
    end = time.time() + 30
    while shuffle_files(spark) - before and time.time() < end:  # they are deleted beside the driver's next work
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert len(rows.collect()) == len(rows.collect()) == 1000
