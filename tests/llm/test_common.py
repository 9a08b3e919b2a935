import time

from pyspark.sql import functions as F

from quarterdeck.llm.common import staged


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    groups = spark.range(5_000).groupBy((F.col("id") % 700).alias("k")).agg(F.sum("id").alias("n"))
    table = staged(groups, "groups")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert table.count() == 700
    # Tables that were read before stay readable, and the setting is as it was.
    assert staged(groups, "groups").agg(F.sum("n")).first()[0] == sum(range(5_000))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
