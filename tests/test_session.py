from pyspark.sql import functions as F

from barflow.session import SHUFFLE_CLEANUP, materialize


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffles_of_stored_tables_do_not_stay_on_disk(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    stored = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert {tuple(r) for r in stored.collect()} == {(k, 143 if k < 6 else 142) for k in range(7)}
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
