"""Vectors of one file are dealt to all cores before passes over them."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from foldwise.operators import unsupervised
from foldwise.plans import models


def rows(spark, n, parts):
    df = spark.range(n).select("id", F.array(*[F.sin(F.col("id") * i) for i in range(1, 5)]).alias("x"), F.lit(0).alias("label"))
    return df.repartition(parts, F.pmod(F.col("id") * 7, F.lit(5)))


def test_one_partition_is_dealt_by_key(spark):
    cores = spark.sparkContext.defaultParallelism
    found = []
    for parts in (1, 3):
        df = unsupervised.dealt(unsupervised.as_vector(rows(spark, 8192, parts), "x"), "id")
        assert df.rdd.getNumPartitions() == min(cores, 8192 // unsupervised.TASK_ROWS)
        assert df.storageLevel == StorageLevel.NONE
        found.append(df.select("id", F.spark_partition_id()).collect())
    assert found[0] == found[1]
    assert sorted(r.id for r in found[0]) == list(range(8192))
    few = unsupervised.dealt(unsupervised.as_vector(rows(spark, 100, 3), "x"), "id")
    assert few.rdd.getNumPartitions() == 1 and few.count() == 100
    assert unsupervised.dealt(unsupervised.as_vector(rows(spark, 0, 1), "x"), "id").count() == 0


def test_clusterings_do_not_depend_on_the_file(spark, tmp_path):
    got = []
    for parts in (1, 4):
        folder = f"{tmp_path}/{parts}"
        rows(spark, 2000, parts).withColumnsRenamed({"id": "vec_id", "x": "embedding"}).write.parquet(f"{folder}/embeddings.parquet")
        got.append(sorted(map(tuple, models.clusters(spark, folder).collect())))
    assert got[0] == got[1] and sum(r[2] for r in got[0]) == 6000
