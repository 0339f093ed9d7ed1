"""Session helpers: shared checkpoint folder, stored tables."""

from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir, cut_lineage, stored


def test_checkpoint_dir_comes_from_session_conf(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = checkpoint_dir(spark)
    assert configured and configured.rstrip("/").split("/")[-1] in got


def test_cut_lineage_is_reliable_checkpoint(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    assert "LogicalRDD" in cut._jdf.queryExecution().logical().toString()
    assert cut.agg(F.sum("x")).first()[0] == 90


def test_stored_table_is_read_back_with_its_schema(spark):
    df = spark.range(5).selectExpr("id", "array(id) AS a", "CAST(NULL AS STRING) AS s")
    back = stored(df)
    assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert stored(df.limit(0)).count() == 0
