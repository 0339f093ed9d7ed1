"""Stream arriving text files through the cleaning projection.

The cleaners are stateless row expressions, so the batch ``transform`` applies
unchanged to a ``readStream`` source; output goes to Parquet with its
checkpoint in the shared checkpoint folder (exactly-once file sink).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidepool.operators.transform import TransformConfig, transform
from tidepool.session import checkpoint_dir


def read_text_stream(spark: SparkSession, path: str, columns: list[str], delimiter: str = ",",
                     max_files_per_trigger: int = 100) -> DataFrame:
    """A streaming all-string CSV source over a landing folder."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.readStream.schema(schema).option("header", True).option("sep", delimiter)
        .option("escape", '"')  # a quote within a quoted field is doubled
        .option("maxFilesPerTrigger", max_files_per_trigger).csv(path)
    )


def start_cleaning(stream: DataFrame, out_path: str, name: str, cfg: TransformConfig = TransformConfig(),
                   trigger_once: bool = True) -> StreamingQuery:
    """Clean every arriving row and append it to Parquet; returns the running query."""
    cleaned, _mapping = transform(stream, cfg)
    ckpt = f"{checkpoint_dir(stream.sparkSession).rstrip('/')}/stream-{name}"
    w = cleaned.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start(out_path)


def start_cleaning_by_name(spark: SparkSession, landing: str, columns: list[str], out_path: str, name: str,
                           cfg: TransformConfig = TransformConfig(), delimiter: str = ",", max_files_per_trigger: int = 100,
                           trigger_once: bool = True) -> StreamingQuery:
    """Clean files as they arrive, each by its own header: columns in any order, some absent, quoted line breaks.

    The stream is one of files, by name; a batch's files, at most ``max_files_per_trigger``, are read by the batch
    reader. Each batch replaces its own ``batch_id`` partition, so one that is played again leaves no second copy.
    """
    from pyspark.sql import functions as F

    from tidepool.sources.text_tables import read_text_table

    def clean(batch: DataFrame, batch_id: int) -> None:
        files = [r["path"] for r in batch.select("path").collect()]  # bounded by the trigger
        if not files:
            return
        rows = read_text_table(batch.sparkSession, files, columns, delimiter, na_tokens=None, multi_line=True)
        cleaned, _mapping = transform(rows.select(*(F.col(f"`{c}`") for c in columns)), cfg)
        (cleaned.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    listing = "path string, modificationTime timestamp, length long, content binary"  # what the source has; contents are not read
    files = spark.readStream.format("binaryFile").schema(listing).option("maxFilesPerTrigger", max_files_per_trigger).load(landing).select("path")
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    w = files.writeStream.foreachBatch(clean).option("checkpointLocation", ckpt)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()


def read_raw_stream(spark: SparkSession, path: str, columns: list[str], delimiter: str = ",",
                    max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming all-string CSV source that keeps malformed lines in ``_corrupt_record`` and the file name."""
    from pyspark.sql import functions as F

    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                          + [T.StructField("_corrupt_record", T.StringType())])
    df = (
        spark.readStream.schema(schema).option("header", True).option("sep", delimiter).option("escape", '"')
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("maxFilesPerTrigger", max_files_per_trigger).csv(path)
    )
    return df.select(F.col("_metadata.file_name").alias("file"), *columns, "_corrupt_record")


def start_validation(stream: DataFrame, columns: list[str], out_path: str, name: str,
                     trigger_once: bool = True) -> StreamingQuery:
    """Per micro-batch parse report (S2, V4, A2) of arriving files, appended idempotently.

    Each batch writes its rows into the ``batch_id`` partition with dynamic
    partition overwrite, so a batch replayed after a failure replaces its own
    output instead of duplicating it.
    """
    from pyspark.sql import functions as F

    from tidepool.sources.text_tables import field_count, parse_report

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # a malformed record carries its raw text, any other has the fields it should
        own = F.coalesce(field_count(F.col("_corrupt_record")), F.lit(len(columns)))
        counted = batch.withColumns({"_fields": own, "_expected": F.lit(len(columns))})
        rep = parse_report(counted, columns).withColumn("batch_id", F.lit(batch_id))
        (rep.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    ckpt = f"{checkpoint_dir(stream.sparkSession).rstrip('/')}/stream-{name}"
    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
