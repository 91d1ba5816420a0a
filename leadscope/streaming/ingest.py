"""Incremental activity ingest: new daily export files -> the partitioned activity dataset.

The batch export walks channel x day and converts each file once.  Here Structured
Streaming tracks which files were already converted: one file-source query over the export
folder parses each file once per micro-batch and writes typed rows into the dataset
(partitioned by channel / snapshot / day) and rejected rows with their reason into a rejects
table.  Both are written below a folder named by the micro-batch, which is replaced as a
whole: a batch that is run again after a failure leaves the same files, so every file
counts exactly once.  ``availableNow`` processes what is there and stops, which fits a daily
schedule.  Channel and day come from the export name in the file path; rows of files that
are not named exports are rejected (``unknown_export``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadscope.functions.dates import parse_date_text
from leadscope.sources.dataset import PARTITION_COLUMNS
from leadscope.sources.exports import channel_of_file, day_of_file, good, parse_activity_lines

UNKNOWN_EXPORT = "unknown_export"


@dataclass
class IngestStream:
    query: StreamingQuery

    def await_all(self) -> None:
        """Wait until the stream ends; its error is raised."""
        self.query.awaitTermination()


def parse_export_files(lines: DataFrame) -> DataFrame:
    """(line, source_file) -> typed rows with channel, activity_date, line and reject_reason."""
    parsed = (parse_activity_lines(lines, keep_line=True)
              .withColumn("channel", channel_of_file(F.col("source_file")))
              .withColumn("activity_date", F.coalesce(day_of_file(F.col("source_file")),
                                                      parse_date_text(F.col("date_text")))))
    # a row whose file is not a named export has no channel or day: rejected, never put in a null partition
    reason = F.coalesce(F.col("reject_reason"),
                        F.when(F.col("channel").isNull() | F.col("activity_date").isNull(), F.lit(UNKNOWN_EXPORT)))
    return parsed.withColumn("reject_reason", reason)


def start_activity_ingest(spark: SparkSession, source_dir: str, dataset_path: str, rejects_path: str,
                          checkpoint_dir: str, snapshot: str = "full",
                          max_files_per_trigger: int | None = None, available_now: bool = True) -> IngestStream:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))

    def convert(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_export_files(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            def put(df: DataFrame, path: str, *by: str) -> None:
                (df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by)
                 .parquet(f"{path.rstrip('/')}/batch={batch_id}"))

            put(good(parsed).drop("line").withColumn("snapshot", F.lit(snapshot)), dataset_path, *PARTITION_COLUMNS)
            put(parsed.filter(F.col("reject_reason").isNotNull())
                .select("source_file", "line", F.col("reject_reason").alias("reason")), rejects_path)
        finally:
            parsed.unpersist()

    writer = lines.writeStream.foreachBatch(convert).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return IngestStream(writer.start())
