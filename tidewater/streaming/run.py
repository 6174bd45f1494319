"""Run a streaming DataFrame over what its source holds now, writing to shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import ROCKSDB, new_dir, settings


BYTES_PER_BATCH = 1 << 30

#: Settings under which rows are staged and streams run: small files, and shuffle files that go when their job ends.
STAGING = {"spark__sql__parquet__compression__codec": "zstd", "spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}


def stream_table(
    spark: SparkSession, path: str, schema, per_batch: int | None = None, bytes_per_batch: int = BYTES_PER_BATCH, **options: str
) -> DataFrame:
    """Parquet files as a stream, admitted by size, or ``per_batch`` files at a time.

    The admitted amount bounds what a state operator holds of one key; a backlog is better handled by the batch form.
    """
    admit = ("maxFilesPerTrigger", str(per_batch)) if per_batch else ("maxBytesPerTrigger", str(bytes_per_batch))
    return spark.readStream.schema(schema).option(*admit).options(**options).parquet(path)


def state_partitions(spark: SparkSession) -> str:
    """Partitions of keyed state: the session's setting, and in local mode no more than there are cores."""
    wanted = spark.conf.get("spark.sql.shuffle.partitions")
    if spark.sparkContext.master.startswith("local"):
        return str(min(int(wanted), spark.sparkContext.defaultParallelism))
    return wanted


def _state(spark: SparkSession):
    return settings(
        spark,
        spark__sql__streaming__stateStore__providerClass=ROCKSDB,
        spark__sql__shuffle__partitions=state_partitions(spark),
        # state of batches long past is not read again, and rows are not counted with a read before each write
        spark__sql__streaming__minBatchesToRetain="2",
        spark__sql__streaming__stateStore__rocksdb__trackTotalNumberOfRows="false",
        **STAGING,
    )


def run_to_end(
    df: DataFrame, label: str, checkpoint: str | None = None, path: str | None = None, wait_for_idle: bool = True
) -> DataFrame:
    """Append all output rows to files and return them as a batch DataFrame.

    Keyed state lives in RocksDB; the checkpoint of the first run fixes the number of state partitions.
    Of several inputs the slowest sets the watermark; with ``wait_for_idle`` off the fastest does, so that an idle
    input holds nothing back.
    """
    spark = df.sparkSession
    path, checkpoint = path or new_dir(spark, label), checkpoint or new_dir(spark, f"{label}-checkpoint")
    policy = "min" if wait_for_idle else "max"
    with _state(spark), settings(spark, spark__sql__streaming__multipleWatermarkPolicy=policy):
        query = (
            df.writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def run_complete(df: DataFrame, label: str) -> DataFrame:
    """Final result table of a streaming aggregation in complete mode.

    Every batch replaces the result folder named by its id, so a repeated batch changes nothing.
    """
    spark = df.sparkSession
    path, seen = new_dir(spark, label), []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        seen.append(batch_id)

    with _state(spark):
        query = (
            df.writeStream.outputMode("complete")
            .foreachBatch(write)
            .option("checkpointLocation", new_dir(spark, f"{label}-checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/batch={max(seen)}")
