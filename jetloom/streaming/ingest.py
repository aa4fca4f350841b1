"""File-incremental runs: new input files are processed once, as a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def process_new_files(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    max_files: int | None = None,
) -> int:
    """Applies ``transform`` to the Parquet files of ``source`` that no earlier call has taken; returns the number of micro-batches.

    Each micro-batch is written under its number, so that one run again after a failure
    replaces what it had written: every file counts once.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    run = reader.parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(1 for p in run.recentProgress if p.numInputRows)
