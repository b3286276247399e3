"""VCF files that arrive in a folder: records are parsed and filtered as a stream and handed on in batches.

Gene tests need whole cohorts and stay batch jobs on what the stream has written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from helicase.plans.filterlang import compile_filter
from helicase.sources.vcf import parsed, vcf_schema


def records(spark: SparkSession, folder: str, where: str | None = None) -> DataFrame:
    """An unbounded table of records."""
    raw = spark.readStream.format("text").load(folder)
    out = parsed(raw)
    return out.where(compile_filter(where, vcf_schema(out))) if where else out


def to_parquet(stream: DataFrame, target: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends records by chromosome, exactly once; with once it takes what is there and stops."""
    writer = stream.writeStream.format("parquet").partitionBy("chrom").option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()


def in_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
