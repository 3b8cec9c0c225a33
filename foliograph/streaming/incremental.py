"""The pipeline's text operators over a stream of elements (an extension: the batch operators, kept up to date).

Per-element operators run as they are on a stream. What compares elements of a document runs in foreachBatch: a batch's
documents are computed anew from all their elements, so a late element changes only its own document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from foliograph.operators.mentions import constraints, references, sentence_index
from foliograph.sources.scratch import settled


def element_stream(spark: SparkSession, folder: str, schema: StructType | str, files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def mention_streams(elements: DataFrame) -> dict[str, DataFrame]:
    """Sentences, references and constraints: stateless, so no watermark is needed."""
    index = sentence_index(elements)
    return {"element_sentences": index, "references": references(elements), "constraints": constraints(index)}


def event_windows(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events by type in tumbling windows; what comes later than `late` is dropped, so state is bounded."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def per_document(stream: DataFrame, history: Callable[[], DataFrame], compute: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Recompute the documents that a batch touches and overwrite their partitions at the sink (partitioned by doc_bucket)."""

    def run(batch: DataFrame, _: int) -> None:
        touched = batch.select("doc_id").distinct()
        whole = history().join(touched, "doc_id", "left_semi")
        out = compute(whole).withColumn("doc_bucket", F.pmod(F.xxhash64("doc_id"), F.lit(256)))
        rest = batch.sparkSession.read.parquet(sink) if _has(batch.sparkSession, sink) else None
        if rest is not None:
            buckets = touched.select(F.pmod(F.xxhash64("doc_id"), F.lit(256)).alias("doc_bucket")).distinct()
            out = rest.join(buckets, "doc_bucket", "left_semi").join(touched, "doc_id", "left_anti").unionByName(out)
            out = settled(out)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("doc_bucket").parquet(sink)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _has(spark: SparkSession, at: str) -> bool:
    from foliograph.sources.tables import exists

    return exists(spark, at)
