"""The top-tags analytic over a stream of feed files (Structured Streaming).

New CSV feed files dropped into a folder update the per ``(category, tag)``
counts, which live in the streaming state store (checkpointed to the shared
checkpoint folder, so a restarted query or a lost executor resumes from the
last committed batch). After every micro-batch the complete count table is
handed to ``foreachBatch``, where the batch top-k operator cuts and renders
each category's list and the result replaces the previous one at ``out_path``.

Window functions cannot run on a streaming DataFrame, which is why the
ranking happens in ``foreachBatch`` on the aggregate table, not on the
stream itself.

Cost per trigger: complete mode hands the whole count table (one row per
distinct ``(category, tag)``) to ``foreachBatch``, where the top-k is a
distributed batch job (partial ``WindowGroupLimit``), so the work per
trigger grows with the number of distinct tags, not with the new data. As
counts only grow, an update-mode variant could rank just the previous top
k per category together with the keys updated in the batch; it needs a
small versioned state table and is not built here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import attach_name, class_rows_string, explode_tags, keep_enabled, render_top, tag_counts
from ..operators.classify import class_totals, rows_from_totals
from ..schema import FEED_SCHEMA, TOP_K
from ..session import scratch_path
from ..sinks import write_csv


def read_feed_stream(
    spark: SparkSession,
    folder: str,
    *,
    header: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of CSV feed files (same options as ``sources.read_feed``)."""
    reader = (
        spark.readStream.schema(FEED_SCHEMA)
        .option("header", header)
        .option("mode", "DROPMALFORMED")
        .option("quote", '"')
        .option("escape", '"')
        .option("columnPruning", False)
        .option("nullValue", "\0")  # only an unquoted empty cell is NULL
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(folder)


def streaming_tag_counts(feed_stream: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Running ``(category, tag, n)`` counts of a feed stream (stream-static join on the id)."""
    named = attach_name(feed_stream.select("category_id", "tags"), dictionary, how="inner")
    return tag_counts(explode_tags(named, ["category"]), ["category"])


def start_top_tags(
    feed_stream: DataFrame,
    dictionary: DataFrame,
    out_path: str,
    *,
    k: int = TOP_K,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the query; after each batch ``out_path`` holds ``category, top10_tags`` as CSV."""
    spark = feed_stream.sparkSession
    counts = streaming_tag_counts(feed_stream, dictionary)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        top = render_top(batch, ["category"], k, out="top10_tags")
        write_csv(top.withColumn("epoch", F.lit(epoch_id)), out_path, mode="overwrite")

    writer = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint or scratch_path(spark, "top-tags-stream-ckpt"))
        .foreachBatch(publish)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def start_classification(
    feed_stream: DataFrame,
    out_path: str,
    *,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """P1 over a stream of feed files: after each batch ``out_path`` holds the three class rows.

    The per-class counts and sums are one global streaming aggregate (its
    state is a single row); ``foreachBatch`` unpacks it into the three rows
    and replaces the previous result.
    """
    spark = feed_stream.sparkSession
    totals = class_totals(class_rows_string(keep_enabled(feed_stream, semantics="string")), "cls", "comments")

    def publish(batch: DataFrame, epoch_id: int) -> None:
        write_csv(rows_from_totals(batch, "double"), out_path, mode="overwrite", single_file=True)

    writer = (
        totals.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint or scratch_path(spark, "classification-stream-ckpt"))
        .foreachBatch(publish)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
