"""Continuous collection of log lines, continuous ETL and upserts per micro-batch."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from visitlake import schema as S
from visitlake.functions.timeparts import arrival_date
from visitlake.operators.lines import (
    classify_events, event_digest, packed_by_size, parse_log_lines, rolled_by_size, to_event_rows, valid_events, with_agent_fields,
)
from visitlake.sources.event_table import put_events
from visitlake.sources.writers import append_batch, upsert_table

# Landed files up to this size are written from a row each. Larger ones are few enough to be directories first.
PACKED_BYTES = 1 << 20


def read_line_stream(spark: SparkSession, src: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files as they appear in `src`."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(src)


def _start(writer: DataStreamWriter, checkpoint: str, trigger: str | None) -> StreamingQuery:
    """Runs until stopped every `trigger`, or once over what is there when no trigger is given."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    # state is cleared with the next lines; batches without any would only repeat the whole plan
    spark, setting = writer._spark, "spark.sql.streaming.noDataMicroBatches.enabled"
    former = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        return writer.start()
    finally:
        spark.conf.set(setting, former)


def _batch_label(checkpoint: str, batch_id: int) -> str:
    """Directory of a batch; streams with other checkpoints have other names."""
    return f"{zlib.crc32(checkpoint.encode()):08x}-{batch_id:09d}"


def ingest_stream(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    tz: str = "UTC",
    trigger: str | None = None,
    max_records_per_file: int = 0,
    max_files_per_trigger: int | None = None,
    max_bytes_per_file: int = 128 << 20,
) -> StreamingQuery:
    """Lands new lines unchanged in `dst`, one directory per date of arrival.

    A file is full at `max_bytes_per_file`; only a line longer than that makes a larger one, for itself. `max_records_per_file`
    bounds lines as well (0: no bound). Files of up to PACKED_BYTES are written under their label at once, as moving each of
    so many would take the driver longer than all the rest.
    """
    lines = read_line_stream(spark, src, max_files_per_trigger).withColumn("arrival_date", arrival_date(tz))

    def land(batch: DataFrame, batch_id: int) -> None:
        if max_bytes_per_file <= PACKED_BYTES and not max_records_per_file:
            files = packed_by_size(batch, max_bytes_per_file, ["arrival_date"])
            writer = files.write.format("text").partitionBy("arrival_date").option("maxRecordsPerFile", 1)
            append_batch(writer, batch.sparkSession, dst, 1, _batch_label(checkpoint, batch_id))
            return
        rolled = rolled_by_size(batch, max_bytes_per_file)
        writer = rolled.write.format("text").partitionBy("arrival_date", "roll").option("maxRecordsPerFile", max_records_per_file)
        append_batch(writer, batch.sparkSession, dst, 1, _batch_label(checkpoint, batch_id), "roll")

    return _start(lines.writeStream.foreachBatch(land), checkpoint, trigger)


def etl_lines(
    lines: DataFrame, ip_ranges: DataFrame | None = None, tz: str = "UTC", strict: bool = False, keep: list[str] | None = None,
    **join_options,
) -> DataFrame:
    """The batch ETL without its duplicate removal: no state, one output row per valid line."""
    classified = classify_events(parse_log_lines(lines), strict)
    return to_event_rows(valid_events(classified), ip_ranges, tz, dedupe=False, keep=keep, **join_options)


def etl_stream(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    ip_ranges: DataFrame | None = None,
    tz: str = "UTC",
    strict: bool = False,
    trigger: str | None = None,
    max_files_per_trigger: int | None = None,
    distinct_within: str | None = "1 day",
    **join_options,
) -> StreamingQuery:
    """Appends the events of new lines to the event table `dst`, by date of arrival and kind.

    Every batch fills a slot of its own in the manifest of its day, whatever the number of IP ranges, so batch jobs
    and streams share one table and `read_event_logs` reads all. The date of arrival belongs to the batch: a repeated one
    finds the same date and replaces its own files.

    Of lines with the same content that arrive within `distinct_within` of the first, in one batch, in several or after a
    restart, one event stays, as `dedupe_events` keeps one in a batch job. The stream's state holds a digest of each event
    for that long; late events are never dropped, since it goes by arrival. None keeps all lines.
    """
    arrived = read_line_stream(spark, src, max_files_per_trigger).withColumns({"dt": arrival_date(tz), "arrived": F.current_timestamp()})
    valid = with_agent_fields(valid_events(classify_events(parse_log_lines(arrived), strict)))
    if distinct_within:
        told = valid.withColumn("digest", event_digest(valid, ip_ranges is not None)).withWatermark("arrived", distinct_within)
        valid = told.dropDuplicatesWithinWatermark(["digest"])
    lines = valid.select("dt", "fields")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = to_event_rows(batch, ip_ranges, tz, dedupe=False, keep=["dt"], **join_options)
        put_events(rows, dst, _batch_label(checkpoint, batch_id))

    return _start(lines.writeStream.foreachBatch(write_batch), checkpoint, trigger)


def upsert_batch(root: str, fact: S.FactTable, sequence: str | None = None) -> Callable[[DataFrame, int], None]:
    """Function for `foreachBatch` that upserts fact rows; repeating a batch changes nothing.

    Of rows of one key in a batch the one with the largest `sequence` counts, as a later batch counts over an earlier
    one. Without a sequence, rows of one key that disagree fail the batch, as do those that share their sequence.
    """
    disagree = F.raise_error(F.lit("rows of one key disagree and nothing tells the last")).cast("bigint")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        order = F.col(sequence) if sequence else F.lit(0)
        ranked = batch.withColumn("_order", order)
        last = ranked.groupBy(*fact.keys).agg(
            F.max_by(fact.measure, F.struct("_order", fact.measure)).alias("_most"),
            F.max_by(fact.measure, F.struct("_order", -F.col(fact.measure))).alias("_least"), F.min("created").alias("created"),
        )
        measure = F.when(F.col("_most") == F.col("_least"), F.col("_most")).otherwise(disagree).alias(fact.measure)
        upsert_table(batch.sparkSession, root, fact, last.select(*fact.keys, measure, "created"))

    return upsert


def upsert_stream(
    rows: DataFrame, root: str, fact: S.FactTable, checkpoint: str, sequence: str | None = None, trigger: str | None = None
) -> StreamingQuery:
    return _start(rows.writeStream.foreachBatch(upsert_batch(root, fact, sequence)), checkpoint, trigger)
