"""Stream sources and the run helpers shared by the streaming jobs."""
from pyspark.sql import functions as F

from tickloom.session import shared_dir


def parse_messages(messages, schema):
    """Rows of messages whose ``value`` (bytes or text) is JSON; a message that does not parse gives nulls."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("v")).select("v.*")


def source(spark, kind, schema=None, **options):
    """A stream by name: parquet / csv / json folders, rate, or kafka where its connector
    is installed (brokers and topic as options; the value is parsed as JSON)."""
    reader = spark.readStream.format(kind)
    if kind == "kafka":
        return parse_messages(reader.options(**options).load(), schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load()


def event_ticks(spark, path):
    """Ticks from the event table as a stream (zone-less times are read as UTC)."""
    schema = spark.read.parquet(f"{path}/events.parquet").schema
    events = source(spark, "parquet", schema, path=path, pathGlobFilter="events.parquet")
    return events.select(F.concat(F.lit("S"), (F.col("user_id") % 5).cast("string")).alias("symbol"),
                         F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"),
                         F.col("event_id").alias("tick_id"))


def to_table(stream, path, checkpoint=None, trigger=None, by=None):
    """Append the stream to a parquet table; exactly once through the sink's log."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint or shared_dir(stream.sparkSession, "checkpoint"))
    if by:
        writer = writer.partitionBy(*by)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def per_batch(stream, handle, checkpoint=None, trigger=None):
    """Run ``handle(frame, batch_id)`` on every micro-batch."""
    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint or shared_dir(stream.sparkSession, "checkpoint"))
            .trigger(**(trigger or {"availableNow": True})).start())


def finish(query):
    """Wait for a run over the available data; failures surface here."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
