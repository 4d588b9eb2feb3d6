"""Event streams: daily totals and purchase sessions with a watermark, and running a stream until its input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.lineage import new_folder


def event_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """The event files of a folder, or one file, as a stream; ``files_per_batch`` bounds a batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isFile():  # a stream reads folders
        folder, _, name = path.rpartition("/")
        reader, path = reader.option("pathGlobFilter", name), folder
    return reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def daily_totals(events: DataFrame, keys: list[str], late: str = "2 days") -> DataFrame:
    """Events and value per key and day, a tumbling window. The state holds the days that may still change: rows that are more
    than ``late`` behind the newest one, as known when the batch before began, are dropped (and counted, see ``run_to_end``). Values are added as whole ten-thousandths, so that
    the order of batches does not matter."""
    units = F.sum(F.rint(F.col("value") * 10000).cast("bigint"))
    return (events.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("_w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"), (units / 10000).alias("value"))
            .select(*keys, F.to_date("_w.start").alias("day"), "n", "value"))


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """Baskets: runs of a key's events less than ``gap`` apart, with start, end of the last event's gap, and number of events."""
    return (events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("_w"), key)
            .agg(F.count(F.lit(1)).alias("n")).select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "n"))


def run_to_end(stream: DataFrame, keys: list[str], mode: str = "update") -> tuple[DataFrame, int]:
    """What an aggregating stream has given when its input is used up, a row per key, and the rows dropped as too late.

    Every batch is written with its number, so that a batch that runs again after a failure replaces itself, and of a key the row of the
    latest batch holds (``update``; ``complete`` gives all rows with every batch, so there only the last batch counts). State and progress are kept in
    the shared folder: a run with the same folder goes on where the last one ended."""
    spark = stream.sparkSession
    out, progress = new_folder(spark), new_folder(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", progress).foreachBatch(write).start()
    query.awaitTermination()
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    rows = spark.read.option("basePath", out).parquet(out)
    if mode == "complete":
        return rows.where(F.col("batch") == rows.agg(F.max("batch")).scalar()).drop("batch"), dropped
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return newest.select(*keys, *[F.col("_v")[c].alias(c) for c in values]), dropped
