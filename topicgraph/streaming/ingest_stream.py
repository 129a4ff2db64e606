"""K1: streaming ingest — the batch parser and writer applied to arriving files.

``spark.readStream.text(dir)`` feeds ``parse_payments`` unchanged (it is only
projections and filters); each micro-batch is stored as a folder of its own by
the batch writer, and its rejected lines next to it.  A batch that is run again
after a failure has the same number: if its folder is live it is left alone,
else written anew.  With the checkpoint that is exactly-once, and streams and
batches can write into one table: the ledger has the stream's files too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import ingest
from ..sources import ledger as L
from ..sources.ingest import load_key, parse_payments, parse_records


def read_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory).select("value", F.col("_metadata.file_path").alias("file_path"),
                                         F.col("_metadata.file_size").alias("size"),
                                         F.col("_metadata.file_modification_time").alias("time"))


def stream_payments(spark: SparkSession, directory: str, variant: str = "B",
                    extra: dict[str, str] | None = None) -> DataFrame:
    """The stream of accepted payments."""
    return parse_payments(read_stream(spark, directory), variant, extra, keep_rejects=False)[0]


def start_ingest(spark: SparkSession, directory: str, location: str, checkpoint: str,
                 variant: str = "B", trigger_once: bool = False, extra: dict[str, str] | None = None,
                 grain: str = "day", rejects_location: str | None = None, aggregates: bool = False):
    """Start the K1 query into the table at ``location`` (and its rejected
    lines into ``rejects_location``)."""
    load = f"stream-{load_key(directory)}"

    def store(lines: DataFrame, number: int) -> None:
        session = lines.sparkSession
        name = f"{load}-{number:08d}"
        if any(f.name == name for f in L.Ledger(session, location).live()):
            return
        files = lines.groupBy(F.col("file_path").alias("file")).agg(F.first("size").alias("size"), F.first("time").alias("time"))
        ingest.store(parse_records(lines, variant, extra), location, load, variant, grain, rejects_location,
                     files=files, name=name, removes=[], aggregates=aggregates)

    lines = read_stream(spark, directory)
    q = lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if trigger_once:
        q = q.trigger(availableNow=True)
    return q.start()
