"""Map study exports as they land in a folder, with Structured Streaming.

The spec language is batch-shaped: eligibility, enrichment and first/last
look at all rows of a participant. An export file is one complete snapshot of
a study, so the stream takes one new file per micro-batch
(``maxFilesPerTrigger=1``) and ``foreachBatch`` runs the normal batch study
job on that file, writing ``<out_dir>/batch=<id>/<entity>.<fmt>``. The stream itself only tells which file
is next; the job reads it as any other source, with its delimiter, encoding, quoted line ends and row order. The file
source's checkpoint records which files are done, so a restarted or failed run picks
up where it stopped, and an export that is mapped again takes the place of its own batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.engine import map_study
from ..sources.readers import read_file
from ..sources.sinks import write_metrics, write_study


def map_exports_stream(spark: SparkSession, source_dir: str, specs: dict, out_dir: str,
                       checkpoint_dir: str, fmt: str = "csv", sep: str | None = None,
                       int_with_nulls: str = "double", available_now: bool = True, bad_rows: str | None = None):
    """Start the stream; returns the ``StreamingQuery`` (already finished when
    ``available_now`` is set, which processes what is there and stops). ``checkpoint_dir`` belongs to this stream alone:
    two streams with one folder would take over each other's progress."""
    if not checkpoint_dir:
        raise ValueError("map_exports_stream needs a checkpoint_dir of its own")
    # lines are not read here: the file's name is all that a batch needs, and it's in the metadata
    files = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(files).option("maxFilesPerTrigger", 1).load(source_dir).select("path")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        into = f"{out_dir.rstrip('/')}/batch={batch_id}"
        for n, row in enumerate(batch.select("path").sort("path").collect()):  # one file
            source = read_file(spark, row["path"], n, int_with_nulls, sep=sep, bad_rows=bad_rows)
            results = map_study(source, specs)
            write_metrics(results, write_study(results, into, fmt), into, fmt, row["path"])

    w = stream.where(F.col("path").isNotNull()).writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
