"""Notes that arrive in a directory, extracted in batches as they come."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notequarry.operators.consume import observed_counts
from notequarry.plans.jobs import Settings, extract, pack_notes
from notequarry.plans.lookup_table import never_sent_whole
from notequarry.session import materialise
from notequarry.sinks.results import RESULT_COLUMNS
from notequarry.sources import files

#: What opening a note costs, in bytes of reading. At Spark's 4 MB a task would read 32 notes of
#: any length, and every task leaves a file of parts.
OPEN_COST = 256 * 1024
#: A note file of a listing.
LISTED = "path string, length long"
#: A line for every batch whose rows are all there.
LEDGER = "run string, batch long, loaded string, folder string, n_rows long, n_parsed long, n_failed long"


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """The batches of a stream that are complete."""
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(f"{out}/ledger")


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """Rows of the complete batches, with ``loaded``; the ledger has one line a batch."""
    folders = [r["folder"] for r in ledger(spark, out).select("folder").collect()]
    reader = spark.read.schema(f"{RESULT_COLUMNS}, loaded STRING")
    if not folders:
        return spark.createDataFrame([], f"{RESULT_COLUMNS}, loaded STRING")
    return reader.parquet(*folders)


def _own_session(spark: SparkSession, settings: dict[str, int]) -> SparkSession:
    """A session with the caller's settings and these; the caller's own stays as it is."""
    own = spark.newSession()
    for name, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def _notes(spark: SparkSession, notes_dir: str, settings: dict[str, int]) -> DataFrame:
    """path, text of note files as a stream of Spark's own."""
    return (
        _own_session(spark, settings)
        .readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .load(notes_dir)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    )


def _listings(spark: SparkSession, folder: str, path: str) -> str:
    """The path of the listings, with one more of the notes that are in none so far, if there are any."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)
    known = spark.read.schema(LISTED).option("recursiveFileLookup", "true").parquet(path).select("path")
    new = materialise(files.listed_files(spark, folder).join(never_sent_whole(known), "path", "left_anti"), "new-notes")
    if new.take(1):
        new.write.parquet(f"{path}/{uuid.uuid4().hex}")
    return path


def incremental_extract(
    spark: SparkSession,
    notes_dir: str,
    out: str,
    checkpoint: str,
    settings: Settings,
    loaded: Callable[[int], str],
    max_size: int = 40000,
):
    """Process every note file not yet seen, then stop.

    A batch writes its rows to a new folder below ``out``, and then its line of the ledger,
    with that folder and the counts observed while it was written. The line is the commit:
    ``read_batches`` reads the folders of the ledger alone, so a batch that broke off half way
    has no rows. One that is run again replaces its own line, and no other's.

    Below a mounted folder tasks list the notes; the paths not listed before are stored beside the
    checkpoint, and the stream reads these listings, so the driver holds no entry for a note.
    Elsewhere the stream reads the notes, and its source keeps an entry for each.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    n_tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    # by itself Spark asks for the files of a batch in a task each, up to 10,000
    few = {"spark.sql.files.openCostInBytes": OPEN_COST, "spark.sql.sources.parallelPartitionDiscovery.parallelism": n_tasks}
    folder = files.walkable(spark, notes_dir)
    if folder is not None:
        listings = _listings(spark, folder, f"{checkpoint}/listings")
        notes = spark.readStream.schema(LISTED).option("recursiveFileLookup", "true").parquet(listings)
    else:
        notes = _notes(spark, notes_dir, few)

    def texts(batch: DataFrame) -> DataFrame:
        """path, text of the notes of a batch; listed ones are read by few tasks, as Spark would."""
        if folder is None:
            return batch
        size = batch.agg(F.sum(F.col("length") + OPEN_COST)).first()[0] or 0
        most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
        read = files.file_contents(batch, max(spark.sparkContext.defaultParallelism, -(-size // most)))
        shown = F.udf(files.path_uri, "string", useArrow=True)
        return read.select(shown("path").alias("path"), F.col("content").cast("string").alias("text"))

    def write(batch: DataFrame, batch_id: int) -> None:
        packed = materialise(pack_notes(texts(batch), max_size), "batch-parts")
        parts = packed.repartition(n_tasks, "key")
        stamp, folder = loaded(batch_id), f"{out}/rows/{run}-{batch_id}-{uuid.uuid4().hex}"
        seen, rows = observed_counts(extract(parts, settings))
        rows.withColumn("loaded", F.lit(stamp)).write.parquet(folder)
        line = (run, batch_id, stamp, folder, *(seen.get[n] for n in ("n_rows", "n_parsed", "n_failed")))
        entry = spark.createDataFrame([line], LEDGER).coalesce(1)
        entry.write.mode("overwrite").parquet(f"{out}/ledger/{run}-{batch_id}")

    return (
        notes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def annotator_hook(
    parts: DataFrame, annotate: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Spans from a user's own annotator, fed with Arrow batches of parts.

    The function sees an iterator per task, so a model is loaded once per task.
    """
    return parts.mapInPandas(annotate, schema)
