"""Note files: whole-file scan, file filters, counts, keyed parts and tables."""

from __future__ import annotations

import fnmatch
import os
import re
import urllib.parse
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notequarry.session import materialise, mounted_folder

#: Bytes and files of a batch of contents that a task hands on.
BATCH_BYTES, BATCH_FILES = 4 * 1024 * 1024, 1024


def walkable(spark: SparkSession, root: str, glob: str | None = None) -> str | None:
    """The folder of a root that tasks can list by themselves: mounted, without patterns in its path."""
    if set(root) & set("*?[]{}\\") or set(glob or "") & set("[]{}\\"):
        return None
    folder = mounted_folder(spark, root)
    return folder if folder and os.path.isdir(folder) else None


def _shown(name: str) -> bool:
    """Spark's readers pass over names that begin with a period or an underline."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")
    return not hidden or name.startswith(("_common_metadata", "_metadata"))


def _entries(folder: str, glob: str | None, deep: bool) -> Iterator[tuple[str, int | None]]:
    """(path, length) of the files of a folder, or of all below it; a folder not entered has no length."""
    todo = [folder]
    while todo:
        with os.scandir(todo.pop()) as found:
            for x in found:
                if not _shown(x.name):
                    continue
                if x.is_dir():
                    if deep:
                        todo.append(x.path)
                    else:
                        yield x.path, None
                elif (glob is None or fnmatch.fnmatchcase(x.name, glob)) and (size := x.stat().st_size):
                    yield x.path, size


def _listing(folder: str | None, glob: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in [folder] if folder else batch.column(0).to_pylist():
            paths, sizes = [], []
            for path, size in _entries(at, glob, folder is None):
                paths.append(path)
                sizes.append(size)
                if len(paths) == 10_000:
                    yield pa.record_batch([pa.array(paths), pa.array(sizes, pa.int64())], ["path", "length"])
                    paths, sizes = [], []
            if paths:
                yield pa.record_batch([pa.array(paths), pa.array(sizes, pa.int64())], ["path", "length"])


def listed_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """path, length of the files below a mounted folder, empty ones left out, as Spark's readers do.

    One task lists the folder, others the folders in it; the driver holds none of the names.
    """
    schema = "path string, length long"
    top = materialise(spark.range(0, 1, 1, 1).mapInArrow(partial(_listing, folder, glob), schema), "listing")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    folders = top.filter(F.col("length").isNull()).select("path").repartition(n)
    return top.filter(F.col("length").isNotNull()).union(folders.mapInArrow(partial(_listing, None, glob), schema))


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths, held, size = [], [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with open(path, "rb") as file:
                held.append(file.read())
            paths.append(path)
            size += len(held[-1])
            if size >= BATCH_BYTES or len(held) >= BATCH_FILES:
                yield pa.record_batch([pa.array(paths), pa.array(held, pa.binary())], ["path", "content"])
                paths, held, size = [], [], 0
    if paths:
        yield pa.record_batch([pa.array(paths), pa.array(held, pa.binary())], ["path", "content"])


def file_contents(listed: DataFrame, n_tasks: int) -> DataFrame:
    """path, content of the files of ``listed_files``, read in ``n_tasks``."""
    return listed.select("path").repartition(n_tasks, "path").mapInArrow(_contents, "path string, content binary")


def path_uri(path: str) -> str:
    """A path as Spark's file metadata show it."""
    return "file:" + re.sub(r"[^A-Za-z0-9_!.~'()*,;:$&+=@/\u0080-\U0010ffff-]", lambda m: urllib.parse.quote(m[0]), path)


def whole_files(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """One row per file below a root that is a file or a directory: path, content.

    A missing root is an error. Files are never split. Below a mounted folder they are listed and
    read by tasks; elsewhere Spark lists them, and its driver holds an entry for each.
    """
    folder = walkable(spark, root, glob) if recursive else None
    if folder is not None:
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
        found = file_contents(listed_files(spark, folder, glob), n)
        return found.select(F.concat(F.lit("file:"), "path").alias("path"), "content")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "content")


def whole_texts(spark: SparkSession, root: str, glob: str | None = None, encoding: str = "UTF-8") -> DataFrame:
    """Whole files as text: path, text, failure.

    No byte ends the job. In UTF-8 a wrong byte becomes a replacement character and the row
    says so in ``failure`` (UNDECODABLE_BYTES), else null. Other encodings are decoded as
    they are; Latin-1 and its kin have no wrong bytes.
    """
    files = whole_files(spark, root, glob)
    if encoding.upper().replace("-", "") != "UTF8":
        return files.select("path", F.decode("content", encoding).alias("text"), F.lit(None).cast("string").alias("failure"))
    raw = F.col("content").cast("string")
    failure = F.when(~F.is_valid_utf8(raw), F.lit("UNDECODABLE_BYTES"))
    return files.select("path", F.make_valid_utf8(raw).alias("text"), failure.alias("failure"))


def line_rows(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """A row per line of the files below a root, for files of any size: path, block, pos, line.

    Large files are read in splits. ``block`` is where the split begins in its file, and
    ``pos`` rises within it, so both together give the order of the lines. A line feed ends
    a line, with a carriage return before it; wrong bytes become replacement characters.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    read = reader.text(root).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )
    return read.withColumn("line", F.regexp_replace(F.make_valid_utf8("line"), r"\r\z", ""))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_filters(
    files: DataFrame,
    suffixes: Sequence[str] | None = None,
    patterns: Sequence[str] | None = None,
    names: Sequence[str] | None = None,
    name_table: DataFrame | None = None,
    ignore_system_files: bool = True,
    root: str = "",
    path: str = "path",
) -> DataFrame:
    """Files that pass every filter given.

    Any suffix, any pattern (matching the whole name), any of the names, any name
    in the table. Files and directories below ``root`` that begin with a period
    are left out unless told otherwise.
    """
    name = base_name(F.col(path))
    kept = files
    if suffixes is not None:
        hit = F.lit(False)
        for suffix in suffixes:
            hit = hit | F.endswith(name, F.lit(suffix))
        kept = kept.filter(hit)
    if patterns:
        whole = "|".join(f"(?:{p})" for p in patterns)
        kept = kept.filter(name.rlike(rf"\A(?:{whole})\z"))
    if names is not None:
        kept = kept.filter(name.isin(list(names)))
    if ignore_system_files:
        below = F.substring(F.col(path), len(root) + 1, 1 << 30) if root else F.col(path)
        kept = kept.filter(~below.rlike(r"(?:\A|/)\.") & (name != ""))
    if name_table is not None:
        kept = name_list_semi(kept, name_table, path)
    return kept


def name_list_semi(files: DataFrame, name_table: DataFrame, path: str = "path") -> DataFrame:
    """Files whose name is listed in a table with a ``name`` column."""
    listed = name_table.select(F.col("name").alias("_listed"))
    return files.join(listed, base_name(F.col(path)) == F.col("_listed"), "left_semi")


def file_count(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("n_files"))


def note_blacklist(notes: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Notes whose id is not in the listed ones."""
    return notes.join(listed.select(key).distinct(), key, "left_anti")


def keyed_parts(spark: SparkSession, path: str) -> DataFrame:
    """Stored parts: key, value."""
    return spark.read.parquet(path).select("key", "value")


def keyed_parts_sequence(spark: SparkSession, path: str) -> DataFrame:
    """Legacy sequence files of (text key, text or bytes value).

    Spark's SQL readers know no sequence files, so this decodes row by row in Python. Use it
    once, to turn such files into parquet (``sinks.results.packed_parts``).
    """

    def text(value) -> str:
        return value.decode("utf-8", "replace") if isinstance(value, (bytes, bytearray)) else str(value)

    pairs = spark.sparkContext.sequenceFile(path).map(lambda kv: (text(kv[0]), text(kv[1])))
    return spark.createDataFrame(pairs, "key string, value string")


def table_source(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
