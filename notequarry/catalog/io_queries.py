"""Queries that write to the shared folder and read back what was written."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from notequarry.catalog import fixtures as X
from notequarry.catalog.mention_queries import RESULT, listed_spans, raw_parts, settings
from notequarry.catalog.registry import query
from notequarry.functions.register import register_functions
from notequarry.plans import jobs
from notequarry.session import mounted_folder, scratch_path
from notequarry.sinks import results as sinks
from notequarry.sources import annotations as annotation_sources
from notequarry.sources import files
from notequarry.streaming.incremental import annotator_hook, incremental_extract, read_batches

PATHS = """(SELECT doc_id, text, '/notes/' || CASE WHEN doc_id % 7 = 0 THEN '.cache/' ELSE '' END || lang || '/'
    || CASE WHEN doc_id % 11 = 0 THEN '.' ELSE '' END || doc_id
    || ([ '.txt', '.xml', '.txt.bak'])[doc_id % 3 + 1] AS path FROM documents)"""
PASSES = """doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 3 < 2
    AND (doc_id % 3 = 0 OR CAST(doc_id AS VARCHAR) LIKE '1%')"""


def note_files(spark, sf):
    docs = X.table(spark, sf, "documents")
    endings = F.array(F.lit(".txt"), F.lit(".xml"), F.lit(".txt.bak"))
    path = F.concat(
        F.lit("/notes/"),
        F.when(F.col("doc_id") % 7 == 0, F.lit(".cache/")).otherwise(F.lit("")),
        "lang",
        F.lit("/"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(".")).otherwise(F.lit("")),
        "doc_id",
        F.element_at(endings, (F.col("doc_id") % 3 + 1).cast("int")),
    )
    return docs.select("doc_id", path.alias("path"))


def filtered(spark, sf):
    return files.file_filters(
        note_files(spark, sf), suffixes=(".txt", ".xml"), patterns=(r"[0-9]+\.txt", r"1[0-9]*\.xml"), root="/notes"
    )


@query(f"SELECT doc_id, path FROM {PATHS} WHERE {PASSES}")
def file_filters(spark, sf):
    return filtered(spark, sf)


@query(f"SELECT count(*) AS n_files FROM {PATHS} WHERE {PASSES}")
def file_count(spark, sf):
    return files.file_count(filtered(spark, sf))


@query(f"SELECT doc_id, path FROM {PATHS} WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id % 3 = 0 AND doc_id % 11 <> 0")
def name_list_semi(spark, sf):
    names = X.table(spark, sf, "labels").select(F.concat("doc_id", F.lit(".txt")).alias("name"))
    return files.name_list_semi(note_files(spark, sf), names)


def written_files(spark, sf, table: str = "documents") -> str:
    """The texts of a table as one small text file each, a folder for every task.

    The folders are listed by tasks. On a mounted file system the tasks write the files themselves,
    under names that a second attempt gives again: Hadoop starts processes for every file there,
    to set its permissions.
    """
    path = scratch_path(spark, "note-files")
    n = max(64, 4 * spark.sparkContext.defaultParallelism)
    texts = X.table(spark, sf, table).select("text").repartition(n)
    folder = mounted_folder(spark, path)
    if folder is not None:
        os.makedirs(folder)
        texts.mapInArrow(partial(_write_texts, folder), "n long").agg(F.sum("n")).collect()
    else:
        dealt = texts.withColumn("folder", F.spark_partition_id())
        dealt.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
    return path


def _write_texts(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A file for every text of a task, in a folder of its own; a null is an empty text."""
    task = TaskContext.get().partitionId()
    own = f"{folder}/folder={task}"
    texts = (text for batch in batches for text in batch.column(0))
    n = 0
    for n, text in enumerate(texts, start=1):
        if n == 1:
            os.makedirs(own, exist_ok=True)
        with open(f"{own}/part-{task:05d}-{n:08d}.txt", "wb") as out:
            out.write(text.as_buffer() or b"")
            out.write(b"\n")
    yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})


@query("SELECT text || chr(10) AS text, CAST(NULL AS VARCHAR) AS failure FROM documents")
def whole_file_source(spark, sf):
    return files.whole_texts(spark, written_files(spark, sf), "*.txt").select("text", "failure")


@query("SELECT count(*) AS n_files FROM documents")
def single_or_dir_root(spark, sf):
    return files.file_count(files.whole_files(spark, written_files(spark, sf), "*.txt"))


PACKED = ("SELECT 'hdfs://nn/notes/' || lang || '/' || doc_id || '.txt-' || part AS key, p.text AS value "
          "FROM parts p JOIN documents d USING (doc_id)")


@query(PACKED)
def keyed_part_source(spark, sf):
    path = scratch_path(spark, "parts")
    sinks.packed_parts(jobs.pack_notes(X.notes(spark, sf), X.PART_CAP), path)
    return files.keyed_parts(spark, path)


@query(PACKED)
def packed_part_sink(spark, sf):
    return jobs.pack_note_files(spark, X.notes(spark, sf), scratch_path(spark, "packed"), 4, X.PART_CAP)


@query("SELECT doc_id, text FROM documents")
def table_source(spark, sf):
    name = "notequarry_notes"  # one name, so that calls leave one table and not many
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{sf}/documents.parquet'")
    return files.table_source(spark, name).select("doc_id", "text")


ROWS = """SELECT CAST(doc_id AS VARCHAR) AS fname, lang AS part, doc_id % 5 <> 0 AS parsed, text,
    CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS annotations, 'C1 ^ "C2"' AS cuis FROM documents"""


def result_rows(spark, sf):
    return X.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("fname"),
        F.col("lang").alias("part"),
        (F.col("doc_id") % 5 != 0).alias("parsed"),
        "text",
        F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("annotations"),
        F.lit('C1 ^ "C2"').alias("cuis"),
    )


@query(ROWS)
def delimited_sink(spark, sf):
    path = scratch_path(spark, "delimited")
    sinks.delimited(result_rows(spark, sf), path)
    return sinks.read_delimited(spark, path, sinks.RESULT_COLUMNS)


@query(f"SELECT *, '202601010930' AS loaded FROM ({ROWS}) UNION ALL SELECT *, '202601021015' FROM ({ROWS})")
def partitioned_append_sink(spark, sf):
    path = scratch_path(spark, "results")
    for stamp in ("202601010930", "202601021015"):
        sinks.partitioned_append(result_rows(spark, sf), path, stamp)
    return spark.read.schema(f"{sinks.RESULT_COLUMNS}, loaded STRING").parquet(path)


@query(f"SELECT *, '202601010930' AS loaded FROM ({ROWS})")
def result_table_ddl(spark, sf):
    table, template = "notequarry_results", "notequarry_template"
    sinks.create_result_tables(spark, table, template, scratch_path(spark, "tables"))
    rows = result_rows(spark, sf).withColumn("loaded", F.lit("202601010930"))
    sinks.union_template(spark.table(template), rows).write.mode("append").insertInto(table)
    return spark.table(table)


@query(f"{ROWS} UNION ALL {ROWS}")
def union_template(spark, sf):
    rows = result_rows(spark, sf)
    return sinks.union_template(rows, rows)


@query(ROWS)
def compressed_output(spark, sf):
    path = scratch_path(spark, "compressed")
    result_rows(spark, sf).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def mention_spans(spark, sf):
    return X.mentions(spark, sf).select(
        "doc_id", "part", F.col("mention_class").alias("kind"), "begin", "end", F.col("sem_group").alias("label"),
        "concept", "polarity", "uncertainty",
    )


@query("SELECT doc_id, part, count(*) AS n_spans FROM mentions GROUP BY doc_id, part")
def annotation_sink(spark, sf):
    path = scratch_path(spark, "annotations")
    sinks.annotation_documents(mention_spans(spark, sf), ["doc_id", "part"]).write.parquet(path)
    counted = (F.size(F.split("annotations", "<span>")) - 1).cast("bigint")
    return spark.read.parquet(path).select("doc_id", "part", counted.alias("n_spans"))


@query(
    """SELECT doc_id, part, mention_class AS kind, CAST("begin" AS INTEGER) AS "begin", CAST("end" AS INTEGER) AS "end",
       sem_group AS label, concept, polarity, uncertainty FROM mentions"""
)
def annotation_source(spark, sf):
    documents = sinks.annotation_documents(mention_spans(spark, sf), ["doc_id", "part"])
    return annotation_sources.annotation_rows(documents, "annotations", ["doc_id", "part"])


@query(f"""SELECT fname AS name, part, 'xmis' AS kind, annotations AS payload FROM ({ROWS})
           UNION ALL SELECT fname, part, 'cuis', cuis FROM ({ROWS})""")
def per_document_text_sink(spark, sf):
    path = scratch_path(spark, "documents")
    sinks.per_document_text(result_rows(spark, sf), path)
    return spark.read.parquet(path).select("name", "part", "kind", "payload")


@query("SELECT replace(text, chr(10), ' ') AS value FROM sentences")
def corpus_sink(spark, sf):
    path = scratch_path(spark, "corpus")
    # A lone carriage return would end a line when the corpus is read back.
    lines = X.sentences(spark, sf).select(F.translate("text", "\n", " ").alias("line"))
    sinks.corpus(lines, path)
    return spark.read.option("lineSep", "\n").text(path)


RESULTS = "SELECT fname, part, parsed, text, annotations, cuis FROM results"


@query(f"SELECT *, '202601010930' AS loaded FROM ({RESULTS})", RESULT)
def extract_to_table(spark, sf):
    path = scratch_path(spark, "extracted")
    jobs.extract_to_table(raw_parts(spark, sf), settings(spark, sf), path, "202601010930")
    return listed_spans(spark.read.schema(f"{sinks.RESULT_COLUMNS}, loaded STRING").parquet(path))


@query(
    """SELECT count(*) AS n_rows, count(*) FILTER (parsed) AS n_parsed, count(*) FILTER (NOT parsed) AS n_failed
       FROM results""",
    RESULT,
)
def observed_counts(spark, sf):
    """Counts taken while the extraction is written, as a row."""
    counts = jobs.extract_to_table(raw_parts(spark, sf), settings(spark, sf), scratch_path(spark, "counted"), "202601010930")
    return spark.createDataFrame([(counts["n_rows"], counts["n_parsed"], counts["n_failed"])], "n_rows long, n_parsed long, n_failed long")


@query(RESULTS, RESULT)
def extract_to_files(spark, sf):
    path = scratch_path(spark, "extracted-files")
    jobs.extract_to_files(raw_parts(spark, sf), settings(spark, sf), path)
    return listed_spans(sinks.read_delimited(spark, path, sinks.RESULT_COLUMNS))


@query(
    """SELECT CAST(part AS VARCHAR) AS part, true AS parsed, text, coalesce(listed, '') AS annotations,
       coalesce(cuis, '') AS cuis, '202601010000' AS loaded
       FROM parts LEFT JOIN event_strings USING (doc_id, part) LEFT JOIN span_lists USING (doc_id, part)""",
    RESULT,
)
def incremental_extract_job(spark, sf):
    """The notes as files, read as a stream and extracted in batches."""
    out, marks = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    stream = incremental_extract(
        spark, written_files(spark, sf), out, marks, settings(spark, sf), lambda batch: f"20260101{batch:04d}", X.PART_CAP
    )
    stream.awaitTermination()
    return listed_spans(read_batches(spark, out)).drop("fname")


@query(
    r"""SELECT doc_id, 'hdfs://nn/notes/' || doc_id || '.txt-3' AS key, CAST(doc_id AS VARCHAR) AS encounter,
        3 AS part, (SELECT count(*) FROM parts p WHERE p.doc_id = d.doc_id) AS n_parts FROM documents d"""
)
def sql_functions(spark, sf):
    register_functions(spark)
    docs = X.table(spark, sf, "documents").select("doc_id", "text")
    keyed = docs.selectExpr("doc_id", "text", "nq_part_key(concat('hdfs://nn/notes/', doc_id, '.txt'), 3) AS key")
    return keyed.selectExpr(
        "doc_id",
        "key",
        "nq_encounter_id(nq_key_path(key)) AS encounter",
        "nq_key_part(key) AS part",
        f"CAST(size(nq_split_parts(text, {X.PART_CAP})) AS BIGINT) AS n_parts",
    )


@query('SELECT doc_id, part, CAST(0 AS BIGINT) AS "begin", length(text) AS "end" FROM parts', name="annotator_hook")
def _annotator_hook(spark, sf):
    def whole(batches):
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "part": batch["part"], "begin": 0, "end": batch["text"].str.len()}
            )

    parts = X.note_parts(spark, sf)
    return annotator_hook(parts, whole, "doc_id bigint, part int, begin bigint, end bigint")
