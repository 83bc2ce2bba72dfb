"""Lexical resource files: insert scripts, caches, rule files, word lists.

Readers work on a table of lines (file, line_no, line), so that the same code
serves files and lines held in any other table. ``line_no`` only has to order
the lines of a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from notequarry.functions.codes import names_to_bits
from notequarry.session import materialise
from notequarry.resources import CACHE_FREQUENCY_CUTOFF, LEMMA_CACHE_FIELDS, NORM_CACHE_FIELDS

#: Columns of the lexicon tables an insert script may fill.
LEXICON_TABLES = {
    "INFLECTION": "if_term_lc string, if_term string, term_cat int, term_infl int, eui string, "
    "un_term string, un_term_lc string, ct_term string",
    "CANONICAL": "un_term string, can_term string, canon_id int",
    "ANTINORM": "norm_term string, infl_term string, term_cat int, term_infl int, eui string",
    "ACRONYM": "exp_lc string, expansion string, a_type string, acr_lc string, acr string",
    "DERIVATION": "term1_lc string, term1 string, cat1 int, term2_lc string, term2 string, cat2 int",
    "FRUITFUL": "term_lc string, lex_term string, variant_term string, term_cat int, term_infl int, "
    "org_cat int, org_infl int, flow_history string, dist int, tag_info int",
    "NOMINALIZATION": "eui1 string, nom_term1 string, cat1 int, eui2 string, nom_term2 string, cat2 int",
    "LEXSYNONYM": "key_form_nplc string, key_form string, cat1 int, a_synonym string, cat2 int",
    "PROPERNOUN": "proper_noun string",
}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files in file order, without pulling a file into one row."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
        ).alias("line_no"),
        F.col("value").alias("line"),
    )
    return lines


def text_lines(spark: SparkSession, name: str, text: str) -> DataFrame:
    """Lines of a resource that stands in the code."""
    rows = [(name, i, line) for i, line in enumerate(text.splitlines())]
    return spark.createDataFrame(rows, "file string, line_no int, line string")


def insert_script(lines: DataFrame, table: str, schema: str | None = None) -> DataFrame:
    """Rows of one table from ``INSERT INTO t VALUES(...)`` lines; '' is a quote."""
    pattern = r"\AINSERT INTO (\w+) VALUES\((.*)\)\s*\z"
    body = lines.filter(F.regexp_extract("line", pattern, 1) == table).select(
        F.regexp_extract("line", pattern, 2).alias("_values")
    )
    options = {"quote": "'", "escape": "'"}
    parsed = F.from_csv("_values", schema or LEXICON_TABLES[table], options)
    return body.select(parsed.alias("_row")).select("_row.*")


def _fields(lines: DataFrame, count: int, cutoff: int) -> DataFrame:
    # Empty fields do not count, so a closing bar adds none.
    fields = F.filter(F.split("line", "[|]"), lambda f: f != "")
    split = lines.select("line_no", fields.alias("f")).filter(F.size("f") == count)
    return split.filter(F.col("f")[0].try_cast("int") > cutoff)


def norm_cache(lines: DataFrame, cutoff: int = CACHE_FREQUENCY_CUTOFF) -> DataFrame:
    """Word to normal form; of several lines for a word the first wins."""
    rows = _fields(lines, NORM_CACHE_FIELDS, cutoff)
    first = rows.groupBy(F.col("f")[1].alias("cached_word")).agg(
        F.min_by(F.col("f")[2], F.col("line_no")).alias("norm")
    )
    return first


def first_occurrence(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row per key. An aggregate, so a frequent key is combined early."""
    others = [c for c in rows.columns if c != key]
    best = F.min_by(F.struct(*others), F.col(order)).alias("_first")
    return rows.groupBy(key).agg(best).select(key, "_first.*")


def lemma_cache(lines: DataFrame, cutoff: int = CACHE_FREQUENCY_CUTOFF) -> DataFrame:
    """Word, lemma and category bits; all lines of a word are kept as a set."""
    rows = _fields(lines, LEMMA_CACHE_FIELDS, cutoff)
    names = F.regexp_replace(F.col("f")[3], r"\A<|>\z", "")
    return rows.select(
        F.col("f")[1].alias("lemma_word"), F.col("f")[2].alias("lemma"), names_to_bits(names).alias("lemma_bits")
    ).distinct()


def rule_lines(lines: DataFrame) -> DataFrame:
    """Rules of rule files, each with the exceptions that follow it.

    The lines of one file are ordered in one task; rule files are a few hundred lines.
    """
    rule = r"\ARULE:\s*([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(.*?)\s*\z"
    exception = r"\AEXCEPTION:\s*([^|;]*)\|([^|;]*);?\s*\z"
    marked = lines.select(
        "file",
        "line_no",
        "line",
        F.col("line").rlike(rule).alias("is_rule"),
        F.col("line").rlike(exception).alias("is_exception"),
    ).filter(F.col("is_rule") | F.col("is_exception"))
    order = W.partitionBy("file").orderBy("line_no")
    # Numbered by rules seen so far: the exceptions of a rule share its number.
    numbered = marked.withColumn("rule_no", F.sum(F.col("is_rule").cast("int")).over(order))
    pair = F.concat_ws("|", F.regexp_extract("line", exception, 1), F.regexp_extract("line", exception, 2))
    grouped = numbered.groupBy("file", "rule_no").agg(
        F.max(F.when(F.col("is_rule"), F.col("line"))).alias("rule"),
        F.array_sort(F.collect_set(F.when(F.col("is_exception"), pair))).alias("exceptions"),
    )
    names = ("in_pattern", "in_cat", "in_infl", "out_pattern", "out_cat", "out_infl")
    return grouped.filter(F.col("rule").isNotNull()).select(
        F.concat_ws(":", "file", F.lpad(F.col("rule_no").cast("string"), 5, "0")).alias("rule_id"),
        "file",
        *[F.regexp_extract("rule", rule, i).alias(n) for i, n in enumerate(names, start=1)],
        "exceptions",
    )


#: A ``FILE: name`` line pulls another file in.
INCLUDE = r"\AFILE:\s*(\S+)\s*\z"


def include_files(lines: DataFrame, root: str, depth: int = 20) -> DataFrame:
    """Lines of the file ``root`` with every ``FILE:`` line replaced by the lines of that file.

    Includes are followed in place and at any depth; ``line_no`` becomes the path of
    positions that leads to a line, which orders them. A file that is missing adds nothing;
    one that includes itself is an error.
    """
    order = W.partitionBy("file").orderBy("line_no")
    listed = materialise(lines.select("file", F.row_number().over(order).alias("at"), "line"), "lines")
    current = listed.filter(F.col("file") == root).select(F.array("at").alias("line_no"), "line")
    for _ in range(depth):
        name = F.regexp_extract("line", INCLUDE, 1)
        wanted = current.filter(name != "").select(F.col("line_no").alias("_path"), name.alias("_file"))
        if wanted.isEmpty():
            return current.select(F.lit(root).alias("file"), "line_no", "line")
        inner = listed.join(wanted, F.col("file") == F.col("_file")).select(
            F.concat("_path", F.array("at")).alias("line_no"), "line"
        )
        current = materialise(current.filter(name == "").unionByName(inner), "included")
    raise ValueError(f"{root} includes itself, or files more than {depth} deep")


def time_lexicon(lines: DataFrame) -> DataFrame:
    """``phrase,RELATION`` lines, split at the last comma."""
    pattern = r"\A(.*),\s*([A-Z-]+)\s*\z"
    kept = lines.filter(F.col("line").rlike(pattern))
    return kept.select(
        F.regexp_extract("line", pattern, 1).alias("phrase"), F.regexp_extract("line", pattern, 2).alias("relation")
    )


def time_word_list(lines: DataFrame) -> DataFrame:
    """``Class word`` lines."""
    pattern = r"\A(\S+)\s+(.*?)\s*\z"
    kept = lines.filter(F.col("line").rlike(pattern))
    return kept.select(
        F.regexp_extract("line", pattern, 2).alias("time_word"),
        F.regexp_extract("line", pattern, 1).alias("time_class"),
    )


def word_list(lines: DataFrame) -> DataFrame:
    """One word or phrase per line; comments and blank lines are skipped."""
    kept = lines.filter(~F.startswith("line", F.lit("#")) & (F.trim("line") != ""))
    return kept.select(F.trim("line").alias("word"))


def character_map(lines: DataFrame) -> DataFrame:
    """``U+XXXX|target|...`` lines as (source character, target)."""
    pattern = r"\AU\+([0-9A-Fa-f]{4,6})\|([^|]*|\|)\|"
    kept = lines.filter(F.col("line").rlike(pattern))
    code = F.conv(F.regexp_extract("line", pattern, 1), 16, 10).cast("int")
    raw = F.lpad(F.hex(code), 8, "0")
    return kept.select(
        F.decode(F.unhex(raw), "UTF-32").alias("source"), F.regexp_extract("line", pattern, 2).alias("target")
    )

