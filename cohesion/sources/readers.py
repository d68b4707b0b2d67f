"""Delimited-file sources with pandas-like type inference, and parquet.

CSV/TSV/TXT files are read as text by Spark's CSV reader (splittable, one
task per block), null tokens are nulled, and one aggregation pass over all
columns decides each column's type: whole numbers -> bigint (or double when
the column also has nulls, which is how the spec language's reference engine
stores them and what makes ids render ``1.0``), numbers -> double,
True/False -> boolean, else text.

Every source gets an ``__ord`` column (file index, position) so that
"first"/"last" keep their file-order meaning.
"""

from __future__ import annotations

import csv
import io
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sqltext as Q
from ..session import telling_case
from .records import count_fields, opens, read_records, text_lines

ORD = "__ord"

# The texts read as missing (pandas' default NA tokens), and
# the texts read as booleans.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]

# Delimiters tried for ``.txt`` files, on the header line.
TXT_DELIMITERS = [",", "\t", ";", "|"]

_INT_RX = r"^\s*[+-]?\d+\s*$"
_FLOAT_RX = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|inf|Inf|INF|infinity|Infinity)\s*$"


def _c(n: str) -> Column:
    return F.expr("`" + n.replace("`", "``") + "`")


def hadoop_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the cluster's Hadoop FileSystem (HDFS, S3, local...)."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(p))
    except Exception:  # noqa: BLE001 - no JVM access from this session
        import os

        return os.path.exists(path.removeprefix("file:"))


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter that splits the header line into the most fields; ties go to the first of the list."""
    lines = [r.value for r in spark.read.text(path).limit(1).collect()]
    counts = [lines[0].count(d) if lines else 0 for d in TXT_DELIMITERS]
    return TXT_DELIMITERS[counts.index(max(counts))]


def text_facts(spark: SparkSession, path: str, sep: str = ",") -> tuple[str, bool]:
    """(encoding, whether a quoted field goes over a line end), from one aggregation over the lines.
    UTF-8 unless some line does not decode (then Latin-1, which accepts any byte)."""
    v = F.col("value")
    found = spark.read.option("lineSep", "\n").text(path).agg(F.max(~F.is_valid_utf8(v)), F.max(opens(v, sep))).first()
    return "ISO-8859-1" if found[0] else "UTF-8", bool(found[1])


def detect_encoding(spark: SparkSession, path: str) -> str:
    return text_facts(spark, path)[0]


def delimiter_for(spark: SparkSession, path: str) -> str:
    suffix = Path(path).suffix.lower()
    if suffix == ".tsv":
        return "\t"
    if suffix == ".txt":
        return sniff_delimiter(spark, path)
    return ","


def column_names(fields: list[str]) -> list[str]:
    """The names of a header's fields: an empty one by its place, a repeated one with ``.1``, ``.2`` ... (the first that no
    field has). Names that differ by case are different."""
    given = [f if f else f"Unnamed: {i}" for i, f in enumerate(fields)]
    out: list[str] = []
    for name in given:
        n, now = 0, name
        while now in out or (n and now in given):
            n += 1
            now = f"{name}.{n}"
        out.append(now)
    return out


def _header(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """The header's fields, of the first file of ``path`` that has any line but blank ones."""
    files = spark.read.text(path).inputFiles()
    if not files:
        return []
    filled = "trim('\r' from line) != ''"
    of = min(files)
    head = lambda: text_lines(spark, of, encoding).where(filled).select("line", opens(F.col("line"), sep).alias("more")).limit(1).collect()
    lines = head()
    if not lines and len(files) > 1:  # Spark itself writes an empty first part where the first partition has no rows
        of = text_lines(spark, path, encoding).where(filled).agg(F.min("path")).first()[0]
        lines = head() if of else []
    if not lines:
        return []
    text = lines[0]["line"]
    if lines[0]["more"]:
        text = read_records(spark, of, sep, encoding).where("header").first()["record"]
    fields = next(csv.reader(io.StringIO(text.lstrip("\ufeff").rstrip("\r"), newline=""), delimiter=sep))
    return column_names(fields)


#: Number of fields of a row that has more than the header, else null.
EXTRA = "__fields"
_BAD = "_bad"


class BadRows(ValueError):
    """Rows with more fields than the header."""


def _text_table(spark: SparkSession, path: str, sep: str | None, encoding: str, multi_line: bool | None, file_index: int, whole: bool = False) -> DataFrame:
    """read_text_table with EXTRA. Unless every column is read, EXTRA can be told only if ``whole`` keeps the parser from leaving fields out."""
    sep = sep or delimiter_for(spark, path)
    enc = encoding
    if encoding == "auto" or multi_line is None:
        found, several = text_facts(spark, path, sep)
        enc = found if encoding == "auto" else encoding
        multi_line = several if multi_line is None else multi_line
    names = _header(spark, path, sep, enc)
    if not names:
        return spark.createDataFrame([], f"{EXTRA} int, {ORD} struct<f int, path string, block long, p long>")
    # places, not names, until Spark's own rules on names are past
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))] + [T.StructField(_BAD, T.StringType())])
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    if multi_line:
        rows = read_records(spark, path, sep, enc).where("not header")
        df = rows.select("path", "block", "p", F.from_csv("record", F.lit(schema.simpleString()[7:-1].replace(":", " ")), options | {"multiLine": "true"}).alias("row")).select("path", "block", "p", "row.*")
        order = f"named_struct('f', {int(file_index)}, 'path', path, 'block', block, 'p', p) AS {ORD}"
    else:
        df = spark.read.schema(schema).options(**options, header=True, encoding=enc, columnPruning=not whole).csv(path)
        order = file_order(file_index)
    tokens = ", ".join(Q.lit(t) for t in NULL_TOKENS)
    count = count_fields(F.col(_BAD), sep)
    # Spark refuses a query that reads the malformed record and no other field, as a count of the sound rows would
    also = F.length(F.coalesce(F.col("_0"), F.lit(""))) >= 0
    df = df.withColumn(EXTRA, F.when(F.col(_BAD).isNotNull() & also & (count > len(names)), count).cast("int"))
    return df.selectExpr(*[f"CASE WHEN `_{i}` NOT IN ({tokens}) THEN `_{i}` END AS {Q.ident(c)}" for i, c in enumerate(names)], EXTRA, order)


def read_text_table(spark: SparkSession, path: str, sep: str | None = None, encoding: str = "auto",
                    multi_line: bool | None = None, file_index: int = 0) -> DataFrame:
    """All columns as text, null tokens nulled, BOM stripped from the header, plus
    the row order ``(file index, file path, block start, position)``: splits of
    one file are ordered by their start offset, rows within a split by position.
    ``multi_line`` None: whether quoted fields hold line ends is found in the file. If they do, records are
    found across lines and blocks first (``records``); the file stays split either way."""
    return _text_table(spark, path, sep, encoding, multi_line, file_index).drop(EXTRA)


def malformed_rows(spark: SparkSession, path: str, sep: str | None = None, encoding: str = "auto") -> DataFrame:
    """path, block, p, fields, expected, record of every record with more fields than the header. (One with fewer is filled with nulls.)"""
    sep = sep or delimiter_for(spark, path)
    enc, several = text_facts(spark, path, sep)
    enc = enc if encoding == "auto" else encoding
    expected = len(_header(spark, path, sep, enc))
    rows = read_records(spark, path, sep, enc, several).withColumn("fields", count_fields(F.col("record"), sep))
    return rows.where(F.col("fields") > expected).select("path", "block", "p", F.col("fields").cast("int").alias("fields"), F.lit(expected).alias("expected"), "record")


def file_order(file_index: int) -> str:
    """SQL for the row order of a file source: it doesn't depend on how splits are dealt to tasks."""
    return (f"named_struct('f', {int(file_index)}, 'path', _metadata.file_path, "
            f"'block', _metadata.file_block_start, 'p', monotonically_increasing_id()) AS {ORD}")


def infer_types(df: DataFrame, int_with_nulls: str = "double", bad_rows: str = "keep") -> DataFrame:
    """One aggregation pass over text columns -> cast each to its inferred type.
    Built as SQL text (one expression list) so wide files plan quickly. The same pass counts the rows with EXTRA
    fields: ``bad_rows`` is error (BadRows is raised), skip (they go) or keep (their surplus fields go)."""
    if EXTRA in df.columns and bad_rows == "skip":
        df = df.where(F.col(EXTRA).isNull()).drop(EXTRA)
    cols = [c for c in df.columns if c not in (ORD, EXTRA)]
    if not cols:
        return df.drop(EXTRA)
    int_rx, float_rx = Q.lit(_INT_RX), Q.lit(_FLOAT_RX)
    bools = ", ".join(Q.lit(t) for t in TRUE_TOKENS + FALSE_TOKENS)
    aggs = ["count(1) AS r"]
    for i, c in enumerate(cols):
        v = Q.ident(c)
        aggs += [f"count({v}) AS n{i}", f"count_if({v} RLIKE {int_rx} AND try_cast(trim({v}) AS BIGINT) IS NOT NULL) AS i{i}",
                 f"count_if({v} RLIKE {float_rx}) AS f{i}", f"count_if({v} IN ({bools})) AS b{i}"]
    if EXTRA in df.columns:
        aggs.append(f"count({EXTRA}) AS extra")
    stats = df.selectExpr(*aggs).collect()[0]
    if EXTRA in df.columns and bad_rows == "error" and stats["extra"]:
        raise BadRows(f"{stats['extra']} rows have more fields than the {len(cols)} of the header (malformed_rows lists them; bad_rows='skip' or 'keep' reads on)")
    rows = stats["r"]
    trues = ", ".join(Q.lit(t) for t in TRUE_TOKENS)
    out = []
    for i, c in enumerate(cols):
        n, ni, nf, nb = (stats[f"{k}{i}"] for k in "nifb")
        v = Q.ident(c)
        stripped = f"regexp_replace({v}, '^\\\\s+|\\\\s+$', '')"
        if n == 0:
            e = f"CAST({v} AS DOUBLE)"  # all-missing column: float NaN in pandas
        elif ni == n:
            e = f"try_cast({stripped} AS BIGINT)"
            if n < rows and int_with_nulls == "double":
                e = f"CAST({e} AS DOUBLE)"
        elif nf == n:
            e = f"try_cast({stripped} AS DOUBLE)"
        elif nb == n:
            e = f"({v} IN ({trues}))"
        else:
            e = v
        out.append(f"{e} AS {v}")
    if ORD in df.columns:
        out.append(ORD)
    return df.selectExpr(*out)


def with_order(df: DataFrame, file_index: int = 0) -> DataFrame:
    """Row order of a file: (file index, position). The position comes from
    ``monotonically_increasing_id``, which follows file order within a file."""
    return df.withColumn(ORD, F.struct(F.lit(file_index).alias("f"), F.monotonically_increasing_id().alias("p")))


def read_file(spark: SparkSession, path: str, file_index: int = 0, int_with_nulls: str = "double",
              encoding: str = "auto", sep: str | None = None, schema: dict | None = None,
              multi_line: bool | None = None, bad_rows: str | None = None) -> DataFrame:
    """A1-A5: ``.csv`` (and any unknown suffix) comma, ``.tsv`` tab, ``.txt``
    sniffed; ``.parquet`` read as is. ``schema`` ({column: Spark type}) skips
    the inference pass: the file is then read once. ``bad_rows`` says what becomes of rows with more fields than the header: error
    (the default), skip, or keep without the surplus (the default with ``schema``, as telling takes a look at every field)."""
    if Path(path).suffix.lower() == ".parquet":
        return spark.read.parquet(path).selectExpr("*", file_order(file_index))
    raw = _text_table(spark, path, sep, encoding, multi_line, file_index, whole=bad_rows == "skip" or bool(schema) and bad_rows == "error")
    with telling_case(spark, raw.columns):
        if not schema:
            return infer_types(raw, int_with_nulls, bad_rows or "error")
        if bad_rows == "skip":
            raw = raw.where(F.col(EXTRA).isNull())
        elif bad_rows == "error":
            raw = raw.where(F.when(F.col(EXTRA).isNotNull(), F.raise_error(F.lit(f"a row of {path} has more fields than the header")).isNull()).otherwise(True))
        return raw.drop(EXTRA).select(*[(F.regexp_replace(_c(c), r"^\s+|\s+$", "").try_cast(schema[c]).alias(c)
                                        if c in schema and schema[c] != "string" else _c(c)) for c in raw.columns if c != EXTRA])


def find_entity_file(spark: SparkSession, directory: str, entity: str) -> str:
    """A7: ``<entity>.csv``, ``.tsv`` then ``.txt`` in that order."""
    for ext in (".csv", ".tsv", ".txt"):
        p = f"{directory.rstrip('/')}/{entity}{ext}"
        if hadoop_exists(spark, p):
            return p
    raise FileNotFoundError(f"no source file for entity {entity!r} in {directory}")
