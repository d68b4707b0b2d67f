"""Records of delimited text whose quoted fields may go over line ends, found without giving up splits.

A split of a file holds the lines that begin in it. A line read from outside a quoted field ends outside or inside
one, and so does a line read from inside: two answers, given by two patterns over the line alone. Composed over the
lines of a block they are the block's own two answers; composed over a file's blocks in order (one row for each block)
they tell in which state each block begins. With that, every task knows which of its lines begin records. At most two
pieces of a block belong to a record of a neighbour; these few are put together by a window over them.

Only the borders of records are found here. The fields are parsed by Spark's CSV parser.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored

#: Start states of so many blocks are broadcast; of more, they meet the lines in a shuffle.
BROADCAST_BLOCKS = 100_000
WHOLE, HEAD, OPEN, HEADER = range(4)

_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'
_UNCLOSED = '"[^"]*+(?:""[^"]*+)*+\\z'


def _in_class(sep: str) -> str:
    return "\\t" if sep == "\t" else "\\" + sep


def _field(sep: str) -> str:
    """A field without its delimiter: quoted (text may follow the closing quote), plain, or empty."""
    rest = f"[^{_in_class(sep)}]*+"
    return f'(?:{_QUOTED}{rest}|[^"{_in_class(sep)}]{rest}|)'


def opens(line: Column, sep: str) -> Column:
    """Whether a line that begins outside a quoted field ends inside one."""
    return (F.instr(line, '"') > 0) & line.rlike(f"\\A(?:{_field(sep)}{_in_class(sep)})*+{_UNCLOSED}")


def stays(line: Column, sep: str) -> Column:
    """Whether a line that begins inside a quoted field ends inside one (the same or another)."""
    own = '\\A[^"]*+(?:""[^"]*+)*+'
    again = f'"[^{_in_class(sep)}]*+{_in_class(sep)}(?:{_field(sep)}{_in_class(sep)})*+{_UNCLOSED}'
    return (F.instr(line, '"') == 0) | line.rlike(f"{own}(?:\\z|{again})")


def count_fields(record: Column, sep: str) -> Column:
    """How many fields a record has."""
    return F.regexp_count(F.concat(record, F.lit(sep)), F.lit(f"{_field(sep)}{_in_class(sep)}"))


def text_lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """path, block, p (place in its task), line. Lines end at line feeds alone, so that a carriage return inside quotes is kept."""
    line = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("p"), line.alias("line"))


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, block, from_outside, from_inside): the two answers of each block."""
    at, out = None, None
    done: list[tuple] = []
    for b in batches:
        for path, block, a, c in zip(*(x.to_pylist() for x in b.columns)):
            if (path, block) != at:
                if at:
                    done.append((*at, *out))
                at, out = (path, block), (False, True)
            if (a, c) != (False, True):
                out = (c if out[0] else a, c if out[1] else a)
    if at:
        done.append((*at, *out))
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.bool_(), pa.bool_()))],
                                     names=["path", "block", "from_outside", "from_inside"])


def _in_order(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state in which each block of one file begins."""
    pdf = pdf.sort_values("block")
    inside, out = False, []
    for a, c in zip(pdf["from_outside"], pdf["from_inside"]):
        out.append(inside)
        inside = bool(c if inside else a)
    return pdf[["path", "block"]].assign(inside=out)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order -> (path, block, p, record, kind)."""
    at, inside, kind, held, first = None, False, WHOLE, [], None

    def close(now: int) -> tuple:
        return (*at, first, "\n".join(held), now)

    for b in batches:
        out: list[tuple] = []
        for path, block, p, line, a, c, begins_inside in zip(*(x.to_pylist() for x in b.columns)):
            if (path, block) != at:
                if held:
                    out.append(close(OPEN if inside and kind != HEAD else kind))
                at, inside, held, first = (path, block), begins_inside, [], p
                kind = HEAD if inside else HEADER if block == 0 else WHOLE
            elif not inside:
                if held:
                    out.append(close(kind))
                    kind = WHOLE
                held, first = [], p
            held.append(line)
            inside = c if inside else a
            if kind == HEADER and not inside and held[0].strip("\r") == "":
                held = []  # blank lines before the header
        yield _piece_batch(out)
    if held:
        yield _piece_batch([close(OPEN if inside and kind != HEAD else kind)])


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(kinds)], names=["path", "block", "p", "record", "kind"])


def read_records(spark: SparkSession, path: str, sep: str, encoding: str = "UTF-8", several: bool = True) -> DataFrame:
    """path, block, p, record, header (whether it is its file's first): blank records left out, line ends cut off.
    ``several``: quoted fields may go over line ends; otherwise each line is a record, and headers are not told apart."""
    lines = text_lines(spark, path, encoding)
    if several:
        marked = lines.withColumns({"from_outside": opens(F.col("line"), sep), "from_inside": stays(F.col("line"), sep)})
        blocks = marked.select("path", "block", "from_outside", "from_inside").mapInArrow(_answers, "path string, block long, from_outside boolean, from_inside boolean")
        states = stored(blocks.groupBy("path").applyInPandas(_in_order, "path string, block long, inside boolean"), "blocks")
        if states.count() <= BROADCAST_BLOCKS:
            known = marked.join(F.broadcast(states), ["path", "block"])
        else:
            known = marked.join(states.hint("merge"), ["path", "block"]).repartition("path", "block").sortWithinPartitions("path", "block", "p")
        pieces = known.select("path", "block", "p", "line", "from_outside", "from_inside", "inside").mapInArrow(
            _assembled, "path string, block long, p long, record string, kind int")
        # the few pieces of records that cross blocks: a head goes on what the last open piece before it began
        parts = stored(pieces.where(F.col("kind").isin(HEAD, OPEN)), "pieces")
        order = Window.partitionBy("path").orderBy("block", "kind")
        joined = (parts.withColumn("of", F.sum((F.col("kind") == OPEN).cast("int")).over(order))
                  .groupBy("path", "of").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "p", "record"))).alias("all"))
                  .select("path", F.col("all")[0]["block"].alias("block"), F.col("all")[0]["p"].alias("p"),
                          F.array_join(F.transform("all", lambda x: x["record"]), "\n").alias("record"), F.lit(WHOLE).alias("kind")))
        records = pieces.where(~F.col("kind").isin(HEAD, OPEN)).unionByName(joined).withColumn("header", F.col("kind") == HEADER).drop("kind")
    else:
        records = lines.withColumnRenamed("line", "record").withColumn("header", F.lit(False))
    return records.withColumn("record", F.regexp_replace("record", "\r\\z", "")).where("record != ''")
