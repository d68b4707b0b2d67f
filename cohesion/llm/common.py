"""Helpers shared by the corpus operators: table access, cut points, Arrow maps."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohesion.session import ensure_checkpoint_dir

#: Rows and bytes in one Arrow batch. Documents may hold 100,000s of characters, so Spark's 10,000 rows or 64 MB, held as
#: Arrow, as Python strings and as results, are much for a worker.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new folder for one intermediate table under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame, kind: str = "cut") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: what follows starts from
    files, so a lost executor costs a re-read and not the steps before, and two readers share one run."""
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From now on Arrow batches hold BATCH_BYTES, or one larger row, unless the session has a limit of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("67108864b", "64MB", "67108864"):
        spark.conf.set(key, str(BATCH_BYTES))


def bound_rows(spark: SparkSession) -> None:
    """``bound_batches``, and BATCH_ROWS rows."""
    bound_batches(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


class Remembered(dict):
    """key -> f(key), remembering results up to a number of bytes; beyond, f is called anew."""

    def __init__(self, f: Callable, most_bytes: int = 32 << 20):
        super().__init__()
        self.f, self.room = f, most_bytes

    def __missing__(self, key):
        return self.remember(key, self.f(key))

    def remember(self, key, out):
        size = 120 + sys.getsizeof(key) + sys.getsizeof(out)  # with its place in the table
        if size <= min(self.room, 4096):
            self[key] = out
            self.room -= size
        return out


def give_back() -> None:
    """Return freed memory to the system, so that a worker that waits for its next task doesn't keep what the last one held."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def arrow_map(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """``mapInArrow`` over column lists. ``make`` runs once in each task and returns a function
    from {column: list} to {column: list}; output columns follow ``schema``."""
    bound_rows(df.sparkSession)
    out_type = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, f = to_arrow_schema(out_type), make()
        for b in batches:
            out = f({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays(
                [v.cast(x.type) if isinstance(v := out[x.name], pa.Array) else pa.array(v, x.type) for x in arrow], schema=arrow)
        del f
        give_back()

    return df.mapInArrow(run, schema)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
