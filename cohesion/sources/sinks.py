"""Sinks: one output per entity, written by the executors.

CSV (header, no index) or parquet, one directory per entity written in
parallel (``<dir>/<entity>.csv/part-*``). An entity is written to a staging
folder of the output directory first and put in its place by renaming when it is
complete, so that a run that fails leaves the former output as it was. An empty
result is not kept, and a former output of it goes. ``write_study`` leaves a manifest
with what became of each entity.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .readers import hadoop_exists

#: Text in CSV keeps its white space, and quotes inside are doubled.
CSV = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    target = _fs(spark, to)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"{path} could not be renamed to {to}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _save(df: DataFrame, path: str, fmt: str) -> None:
    (df.write.options(**CSV).csv(path) if fmt == "csv" else df.write.parquet(path))


def _stage(result, folder: str, fmt: str) -> tuple[str, str, int]:
    """(name, staged path, rows) of an EntityResult or DataFrame; the result keeps what the run counted."""
    name = (result.name if hasattr(result, "name") else "entity").lower()
    path = f"{folder}/{name}.{fmt}"
    if not hasattr(result, "measured"):
        _save(result, path, fmt)
        spark = result.sparkSession
        return name, path, spark.read.options(**CSV).format(fmt).load(path).limit(1).count()
    df, obs = result.measured()
    _save(df, path, fmt)
    result.written = dict(obs.get)
    if result.steps is not None and result.steps.nulled is not None:
        result.written |= result.steps.nulled.get
    return name, path, result.written["rows"]


def _put(spark: SparkSession, staged: str, path: str, folder: str) -> None:
    """The staged output takes the former one's place; if that fails, the former one comes back."""
    former = f"{folder}/former-{uuid.uuid4().hex}"
    had = hadoop_exists(spark, path)
    if had:
        _rename(spark, path, former)
    try:
        _rename(spark, staged, path)
    except Exception:
        if had:
            _rename(spark, former, path)
        raise


def write_entity(result, out_dir: str, fmt: str = "csv", keep_empty: bool = False) -> str | None:
    """Write one ``EntityResult`` (or DataFrame); returns the path, or None when
    the result was empty, in which case a former output is removed."""
    df: DataFrame = result.df if hasattr(result, "df") else result
    spark = df.sparkSession
    base = out_dir.rstrip("/")
    folder = f"{base}/_staging-{uuid.uuid4().hex}"
    try:
        name, staged, rows = _stage(result, folder, fmt)
        path = f"{base}/{name}.{fmt}"
        if rows or keep_empty:
            _put(spark, staged, path, folder)
            return path
        if hadoop_exists(spark, path):
            _delete(spark, path)
        return None
    finally:
        _delete(spark, folder)


def write_study(results: dict, out_dir: str, fmt: str = "csv") -> dict[str, str | None]:
    """Write every entity. One that fails is reported, keeps its former output, and the rest go on."""
    out: dict[str, str | None] = {}
    told = {}
    for key, r in results.items():
        if r.error:
            out[key] = None
        else:
            try:
                out[key] = write_entity(r, out_dir, fmt)
            except Exception as e:  # noqa: BLE001 - isolate entities at write time
                r.error = f"write failed: {type(e).__name__}: {e}"
                out[key] = None
        told[key] = {"path": out[key], "rows": r.written.get("rows"), "error": r.error}
    if results:
        spark = next(iter(results.values())).df.sparkSession
        _write_text(spark, f"{out_dir.rstrip('/')}/_manifest.json", json.dumps({"run": uuid.uuid4().hex, "format": fmt, "entities": told}, indent=1))
    return out


def write_table(df: DataFrame, out_dir: str, name: str, fmt: str = "csv") -> str:
    """A table of reports at ``<out_dir>/<name>.<fmt>``, put in place when it is complete."""
    spark, base = df.sparkSession, out_dir.rstrip("/")
    folder, path = f"{base}/_staging-{uuid.uuid4().hex}", f"{base}/{name}.{fmt}"
    try:
        _save(df.coalesce(1), f"{folder}/{name}", fmt)  # a few rows for each entity and rule
        _put(spark, f"{folder}/{name}", path, folder)
    finally:
        _delete(spark, folder)
    return path


def write_reports(results: dict, out_dir: str, fmt: str = "csv", paths: dict | None = None) -> str | None:
    """All entities' validation reports as one table at ``<out_dir>/validation_report.<fmt>``; None if there is no result.
    With the ``paths`` that ``write_study`` returned nothing is mapped again: the counts come from that run and its files."""
    from functools import reduce

    from ..operators import quality
    from ..plans.metrics import written_counts

    if not results:
        return None
    spark = next(iter(results.values())).df.sparkSession
    if paths is None:
        df = reduce(lambda a, b: a.unionByName(b), [r.report() for r in results.values()])
    else:
        rows = []
        for key, r in results.items():
            if not r.error:
                found = written_counts(spark, r, paths[key], fmt)["bad"] if paths.get(key) else [(x.rule, x.field, 0) for x in quality.rules_of(r.df, r.validations)]
                rows += [(r.name, *x) for x in found]
        df = spark.createDataFrame(rows, quality.REPORT_SCHEMA)
    return write_table(df, out_dir, "validation_report", fmt)


def write_metrics(results: dict, paths: dict, out_dir: str, fmt: str = "csv", study: str = "study") -> DataFrame:
    """The study's metrics at ``<out_dir>/study_metrics.<fmt>``, and as text in ``mapping_summary.txt``."""
    from ..plans.metrics import study_metrics, summary_text

    spark = next(iter(results.values())).df.sparkSession
    metrics = study_metrics(spark, results, paths, fmt)
    write_table(metrics, out_dir, "study_metrics", fmt)
    _write_text(spark, f"{out_dir.rstrip('/')}/mapping_summary.txt", summary_text(study, metrics))
    return metrics
