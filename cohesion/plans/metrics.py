"""Metrics of a study, without running an entity a second time.

What adds up (rows, bad rows, values before and after a conditional-null rule) is counted by the run that writes an entity
(``EntityResult.measured``). What doesn't (participants, repeated values) is counted from the written files, of which only
the columns concerned are read, in one pass for all of them. Participants before and after eligibility are one aggregation by id
over each source, for all entities that read it.

One table: entity ('' for the study), metric, detail, value.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import compile_condition, df_resolver
from ..operators import quality
from ..session import telling_case

SCHEMA = "entity string, metric string, detail string, value double"
OUT_PID = "submitter_participant_id"


def source_counts(results: dict) -> dict[str, dict[str, int]]:
    """Per entity: input rows, participants, eligible participants. One job for each source."""
    by_source: dict[int, list] = {}
    for name, r in results.items():
        if r.steps is not None:
            by_source.setdefault(id(r.steps.source), []).append((name, r.steps))
    out: dict[str, dict[str, int]] = {}
    for group in by_source.values():
        df = group[0][1].source
        with telling_case(df.sparkSession, df.columns):
            for pid in sorted({s.pid for _, s in group}):
                own = [(n, s) for n, s in group if s.pid == pid]
                if pid not in df.columns:
                    rows = df.count()
                    out |= {n: {"input_rows": rows} for n, _ in own}
                    continue
                key = F.expr("`" + pid.replace("`", "``") + "`")
                conds = [compile_condition(s.eligible, df_resolver(df), []) if s.eligible else F.lit(True) for _, s in own]
                per = df.groupBy(key.alias("__p")).agg(F.count(F.lit(1)).alias("__n"), *(F.max(F.coalesce(c, F.lit(False))).alias(f"__ok{i}") for i, c in enumerate(conds)))
                known = F.col("__p").isNotNull()
                got = per.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count_if(known).alias("ids"), *(F.count_if(known & F.col(f"__ok{i}")).alias(f"ok{i}") for i in range(len(own)))).first()
                for i, (n, s) in enumerate(own):
                    out[n] = {"input_rows": got["rows"]} | ({"participants_before": got["ids"], "participants_after": got[f"ok{i}"]} if s.eligible else {})
    return out


def written_counts(spark: SparkSession, result, path: str, fmt: str) -> dict:
    """bad rows of each rule in order, and the participants of an entity that has been written to ``path``."""
    rules = quality.rules_of(result.df, result.validations)
    wanted = [(i, r.field) for i, r in enumerate(rules) if r.value is not None]
    if OUT_PID in result.df.columns:
        wanted.append((-1, OUT_PID))
    bad = {i: result.written.get(f"bad_{i}") or 0 for i in range(len(rules))}
    out: dict = {}
    if wanted:
        df = read_written(spark, path, fmt, result.df)
        with telling_case(spark, df.columns):
            value = lambda c: F.expr("`" + c.replace("`", "``") + "`")
            got = {r["i"]: r for r in quality.counts_by_rule(df, [quality.Rule("unique", f, value=value(f)) for _, f in wanted]).collect()}
        for k, (i, _) in enumerate(wanted):
            found = got.get(k)
            if i < 0:
                out["participants"] = found["known"] if found else 0
            else:
                bad[i] = found["rows"] - found["values"] if found else 0
    return out | {"bad": [(r.rule, r.field, bad[i]) for i, r in enumerate(rules)]}


def read_written(spark: SparkSession, path: str, fmt: str, like: DataFrame) -> DataFrame:
    reader = spark.read.schema(like.schema)
    return reader.parquet(path) if fmt == "parquet" else reader.option("header", True).option("escape", '"').csv(path)


def study_metrics(spark: SparkSession, results: dict, paths: dict, fmt: str = "csv") -> DataFrame:
    """The metrics of results that ``write_study`` has written to ``paths``."""
    sources = source_counts(results)
    rows: list[tuple[str, str, str, float]] = []
    totals = {"output_rows": 0, "rules_failed": 0, "entities": 0, "entities_failed": 0}

    def add(entity: str, metric: str, detail: str, value) -> None:
        rows.append((entity, metric, detail, float(value)))

    for name, r in results.items():
        source = sources.get(name, {})
        n = r.written.get("rows") or 0
        totals["entities"] += 1
        totals["output_rows"] += n
        if "input_rows" in source:
            add(name, "input_rows", "", source["input_rows"])
        add(name, "output_rows", "", n)
        add(name, "output_columns", "", 0 if r.error else len(r.df.columns))
        add(name, "failed", r.error or "", 1 if r.error else 0)
        totals["entities_failed"] += 1 if r.error else 0
        for warning in dict.fromkeys(r.warnings):
            add(name, "warning", warning, r.warnings.count(warning))
        if "participants_before" in source:
            before, after = source["participants_before"], source["participants_after"]
            add(name, "participants_before", "", before)
            add(name, "participants_after", "", after)
            add(name, "eligibility_retention_pct", "", round(100 * after / before, 4) if before else 0)
        if r.error:
            continue
        found = written_counts(spark, r, paths[name], fmt) if paths.get(name) else {"bad": [(x.rule, x.field, 0) for x in quality.rules_of(r.df, r.validations)]} | (
            {"participants": 0} if OUT_PID in r.df.columns else {})
        if "participants" in found:
            add(name, "participants", "", found["participants"])
        for rule, fld, bad in found["bad"]:
            add(name, "bad_rows", f"{rule}: {fld}", bad)
        failed = sum(1 for *_, bad in found["bad"] if bad)
        add(name, "rules_failed", "", failed)
        totals["rules_failed"] += failed
        for i, fld in enumerate(r.steps.track.values() if r.steps else ()):
            add(name, "values_before_rule", fld, r.written.get(f"had_{i}") or 0)
            add(name, "values_after_rule", fld, r.written.get(f"has_{i}") or 0)
    per_source = {id(r.steps.source): sources[n]["input_rows"] for n, r in results.items() if r.steps is not None and n in sources}
    inputs = sum(per_source.values())
    add("", "input_rows", "", inputs)
    for metric, value in totals.items():
        add("", metric, "", value)
    if inputs and "participant" in results:
        add("", "participant_retention_pct", "", round(100 * (results["participant"].written.get("rows") or 0) / inputs, 4))
    return spark.createDataFrame(rows, SCHEMA)


def summary_text(study: str, metrics: DataFrame) -> str:
    """A study's metrics as text, entity by entity."""
    rows = metrics.collect()  # a few for each entity and rule
    number = lambda v: str(int(v)) if v == int(v) else f"{v:.1f}"
    line = lambda r: f"  {r['metric'].replace('_', ' ')}{' (' + r['detail'] + ')' if r['detail'] else ''}: {number(r['value'])}"
    names = list(dict.fromkeys(r["entity"] for r in rows))
    return os.linesep.join([f"study {study}", *(line(r) for r in rows if not r["entity"]),
                            *(x for n in names if n for x in ("", f"entity {n}", *(line(r) for r in rows if r["entity"] == n)))]) + os.linesep
