"""Entity and study jobs: spec -> lazy DataFrame plan.

``map_entity`` chains, in this order: participant eligibility and enrichment
(one partial aggregation and one salted join) -> row selection
(filters, per-participant composites, whole-row dedup) -> cleaning steps ->
direct mapping or expansion -> post-processing. Validations are a separate
one-pass aggregation over the result. Nothing is collected; the only eager
steps are the small column-statistics jobs some steps need (``auto``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as TY
from ..functions.predicates import SpecError, compile_condition, df_resolver
from ..operators import clean, expand, post, quality, rows
from ..operators.mapping import Fold, Source, compile_mapping
from ..session import shared_folder, telling_case
from ..spec import EntitySpec, load_spec

ORD = rows.ORD
Hook = Callable[[DataFrame], DataFrame]


@dataclass
class Steps:
    """The parts of an entity's plan that reports need: its source and eligibility, and the output before the last hook."""

    source: DataFrame
    pid: str
    eligible: list | dict | None
    before_hook: DataFrame
    track: dict[str, str]  # column -> field of each conditional-null rule
    after: Hook | None
    nulled: Observation | None = None


@dataclass
class EntityResult:
    name: str
    df: DataFrame
    validations: list
    warnings: list[str] = field(default_factory=list)
    error: str | None = None
    observations: dict[str, Observation] = field(default_factory=dict)
    shared: DataFrame | None = None  # persisted selection shared with other entities
    steps: Steps | None = None
    written: dict = field(default_factory=dict)  # what the run that wrote the entity counted

    def measured(self) -> tuple[DataFrame, Observation]:
        """The output with an Observation, at its end, of everything that adds up: rows, bad rows of each rule that looks at a row by
        itself (``bad_0``, ...), and values before and after each conditional-null rule (``had_0``, ``has_0``, ...)."""
        obs = Observation(f"{self.name}_written_{uuid.uuid4().hex}")
        rules = quality.rules_of(self.df, self.validations)
        counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(r.bad).alias(f"bad_{i}") for i, r in enumerate(rules) if r.bad is not None)]
        if self.steps is None:
            return self.df.observe(obs, *counts), obs
        with telling_case(self.df.sparkSession, self.df.columns):
            out, track = self.steps.before_hook, self.steps.track
            nulled = [x for i, (had, name) in enumerate(track.items()) for x in (F.count_if(had).alias(f"had_{i}"), F.count(F.expr("`" + name.replace("`", "``") + "`")).alias(f"has_{i}"))]
            if self.steps.after is None:
                return out.observe(obs, *counts, *nulled).drop(*track), obs
            if nulled:
                self.steps.nulled = Observation(f"{self.name}_nulled_{uuid.uuid4().hex}")
                out = out.observe(self.steps.nulled, *nulled)
            return self.steps.after(out.drop(*track)).observe(obs, *counts), obs

    def report(self) -> DataFrame:
        """One row per validation rule with the number of offending rows."""
        if self.error:
            return quality.empty_report(self.df.sparkSession)
        return quality.validation_report(self.df, self.validations, self.name)

    def explain(self, mode: str = "formatted") -> str:
        """The entity's physical plan as text (``DataFrame.explain`` modes)."""
        import contextlib
        import io

        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            self.df.explain(mode)
        return buf.getvalue()

    def counts(self) -> dict[str, int | None]:
        """Observed row counts (filled once an action has run on ``df``)."""
        out = {}
        try:  # what an action has observed arrives over the listener bus
            self.df.sparkSession.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        except Exception:  # noqa: BLE001 - no JVM access from this session, or a busy bus
            pass
        for k, o in self.observations.items():
            jo = getattr(o, "_jo", None)  # reading waits for an action, so ask first whether one has ended
            out[k] = o.get.get("rows") if jo is not None and jo.future().isCompleted() else None
        return out


def _needs_order(spec: EntitySpec) -> bool:
    f = spec.filters
    sel = any(isinstance(s, dict) and s.get("select") in ("first", "last") for s in f.get("rows") or [])
    return bool(sel or f.get("enrich"))


def _with_order(df: DataFrame, order_by, warnings: list[str], needed: bool) -> DataFrame:
    if order_by:
        cols = [order_by] if isinstance(order_by, str) else list(order_by)
        if len(cols) == 1:
            # a plain column orders faster than a one-field struct
            return df.withColumn(ORD, F.col(cols[0]))
        return df.withColumn(ORD, F.struct(*[F.col(c) for c in cols]))
    if ORD in df.columns:
        return df
    if needed:
        raise SpecError("first/last need a row order: give order_by, or read the source with read_file")
    return df.withColumn(ORD, F.monotonically_increasing_id())


def _participant_filter(filters: dict):
    p = filters.get("participant")
    if isinstance(p, dict):
        return p.get("filter")
    if isinstance(p, list):
        return p
    return None


def _names_in(cond) -> set[str]:
    """Every text in a condition, the fields that it reads among them."""
    if isinstance(cond, dict):
        return set().union(*map(_names_in, cond.values()))
    if isinstance(cond, (list, tuple)):
        return set().union(*map(_names_in, cond))
    return {cond} if isinstance(cond, str) else set()


def preprocess(df: DataFrame, spec: EntitySpec, warnings: list[str]) -> DataFrame:
    """Eligibility -> enrichment -> row selection -> field filters -> cleaning."""
    f = spec.filters
    pid = spec.pid
    has_pid = pid in df.columns

    pcond = _participant_filter(f)
    eligible = None
    if pcond:
        if has_pid:
            eligible = rows.condition(df, pcond, warnings)
        else:
            warnings.append(f"participant id column {pid!r} missing: eligibility skipped")

    enrich = f.get("enrich") or []
    fills: list[rows.Fill] = []
    for e in [enrich] if isinstance(enrich, dict) else list(enrich):
        if not isinstance(e, dict) or not has_pid:
            continue
        if "merge_baseline_fields" in e:
            fields = [x for x in (e.get("merge_baseline_fields") or []) if x in df.columns]
            base_sel = next((s for s in f.get("rows") or [] if isinstance(s, dict) and s.get("name") == "baseline"),
                            None)
            cond, mode = (base_sel or {}).get("filter") or e.get("source"), "row"
            if not fields or not cond:
                warnings.append("merge_baseline_fields skipped: no fields or no baseline rows defined")
                continue
        else:
            cond, mode = e.get("source") or [], "last" if e.get("select") == "last" else "first"
            if not cond or not (e.get("fields") or []):
                warnings.append(f"enrichment {e.get('name', 'unnamed')!r} missing source or fields: skipped")
                continue
            fields = [x for x in e["fields"] if x in df.columns and x != pid]
            if not fields:
                continue
        if _names_in(cond) & {c for x in fills for c in x.fields}:
            # the condition reads a field that an earlier step fills, so those steps have to come first
            df, eligible, fills = rows.with_participant(df, pid, eligible, fills), None, []
        fills.append(rows.Fill(rows.condition(df, cond, warnings), fields, mode))
    selectors = f.get("rows") or []
    picks = [s["filter"] for s in selectors if isinstance(s, dict) and s.get("filter")]
    wanted = None
    if picks and not _names_in(picks) & {c for x in fills for c in x.fields}:
        wanted = reduce(lambda a, b: a | b, [rows.condition(df, c, []) for c in picks])
    df = rows.with_participant(df, pid, eligible, fills, wanted)

    if selectors:
        df = rows.select_rows(df, pid, selectors, warnings, pid_present=has_pid)

    if f.get("field_filters"):
        df = df.filter(rows.condition(df, f["field_filters"], warnings))

    return clean.apply_steps(df, spec.preprocessing, warnings, ORD)


def _is_plain(spec: EntitySpec, df: DataFrame) -> bool:
    """Whether a selection asks for nothing but eligible participants and whole rows."""
    f = spec.filters
    selectors = f.get("rows") or []
    return (not f.get("enrich") and bool(selectors) and spec.pid in df.columns
            and all(isinstance(s, dict) and s.get("filter") and s.get("select", "all") == "all" for s in selectors))


def select_once(source: DataFrame, specs: list[EntitySpec], order_by=None) -> dict[str, DataFrame]:
    """The selected rows of many entities from one scan of their source: {selection: rows}, for the selections that ask for nothing but
    eligible participants and whole rows. All eligibility conditions are flags of one aggregation by participant and one join, whole
    rows are deduplicated once, and each row is written once for every selection that it belongs to, in a table of the shared folder
    with a folder for each. What an entity does then reads its own folder."""
    df = _with_order(source, order_by, [], False)
    first: dict[str, EntitySpec] = {}
    for spec in specs:
        if _is_plain(spec, df):
            first.setdefault(_selection_key(spec), spec)
    by_pid: dict[str, list] = {}
    for key, spec in first.items():
        by_pid.setdefault(spec.pid, []).append((key, spec))
    out = {}
    for pid, group in by_pid.items():
        if len(group) < 2:
            continue  # nothing to share
        flags, fills, picks = {}, [], []
        for i, (_, spec) in enumerate(group):
            pick = reduce(lambda a, b: a | b, [rows.condition(df, s["filter"], []) for s in spec.filters["rows"]])
            if cond := _participant_filter(spec.filters):
                ok = rows.condition(df, cond, [])
                flags[f"__ok{i}"] = F.when(ok, F.lit(True))
                fills.append(rows.Fill(ok, [f"__ok{i}"], "row"))
                picks.append((pick, F.coalesce(F.col(f"__ok{i}"), F.lit(False))))
            else:
                picks.append((pick, F.lit(True)))
        wanted = reduce(lambda a, b: a | b, [p for p, _ in picks])
        told = rows.with_participant(df.withColumns(flags) if flags else df, pid, None, fills, wanted)
        if not fills:
            told = told.filter(wanted)
        tags = F.array_compact(F.array(*[F.when(p & ok, F.lit(i)) for i, (p, ok) in enumerate(picks)]))
        tagged = rows.dedup_rows(told.withColumn("__tags", tags).filter(F.size("__tags") > 0).drop(*flags))
        path = shared_folder(df.sparkSession, "selected")
        tagged.withColumn("__tag", F.explode("__tags")).drop("__tags").write.partitionBy("__tag").parquet(path)
        for i, (key, _) in enumerate(group):
            schema = T.StructType([*df.schema.fields, T.StructField("__tag", T.IntegerType())])
            out[key] = df.sparkSession.read.schema(schema).parquet(path).where(F.col("__tag") == i).drop("__tag")
    return out


def map_direct(df: DataFrame, spec: EntitySpec) -> DataFrame:
    fams = {x.name: TY.family(x.dataType) for x in df.schema.fields}
    fold = Fold(df, spec.fields)
    src = Source(fams=fams)
    for m in spec.mappings:
        fold.apply(compile_mapping(fold, m, src))
    return fold.output()


def map_entity(source: DataFrame, spec, order_by=None, before: Hook | None = None, after: Hook | None = None,
               null_rules: list | None = None, name: str | None = None, metrics: str = "output",
               selected: DataFrame | None = None) -> EntityResult:
    """Map one entity. ``order_by`` gives row order for first/last (tables have
    no implicit order); ``before``/``after`` are DataFrame -> DataFrame hooks.

    ``metrics="all"`` also counts rows at the input and after row selection.
    Those two ``observe`` points sit inside the plan and stop Catalyst from
    pushing filters through them, so by default only the output is counted.
    ``selected`` passes rows already through eligibility/enrichment/selection/
    cleaning (shared by entities with the same filters, see ``map_study``)."""
    with telling_case(source.sparkSession, [*source.columns, *(selected.columns if selected is not None else [])]):
        return _map_entity(source, spec, order_by, before, after, null_rules, name, metrics, selected)


def _map_entity(source, spec, order_by, before, after, null_rules, name, metrics, selected) -> EntityResult:
    spec = load_spec(spec, name)
    warnings = list(spec.warnings)
    points = ("input", "selected", "output") if metrics == "all" else ("output",)
    obs = {k: Observation(f"{spec.name}_{k}_{uuid.uuid4().hex}") for k in points}
    track: dict[str, str] = {}
    if selected is None:
        df = _with_order(source, order_by, warnings, _needs_order(spec))
        if "input" in obs:
            df = df.observe(obs["input"], F.count(F.lit(1)).alias("rows"))
        if before is not None:
            df = before(df)
        df = preprocess(df, spec, warnings)
    else:
        df = selected
    if "selected" in obs:
        df = df.observe(obs["selected"], F.count(F.lit(1)).alias("rows"))
    if spec.pattern == "expansion":
        out_df, fold = expand.expand(df, spec, warnings)
        out = fold.output(out_df)
    else:
        out = map_direct(df, spec)
    full = post.postprocess(out, spec.post_processing, spec.validations, warnings, null_rules, track)
    steps = Steps(source, spec.pid, _participant_filter(spec.filters), full, track, after)
    out = full.drop(*track)
    if after is not None:
        out = after(out)
    out = out.observe(obs["output"], F.count(F.lit(1)).alias("rows"))
    return EntityResult(spec.name, out, spec.validations, warnings, observations=obs, steps=steps)


def _selection_key(spec: EntitySpec) -> str:
    """Entities with equal filters and cleaning steps select the same rows."""
    import json

    return json.dumps({"f": spec.filters, "p": spec.preprocessing}, sort_keys=True, default=str)


def empty_entity(spark: SparkSession, spec: EntitySpec, error: str) -> EntityResult:
    schema = ", ".join(f"`{c}` string" for c in spec.fields) or "`_` string"
    return EntityResult(spec.name, spark.createDataFrame([], schema), spec.validations, list(spec.warnings),
                        error=error)


def map_study(source, specs: dict, order_by=None, source_dir: str | None = None,
              int_with_nulls: str = "double", share: str = "none", bad_rows: str | None = None) -> dict[str, EntityResult]:
    """Map every entity.

    ``source`` is one DataFrame shared by all entities, or None with
    ``source_dir`` for per-entity files. ``share``:

    * ``"none"`` (default): each entity plans its own scan, so its filters and
      column pruning reach the files; nothing is cached.
    * ``"persist"``: entities with the same filters and cleaning steps share
      one selected-rows DataFrame, persisted (MEMORY_AND_DISK; recomputed from
      lineage if an executor is lost), so eligibility, enrichment and the
      row-selection dedup shuffle run once per group instead of once per entity.
      Call ``release(results)`` after writing.
    * ``"one_scan"``: the source is read once. The selected rows of all entities that select whole rows of eligible participants are
      written to the shared folder in one job (``select_once``), and each entity goes on from there; others plan their own scan.

    ``bad_rows``: what becomes of file rows with more fields than the header (``read_file``). A spec that fails to compile, or a file that
    can't be read, yields an empty result; the rest go on.
    """
    from pyspark import StorageLevel

    from ..sources.multifile import load_entity_sources

    results = {}
    groups: dict[str, DataFrame] = {}
    if share == "one_scan" and source is not None:
        known = []
        for key, raw in specs.items():
            try:
                known.append(load_spec(raw, key))
            except SpecError:
                pass  # told below
        with telling_case(source.sparkSession, source.columns):
            groups = select_once(source, _sound(source, known), order_by)
    for key, raw in specs.items():
        spark = source.sparkSession if source is not None else SparkSession.active()
        try:
            spec = load_spec(raw, key)
        except SpecError as e:
            results[key] = EntityResult(key, spark.createDataFrame([], "`_` string"), [], error=str(e))
            continue
        try:
            if source is None:
                df = load_entity_sources(spark, source_dir, key, spec.source_files, int_with_nulls, bad_rows)
                results[key] = map_entity(df, spec, order_by=order_by, name=key)
                continue
            gkey = _selection_key(spec)
            if share == "one_scan" and gkey in groups:
                warnings = []
                with telling_case(spark, source.columns):
                    df = groups[gkey]
                    if spec.filters.get("field_filters"):
                        df = df.filter(rows.condition(df, spec.filters["field_filters"], warnings))
                    df = clean.apply_steps(df, spec.preprocessing, warnings, ORD)
                results[key] = map_entity(source, spec, order_by=order_by, name=key, selected=df)
                results[key].warnings.extend(warnings)
                continue
            if share != "persist":
                results[key] = map_entity(source, spec, order_by=order_by, name=key)
                continue
            if gkey not in groups:
                warnings: list[str] = []
                with telling_case(spark, source.columns):
                    df = _with_order(source, order_by, warnings, _needs_order(spec))
                    groups[gkey] = preprocess(df, spec, warnings).persist(StorageLevel.MEMORY_AND_DISK)
            results[key] = map_entity(source, spec, order_by=order_by, name=key, selected=groups[gkey])
            results[key].shared = groups[gkey]
        except (SpecError, FileNotFoundError, ValueError) as e:
            results[key] = empty_entity(spark, spec, f"{type(e).__name__}: {e}")
    return results


def _sound(source: DataFrame, specs: list[EntitySpec]) -> list[EntitySpec]:
    """The specs whose conditions can be compiled over the source; the others fail by themselves."""
    out = []
    for spec in specs:
        try:
            for cond in [_participant_filter(spec.filters), *[s.get("filter") for s in spec.filters.get("rows") or [] if isinstance(s, dict)]]:
                if cond:
                    rows.condition(source, cond, [])
            out.append(spec)
        except SpecError:
            pass
    return out


def release(results: dict) -> None:
    """Unpersist the shared selections once the results are written."""
    done = set()
    for r in results.values():
        if r.shared is not None and id(r.shared) not in done:
            r.shared.unpersist()
            done.add(id(r.shared))


def condition_column(df: DataFrame, cond, warnings: list[str] | None = None):
    """Public helper: a spec condition as a boolean Column over ``df``."""
    return compile_condition(cond, df_resolver(df), warnings if warnings is not None else [])
