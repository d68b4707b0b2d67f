"""Expansion (wide -> long): one output record per row x checked config column.

Physical form: each row carries a filtered ``array<struct>`` of the configs
that fire on it and is ``explode``d once (a narrow operator, no shuffle). The
config index ``__cfg`` then selects the per-config literals and enrichments
through ``CASE`` expressions; a second explode (``__vid``) creates the extra
records of ``create_records`` checkbox enrichments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import json

from ..functions import sqltext as Q
from ..functions import types as TY
from ..functions.predicates import _equals
from ..spec import EntitySpec
from .mapping import Fold, Source, _lit, _literal_family, append_tokens, compile_mapping, is_note, set_if_not_null

CFG = "__cfg"
VID = "__vid"


def _c(n: str) -> Column:
    return F.expr("`" + n.replace("`", "``") + "`")


def expand(df: DataFrame, spec: EntitySpec, warnings: list[str]) -> tuple[DataFrame, Fold]:
    fams = {f.name: TY.family(f.dataType) for f in df.schema.fields}
    pid = spec.expansion_pid
    configs = [(i, c) for i, c in enumerate(spec.configs) if c.get("source_field")]
    if not pid or pid not in fams:
        warnings.append("expansion needs participant_id_field; no records created")
        df = df.limit(0)
    else:
        df = df.filter(_c(pid).isNotNull())
    live = [(i, c) for i, c in configs if c["source_field"] in fams]
    skip = spec.pattern_params.get("skip_values", [0])

    xfam = TY.NULL
    for _, c in live:
        xfam = TY.common_family(xfam, fams[c["source_field"]])
    one_family = len({fams[c["source_field"]] for _, c in live}) == 1 and xfam in (TY.INT, TY.FLOAT, TY.BOOL, TY.STRING)
    if len(live) > CONFIG_ROWS and one_family:
        return _expand_by_table(df, spec, fams, live, xfam, skip)
    items = []
    for i, c in live:
        col = c["source_field"]
        ref = Q.ident(col)
        xval = f"CAST({Q.to_family(ref, fams[col], xfam)} AS {Q.sql_type(xfam)})"
        items.append(f"CASE WHEN {Q.keep_value(ref, fams[col], skip)} THEN "
                     f"named_struct('cfg', {i}, 'xval', {xval}, 'xname', {Q.lit(col)}) END")
    if not items:
        df = df.limit(0)
        xfam = TY.STRING
        arr = F.expr("array(named_struct('cfg', -1, 'xval', CAST(NULL AS STRING), 'xname', ''))")
    else:
        # one SQL expression for all configs: planning stays fast with hundreds of them
        arr = F.expr(f"filter(array({', '.join(items)}), x -> x IS NOT NULL)")
    df = df.select("*", F.explode(arr).alias("__x")).select(
        "*", F.col("__x.cfg").alias(CFG), F.col("__x.xval").alias("__xval"), F.col("__x.xname").alias("__xname")
    ).drop("__x")

    fold = Fold(df, spec.fields)
    src = Source(fams=fams, default_col=(F.col("__xval"), xfam), default_name=F.col("__xname"))
    # 1. mappings, with the expansion column as default source
    for m in spec.mappings:
        fold.apply(compile_mapping(fold, m, src))

    # 2. code / term / source text from the config, into existing fields only
    prefix = spec.code_term_prefix
    keys = {"code": f"{prefix}_code", "term": f"{prefix}_term", "source_label": f"{prefix}_source_text"}
    per_t: dict[str, list] = {}
    for i, c in live:
        for k, t in keys.items():
            if k in c and fold.exists(t):
                v = c[k]
                if TY.value_family(v) == TY.OTHER:
                    v = str(v)
                per_t.setdefault(t, []).append((i, v))
    updates = {}
    for t, entries in per_t.items():
        prev, pfam = fold.prev_sql(t)
        fam = pfam
        for _, v in entries:
            fam = TY.common_family(fam, TY.value_family(v))
        branches = [(i, Q.to_family(Q.lit(v), TY.value_family(v), fam)) for i, v in entries]
        updates[t] = (F.expr(Q.case_on(CFG, branches, Q.to_family(prev, pfam, fam))), fam)
    fold.apply(updates)

    _create_records(fold, src, live)

    # 4. other enrichments, per config. Configs sharing an identical enrichment
    #    (typical of range templates) are compiled once, guarded by
    #    ``__cfg IN (...)``, with the config's own column as default source.
    depth = max([len(c.get("enrichments") or []) for _, c in live] or [0])
    for j in range(depth):
        fold.materialize()
        branches: dict[str, list] = {}
        for (_, gfam), members in _enrichment_groups(live, j, fams).items():
            e = members[0][2]
            if len(members) == 1:
                csrc = Source(fams=fams, default_field=members[0][1])
                guard = F.col(CFG) == F.lit(members[0][0])
            else:
                dflt = F.expr(Q.case_on(CFG, [(i, Q.ident(col)) for i, col, _ in members], "NULL"))
                csrc = Source(fams=fams, default_col=(dflt, gfam), default_name=F.col("__xname"))
                guard = F.expr(f"{CFG} IN ({', '.join(str(i) for i, _, _ in members)})")
            for t, val in compile_mapping(fold, e, csrc).items():
                branches.setdefault(t, []).append((guard, val))
        _write_branches(fold, branches)
    return fold.df, fold


def _is_create(e) -> bool:
    return isinstance(e, dict) and e.get("source_type") == "checkbox" and bool(e.get("create_records"))


def _enrichment_groups(live: list, j: int, fams: dict) -> dict[tuple, list]:
    """The j-th enrichments of the configs: (its text, family of the config's column) -> [(config, column, enrichment)]."""
    groups: dict[tuple, list] = {}
    for i, c in live:
        ens = c.get("enrichments") or []
        if j < len(ens) and isinstance(ens[j], dict) and not _is_create(ens[j]):
            key = (json.dumps(ens[j], sort_keys=True, default=str), fams[c["source_field"]])
            groups.setdefault(key, []).append((i, c["source_field"], ens[j]))
    return groups


def _write_branches(fold: Fold, per_target: dict[str, list]) -> None:
    """{target: [(guard, (value, family))]}: the value of the guard that holds, else the previous one."""
    updates = {}
    for t, branches in per_target.items():
        prev = fold.prev(t)
        fam = prev[1]
        for _, (_, f) in branches:
            fam = TY.common_family(fam, f)
        expr = None
        for guard, (c, f) in branches:
            v = TY.to_family(c, f, fam)
            expr = F.when(guard, v) if expr is None else expr.when(guard, v)
        updates[t] = (expr.otherwise(TY.to_family(prev[0], prev[1], fam)), fam)
    fold.apply(updates)


#: With more configs they are a table, joined to the long rows by their place.
CONFIG_ROWS = 100


def _constant(e: dict) -> bool:
    """An enrichment that writes one literal into one field."""
    v = e.get("default_value")
    return (isinstance(e.get("target_field"), str) and e.get("source_field") is None and isinstance(v, (str, int, float)) and v == v
            and set(e) <= {"target_field", "default_value", "source_field", "name", "description"})


def _expand_by_table(df: DataFrame, spec: EntitySpec, fams: dict, live: list, xfam: str, skip) -> tuple[DataFrame, Fold]:
    """Expansion over many configs. The row's config columns become one array, whose elements are numbered as they come out; what a
    config says (column name, code, term, label, literals, which of the distinct enrichments it has) is a row of a table that the long
    rows meet by that number. So expressions grow with what differs in kind between configs, and not with their number."""
    from .mapping import spec_table

    sql_type = Q.sql_type(xfam)
    values = ", ".join(f"CAST({Q.ident(c['source_field'])} AS {sql_type})" for _, c in live)
    table: dict[str, tuple[str, list]] = {
        "__p": (TY.INT, list(range(len(live)))), CFG: (TY.INT, [i for i, _ in live]), "__xname": (TY.STRING, [c["source_field"] for _, c in live])}
    prefix = spec.code_term_prefix
    literals: dict[str, str] = {}  # target -> column of the table
    kinds = {}
    for k, t in {"code": f"{prefix}_code", "term": f"{prefix}_term", "source_label": f"{prefix}_source_text"}.items():
        given = [k in c for _, c in live]
        if any(given):
            literals[t] = f"__l_{k}"
            kinds[t] = _add_literals(table, literals[t], given, [c.get(k) for _, c in live])
    depth = max(len(c.get("enrichments") or []) for _, c in live)
    constants, groups = [], []
    for j in range(depth):
        ens = [(c.get("enrichments") or [])[j] if j < len(c.get("enrichments") or []) else None for _, c in live]
        own = [e if isinstance(e, dict) and _constant(e) else None for e in ens]
        columns = {}
        for n, t in enumerate(dict.fromkeys(e["target_field"] for e in own if e)):
            name = f"__e{j}_{n}"
            given = [e is not None and e["target_field"] == t for e in own]
            columns[t] = (name, _add_literals(table, name, given, [e["default_value"] if g else None for e, g in zip(own, given)]))
        constants.append(columns)
        found = _enrichment_groups([(i, c) for (i, c), e in zip(live, own) if e is None], j, fams)
        number = {i: g for g, members in enumerate(found.values()) for i, _, _ in members}
        table[f"__g{j}"] = (TY.INT, [number.get(i, -1) for i, _ in live])
        groups.append([members[0][2] for members in found.values()])

    # the array is a column of its own, so that the step that numbers its elements takes in few columns: with many, Spark makes no code for it
    df = df.select("*", F.expr(f"array({values})").alias("__all")).select("*", F.expr("posexplode(__all) AS (__q, __xval)")).drop("__all")
    df = df.where(F.expr(Q.keep_value("`__xval`", xfam, skip)))
    df = df.join(spec_table(df.sparkSession, table), F.col("__q") == F.col("__p")).drop("__q", "__p")
    fold = Fold(df, spec.fields)
    src = Source(fams=fams, default_col=(F.col("__xval"), xfam), default_name=F.col("__xname"))
    for m in spec.mappings:
        fold.apply(compile_mapping(fold, m, src))
    _write_branches(fold, {t: [(F.col(f"{c}_has"), (F.col(c), kinds[t]))] for t, c in literals.items() if fold.exists(t)})
    _create_records(fold, src, live)
    for j in range(depth):
        fold.materialize()
        branches: dict[str, list] = {t: [(F.col(f"{c}_has"), (F.col(c), fam))] for t, (c, fam) in constants[j].items()}
        for g, e in enumerate(groups[j]):
            for t, val in compile_mapping(fold, e, src).items():
                branches.setdefault(t, []).append((F.col(f"__g{j}") == g, val))
        _write_branches(fold, branches)
    return fold.df, fold


def _add_literals(table: dict, name: str, given: list[bool], values: list) -> str:
    """A typed column of literals and one that tells which are given; returns its family."""
    values = [str(v) if TY.value_family(v) == TY.OTHER else v for v in values]
    fam = TY.NULL
    for v, g in zip(values, given):
        if g:
            fam = TY.common_family(fam, TY.value_family(v))
    kind = TY.STRING if fam == TY.NULL else fam
    table[name] = (kind, [(_as_family(v, fam) if g and v is not None else None) for v, g in zip(values, given)])
    table[f"{name}_has"] = (TY.BOOL, given)
    return fam


def _as_family(v, fam: str):
    return str(v) if fam == TY.STRING else float(v) if fam == TY.FLOAT else v


def _create_records(fold: Fold, src: Source, live: list) -> None:
    """3. create_records checkbox enrichments -> extra records."""
    variants = []  # (cfg, enrichment, target, value)
    arrays: dict[int, Column] = {}
    for i, c in live:
        parts = []
        for e in c.get("enrichments") or []:
            if not _is_create(e):
                continue
            conds = []
            for col_name, mv in (e.get("value_mappings") or {}).items():
                s = src.get(col_name)
                if s is None:
                    continue
                vid = len(variants)
                variants.append((i, e.get("target_field"), mv))
                conds.append(F.when(_equals(s[0], s[1], 1), F.lit(vid)))
            checked = F.filter(F.array(*conds), lambda x: x.isNotNull()) if conds else F.array().cast("array<int>")
            parts.append(F.when(F.size(checked) == 0, F.array(F.lit(-1))).otherwise(checked))
        if parts:
            arrays[i] = F.concat(*parts) if len(parts) > 1 else parts[0]
    if arrays:
        fold.materialize()
        expr = None
        for i, a in arrays.items():
            expr = F.when(F.col(CFG) == i, a) if expr is None else expr.when(F.col(CFG) == i, a)
        vids = expr.otherwise(F.array(F.lit(-1)))
        fold.df = fold.df.withColumn(VID, F.explode(vids))
        per_t = {}
        for vid, (i, target, mv) in enumerate(variants):
            tlist = target if isinstance(target, list) else [target]
            for j, t in enumerate(tlist):
                if isinstance(target, list):
                    v = (mv[j] if j < len(mv) else None) if isinstance(mv, list) else (mv if j == 0 else None)
                else:
                    v = str(mv) if isinstance(mv, list) else mv
                if not v or not t:
                    continue
                fold.prev(t)
                per_t.setdefault(t, []).append((vid, v))
        updates = {}
        for t, entries in per_t.items():
            prev = fold.prev_multi(t)
            if is_note(t):
                updates[t] = append_tokens(prev, [(F.col(VID) == vid, F.lit(str(v))) for vid, v in entries])
            else:
                fam = _literal_family([v for _, v in entries])
                val = None
                for vid, v in entries:
                    cond = F.col(VID) == vid
                    val = F.when(cond, _lit(v, fam)) if val is None else val.when(cond, _lit(v, fam))
                updates[t] = set_if_not_null(prev, (val, fam))
        fold.apply(updates)
