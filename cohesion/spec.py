"""Entity specs: plain dicts (e.g. from ``yaml.safe_load``) checked and normalised.

A spec has the sections ``entity``, ``filters``, ``preprocessing``,
``mappings``, ``configs``, ``post_processing`` and ``validations``. This module
only reads and checks the dict on the driver; it never touches data.
"""

from __future__ import annotations

import copy
import re
from dataclasses import dataclass, field
from pathlib import Path

from .functions.predicates import SpecError

DEFAULT_PID = "participant_id"
# Groups of target fields come in this order; other groups follow in spec order.
FIELD_GROUP_ORDER = ("base", "extension")
JOIN_TYPES = {"left": "left", "right": "right", "inner": "inner", "outer": "full_outer"}
KNOWN_SECTIONS = {"entity", "filters", "preprocessing", "mappings", "configs", "post_processing", "validations"}


@dataclass
class EntitySpec:
    name: str
    fields: list[str]
    pattern: str
    pattern_params: dict
    code_term_prefix: str
    filters: dict
    preprocessing: list
    mappings: list
    configs: list
    post_processing: list
    validations: list
    source_files: dict | None
    raw: dict
    warnings: list[str] = field(default_factory=list)

    @property
    def pid(self) -> str:
        return self.filters.get("participant_id_field") or DEFAULT_PID

    @property
    def expansion_pid(self) -> str | None:
        return self.pattern_params.get("participant_id_field") or self.filters.get("participant_id_field")


def _target_fields(entity: dict) -> list[str]:
    groups = entity.get("fields") or {}
    if not isinstance(groups, dict):
        raise SpecError("entity.fields must be a mapping of field groups")
    order = [g for g in FIELD_GROUP_ORDER if g in groups] + [g for g in groups if g not in FIELD_GROUP_ORDER]
    out: list[str] = []
    for g in order:
        lst = groups.get(g)
        if isinstance(lst, list):
            for f in lst:
                if f not in out:
                    out.append(str(f))
    return out


_FMT = re.compile(r"\{n(?::([^}]*))?\}")


def _fill_template(obj, n: int):
    if isinstance(obj, str):
        return _FMT.sub(lambda m: format(n, m.group(1) or ""), obj)
    if isinstance(obj, list):
        return [_fill_template(x, n) for x in obj]
    if isinstance(obj, dict):
        # keys are left as they are; only values are templated
        return {k: _fill_template(v, n) for k, v in obj.items()}
    return obj


def expand_configs(configs: list, warnings: list[str]) -> list[dict]:
    """Range templates ``{type: range, start, end, template}`` -> one config per n."""
    out = []
    for cfg in configs or []:
        if isinstance(cfg, dict) and (cfg.get("type") == "range" or {"start", "end", "template"} <= cfg.keys()):
            start, end, tpl = cfg.get("start"), cfg.get("end"), cfg.get("template")
            if start is None or end is None or not isinstance(tpl, dict):
                warnings.append("range config skipped: needs start, end and template")
                continue
            for n in range(int(start), int(end) + 1):
                out.append(_fill_template(copy.deepcopy(tpl), n))
        elif isinstance(cfg, dict):
            out.append(cfg)
    return out


def _check_source_files(entity: dict) -> dict | None:
    if "source_file" in entity and entity["source_file"]:
        return {"primary": entity["source_file"], "secondary": [], "multi_line": entity.get("multi_line")}
    sf = entity.get("source_files")
    if sf is None:
        return None
    if not isinstance(sf, dict):
        raise SpecError("entity.source_files must be a mapping")
    if not sf.get("primary"):
        raise SpecError("entity.source_files.primary is required")
    secs = []
    for s in sf.get("secondary") or []:
        if isinstance(s, str):
            secs.append({"file": s, "join_on": [DEFAULT_PID], "join_type": "left", "columns": None})
        elif isinstance(s, dict):
            f = s.get("file")
            if not f or not (isinstance(f, str) or (isinstance(f, list) and all(isinstance(x, str) for x in f))):
                raise SpecError("secondary.file must be a string or a list of strings")
            jt = s.get("join_type", "left")
            if jt not in JOIN_TYPES:
                raise SpecError(f"join_type must be one of {sorted(JOIN_TYPES)}, got {jt!r}")
            on = s.get("join_on", DEFAULT_PID)
            secs.append({"file": f, "join_on": on if isinstance(on, list) else [on], "join_type": jt,
                         "columns": s.get("columns"), "nulls_match": bool(s.get("nulls_match", True))})
        else:
            raise SpecError("secondary element must be a string or a mapping")
    return {"primary": sf["primary"], "secondary": secs, "multi_line": sf.get("multi_line")}


def _load_yaml(text: str, warnings: list[str]):
    """``yaml.safe_load`` (the last of duplicate keys wins) with a warning for
    each duplicate top-level key."""
    import yaml

    dups: list[str] = []

    class _Loader(yaml.SafeLoader):
        pass

    def mapping(loader, node, deep=False):
        keys = [loader.construct_object(k, deep=deep) for k, _ in node.value]
        if node is getattr(loader, "_root", None):
            seen = set()
            for k in keys:
                if k in seen:
                    dups.append(str(k))
                seen.add(k)
        return yaml.SafeLoader.construct_mapping(loader, node, deep)

    def root(loader):
        node = loader.get_single_node()
        if node is None:
            return None
        loader._root = node
        return loader.construct_document(node)

    _Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    _Loader.get_single_data = root
    loader = _Loader(text)
    try:
        data = loader.get_single_data()
    finally:
        loader.dispose()
    warnings += [f"duplicate spec section {k!r}: the last one is used" for k in dups]
    return data


def load_spec(spec: dict | str | Path, name: str | None = None) -> EntitySpec:
    """Normalise one entity spec (dict, or path to a YAML file)."""
    if isinstance(spec, EntitySpec):
        return spec
    warnings: list[str] = []
    if isinstance(spec, (str, Path)):
        p = Path(spec)
        name = name or p.stem
        spec = _load_yaml(p.read_text(encoding="utf-8"), warnings)
    if not isinstance(spec, dict):
        raise SpecError("a spec must be a mapping")
    for k in spec:
        if k not in KNOWN_SECTIONS:
            warnings.append(f"unknown spec section ignored: {k!r}")
    entity = spec.get("entity") or {}
    ename = entity.get("name") or name or "entity"
    pattern = entity.get("pattern", "direct") or "direct"
    return EntitySpec(
        name=str(ename),
        fields=_target_fields(entity),
        pattern="expansion" if pattern == "expansion" else "direct",
        pattern_params=dict(entity.get("params") or {}),
        code_term_prefix=entity.get("code_term_prefix") or str(ename).lower(),
        filters=dict(spec.get("filters") or {}),
        preprocessing=list(spec.get("preprocessing") or []),
        mappings=[m for m in (spec.get("mappings") or []) if isinstance(m, dict)],
        configs=expand_configs(spec.get("configs") or [], warnings),
        post_processing=list(spec.get("post_processing") or []),
        validations=list(spec.get("validations") or []),
        source_files=_check_source_files(entity),
        raw=spec,
        warnings=warnings,
    )


def load_study(directory: str | Path) -> dict[str, EntitySpec]:
    """All ``*.yaml`` specs of a directory, by file name order; key = file stem."""
    d = Path(directory)
    return {p.stem: load_spec(p, p.stem) for p in sorted(d.glob("*.yaml"))}
