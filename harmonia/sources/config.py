"""Survey schema configuration (JSON files keyed by ``survey``).

A schema declares columns (type / required / min / max / allowed values),
the raw -> standard column mapping, sampling-event and combine keys,
metadata columns, comment-column defaults, subset columns per preset and
per-preset ``steps`` (``applies`` plus step options).  Steps a schema does
not mention are filled from :data:`DEFAULT_STEPS` for every preset.
"""

from __future__ import annotations

import copy
import glob
import json
import os

# The default step switches (and options) of the formatter.
DEFAULT_STEPS = {
    "duplicate_checks": {"applies": True},
    "convert_timezone": {"applies": True},
    "missing_datetime_checks": {"applies": True},
    "extreme_time_checks": {"applies": True},
    "station_checks": {"applies": True},
    "na_checks": {"applies": True},
    "add_metadata": {"applies": True},
    "add_comment_cols": {"applies": True},
    "calc_densities": {"applies": True},
    "correct_taxon_typos": {"applies": True},
    "standardize_unknowns": {"applies": True, "std_sp": True, "std_suffix": True},
    "update_synonyms": {"applies": True},
    "higher_lvl_taxa": {"applies": True, "std_type": "unified"},
    "combine_taxa": {"applies": True},
    "subset_cols": {"applies": True},
}


def complete_schema(schema: dict, presets: list[str] | None = None) -> dict:
    """Fill steps missing from a schema with the defaults, per preset."""
    s = copy.deepcopy(schema)
    presets = presets or s.get("presets") or ["standard"]
    steps = s.setdefault("steps", {})
    for step, default in DEFAULT_STEPS.items():
        if step not in steps:
            steps[step] = {p: copy.deepcopy(default) for p in presets}
    return s


def load_schemas(folder: str, presets: list[str] | None = None) -> dict[str, dict]:
    """Every ``*.json`` in ``folder`` keyed by its ``survey`` field."""
    out = {}
    for path in sorted(glob.glob(os.path.join(folder, "*.json"))):
        with open(path, encoding="utf-8") as f:
            sch = json.load(f)
        out[sch["survey"]] = complete_schema(sch, presets)
    return out


def step(schema: dict, name: str, preset: str) -> dict:
    """The options of one step for one preset (``applies`` False if absent)."""
    return (schema.get("steps", {}).get(name, {}) or {}).get(preset, {"applies": False})


def applies(schema: dict, name: str, preset: str) -> bool:
    return bool(step(schema, name, preset).get("applies", False))
