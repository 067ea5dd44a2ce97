"""Folders of a dataset: one per stage below a tumour type, partitioned by sample inside."""

from __future__ import annotations

from dataclasses import fields, replace
from pathlib import Path

from ..functions.names import as_bool, none_like
from ..schema import Config

#: Stage folders.
STAGES = ("patches", "segment", "segment_vis", "radiomics", "radiomics_statistics", "st", "genes", "patches_vis", "metadata")


def stage(root: str, oncotree: str, name: str) -> str:
    """The table of a stage; any URI of a Hadoop file system."""
    if name not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}, is {name!r}")
    return f"{root.rstrip('/')}/{oncotree}/{name}"


def sample(root: str, oncotree: str, name: str, sample_id: str) -> str:
    """The partition of a sample in a stage's table."""
    return f"{stage(root, oncotree, name)}/sample_id={sample_id}"


def of_sample(root: str, oncotree: str, sample_id: str) -> dict[str, str]:
    """All partitions of a sample by stage."""
    return {name: sample(root, oncotree, name, sample_id) for name in STAGES}


def config_file(path: str) -> dict:
    """Settings from a YAML file: an empty file is no settings, anything but a mapping is an error."""
    import yaml

    found = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    if found is None:
        return {}
    if not isinstance(found, dict):
        raise ValueError(f"{path} does not hold a mapping")
    return found


def layered(*mappings: dict) -> dict:
    """Mappings as one: a later value stands above an earlier one unless it is None, and sections meet key by key, however deep they are."""
    out: dict = {}
    for mapping in mappings:
        for key, value in mapping.items():
            below = out.get(key)
            if isinstance(value, dict):
                out[key] = layered(below if isinstance(below, dict) else {}, value)
            elif value is not None or key not in out:
                out[key] = value
    return out


def without_sections(mapping: dict) -> dict:
    """The settings of all sections beside each other; one that two sections have is an error."""
    out: dict = {}
    for key, value in mapping.items():
        own = without_sections(value) if isinstance(value, dict) else {key: value}
        if twice := sorted(set(own) & set(out)):
            raise KeyError(f"settings that stand twice: {twice}")
        out |= own
    return out


def settings(found: dict, **over) -> Config:
    """Settings from a mapping, with what is given besides in its place; what means nothing leaves the default.

    Truth values may be text, and one value stands for a list of one. Unknown names are an error.
    """
    known = {f.name: f.default for f in fields(Config)}
    given = {k: v for k, v in {**found, **{k: v for k, v in over.items() if v is not None}}.items() if none_like(v) is not None}
    if unknown := sorted(set(given) - set(known)):
        raise KeyError(f"no such settings: {unknown}")
    lists = ("oncotrees", "sample_ids", "filters", "representative_stats", "genes_k", "genes_criteria")
    for k, v in given.items():
        if isinstance(known[k], bool):
            given[k] = as_bool(v)
        elif k in lists:
            given[k] = tuple(v) if isinstance(v, (list, tuple)) else (v,)
        elif known[k] is not None:
            given[k] = type(known[k])(v)
    return replace(Config(), **given)
