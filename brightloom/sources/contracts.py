"""Data contracts from YAML text."""

from __future__ import annotations

from pathlib import Path

try:
    import yaml
except ImportError:  # contracts can also be given as dicts
    yaml = None


def load_contract(path: str) -> dict:
    """``dataset``, ``required_columns`` and ``validation`` of one contract file."""
    if yaml is None:
        raise RuntimeError("reading YAML contracts needs the yaml package")
    spec = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    return {"dataset": spec["dataset"], "required_columns": spec["required_columns"], "validation": spec.get("validation") or {}}
