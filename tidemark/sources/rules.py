"""Categorical whitelist rules (JSON config), loaded fail-closed."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from pathlib import Path

DEFAULT_RULES_PATH = Path(__file__).with_name("logistics_rules.json")

# JSON key per checked lineitem column.
RULE_KEYS = {
    "ship_mode": "allowed_ship_modes",
    "return_flag": "allowed_return_flags",
    "line_status": "allowed_line_statuses",
}


def check_rules(rules: Mapping[str, Sequence[str]]) -> dict[str, list[str]]:
    """``rules`` as lists, if they are whitelists of exactly the checked columns."""
    empty = [c for c in RULE_KEYS if not rules.get(c)]
    extra = sorted(set(rules).difference(RULE_KEYS))
    if empty or extra:
        raise ValueError(f"whitelists are missing or empty for {empty}; not checked columns: {extra}")
    return {column: list(rules[column]) for column in RULE_KEYS}


def _fault(values: object) -> str | None:
    if not isinstance(values, list) or not values:
        return "is not a filled list"
    if not all(isinstance(v, str) and v for v in values):
        return "holds something other than a filled string"
    return "repeats a value" if len(set(values)) < len(values) else None


def load_logistics_rules(path: str | Path | None = None) -> dict[str, list[str]]:
    """Read the whitelists; any fault of one of them fails the load."""
    config = json.loads(Path(path or DEFAULT_RULES_PATH).read_text(encoding="utf-8"))
    faults = {key: fault for key in RULE_KEYS.values() if (fault := _fault(config.get(key)))}
    if faults:
        raise ValueError("whitelist faults: " + "; ".join(f"{key} {fault}" for key, fault in faults.items()))
    return {column: config[key] for column, key in RULE_KEYS.items()}
