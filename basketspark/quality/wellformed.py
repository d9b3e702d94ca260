"""Whether a contract can be used at all, before any data is read."""

from __future__ import annotations

from collections import Counter

from .errors import InvalidContractError


def problems(contract) -> list[str]:
    """All that is wrong with a contract's outline; thresholds, constraints and rules are tested where they are used."""
    if not isinstance(contract, dict) or not contract:
        return ["a contract is a mapping with a schema"]
    columns = contract.get("schema")
    if not isinstance(columns, list) or not columns:
        return ["schema is a list of columns, one at least"]
    out, seen = [], Counter()
    for place, c in enumerate(columns):
        if not isinstance(c, dict):
            out.append(f"column {place} is not a mapping")
            continue
        name = c.get("name")
        named = isinstance(name, str) and bool(name.strip())
        seen[name if named else ""] += named
        who = name if named else f"column {place}"
        parts = {"name": named, "type": isinstance(c.get("type"), str), "nullable": isinstance(c.get("nullable"), bool), "constraints": isinstance(c.get("constraints", {}), dict)}
        out += [f"{who}: {part} {'is not usable' if part in c else 'is missing'}" for part, fits in parts.items() if not fits]
    return out + [f"{name}: listed {n} times" for name, n in seen.items() if n > 1]


def check_contract(contract) -> None:
    if found := problems(contract):
        raise InvalidContractError("; ".join(found))
