"""Entity lists: person and role fragments out of investor lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsieve.functions.text import strip

# The roles of either variant.
ROLES = ["co-founder", "cofounder", "ceo", "cto", "cfo", "coo", "founder", "partner", "managing director", "president", "vp ", "vice president", "head of", "director of"]
SPEC_ROLES = ["co-founder", "ceo", "cto", "cfo", "founder", "partner"]


def _any(test, roles: list[str]) -> Column:
    hit = F.lit(False)
    for r in roles:
        hit = hit | test(r)
    return hit


def clean_investors(items: Column, mode: str = "implemented") -> Column:
    """Names without role fragments, each once, in order. implemented: the first spelling of a name stays, whatever its
    case. spec: fewer roles, any final `)` drops the item, empty items stay, and spellings are told apart."""
    trimmed = F.transform(items, strip)
    if mode == "spec":
        low = F.lower
        drop = lambda x: low(x).startswith("(") | low(x).endswith(")") | _any(lambda r: low(x).contains(f"({r}") | low(x).contains(f"{r})"), SPEC_ROLES) | (x.contains("(") & _any(lambda r: low(x).contains(r), SPEC_ROLES))
        return F.array_distinct(F.filter(trimmed, lambda x: ~drop(x)))
    keep = F.filter(
        trimmed,
        lambda x: (x != "") & ~x.startswith("(") & ~(x.endswith(")") & ~x.contains("(")) & ~(x.contains("(") & _any(lambda r: F.lower(x).contains(r), ROLES)) & ~_any(lambda r: (F.lower(x) == r) | F.lower(x).startswith(r + " "), ROLES),
    )
    return F.transform(F.array(keep), lambda k: F.filter(k, lambda x, i: F.array_position(F.transform(k, F.lower), F.lower(x)) == i + 1))[0]
