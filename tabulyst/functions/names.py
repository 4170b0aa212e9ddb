"""Rules on column names. A schema is driver metadata, so these are plain strings."""

from __future__ import annotations

import re
from collections.abc import Iterable

# The words that decide a column's role and which columns pair up.
TIME_WORDS = ("date", "time", "timestamp", "datetime", "created", "updated", "start", "end")
COORDINATE_TOKENS = frozenset({"latitude", "longitude", "lat", "lon", "lng"})
CODE_TOKENS = frozenset({"tract", "geoid", "zipcode", "zip", "zone", "code", "id"})
AREA_TOKENS = frozenset({"community", "area"})
TOTAL_WORD = "total"
COMPONENT_WORDS = ("fare", "tip", "tips", "extras", "tolls")
SAFE_NAME_LENGTH = 80
SAFE_NAME_FALLBACK = "col"


def name_tokens(name: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", str(name).lower())


def canonical_name(name: str) -> str:
    return "".join(name_tokens(name))


def is_coordinate_name(name: str) -> bool:
    return not COORDINATE_TOKENS.isdisjoint(name_tokens(name))


def mentions_coordinate(name: str) -> bool:
    """The looser test role inference uses: any part of the name, not a token."""
    lowered = str(name).lower()
    return any(word in lowered for word in COORDINATE_TOKENS)


def is_code_like(name: str) -> bool:
    tokens = set(name_tokens(name))
    return bool(tokens & CODE_TOKENS) or AREA_TOKENS <= tokens


def mentions_time(name: str) -> bool:
    lowered = str(name).lower()
    return any(word in lowered for word in TIME_WORDS)


def preferred_column(columns: Iterable[str], wanted: Iterable[str]) -> str | None:
    """First wanted name that some column spells, whatever its case and marks."""
    by_key = {canonical_name(c): c for c in columns}
    return next((by_key[k] for k in map(canonical_name, wanted) if k in by_key), None)


def is_total_and_component(x: str, y: str) -> bool:
    def total(n: str) -> bool:
        return TOTAL_WORD in n.lower()

    def component(n: str) -> bool:
        return any(w in n.lower() for w in COMPONENT_WORDS)

    return any(total(a) and component(b) for a, b in ((x, y), (y, x)))


def is_meaningful_pair(x: str, y: str) -> bool:
    """Whether a correlation of two numeric columns says something."""
    barred = any(is_coordinate_name(n) or is_code_like(n) for n in (x, y))
    return x != y and not barred and not is_total_and_component(x, y)


def safe_name(name: str, limit: int = SAFE_NAME_LENGTH) -> str:
    kept = "_".join(re.findall(r"[a-zA-Z0-9._-]+", str(name)))
    # a name that starts or ends in other marks has no underscore left there
    return (kept.strip("_") or SAFE_NAME_FALLBACK)[:limit]
