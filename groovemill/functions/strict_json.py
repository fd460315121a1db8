"""JSON objects that must be exactly what is expected."""

from __future__ import annotations

import json
from collections.abc import Iterable

from ..errors import InvalidArgument

MAX_CHARS = 1_000_000
MAX_DEPTH = 32


def _unique(pairs: list[tuple[str, object]]) -> dict[str, object]:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise InvalidArgument("a key occurs twice")
    return out


def _depth(value: object) -> int:
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return 1 + max(map(_depth, inner), default=0) if isinstance(value, (dict, list)) else 0


def strict_object(text: str, fields: Iterable[str], what: str = "object") -> dict[str, object]:
    """The object in text; refused if it is long or deep, repeats a key, isn't an object or has other fields than given."""
    if len(text) > MAX_CHARS:
        raise InvalidArgument(f"{what} is longer than {MAX_CHARS} characters")

    def no_constant(name: str) -> object:
        raise InvalidArgument(f"{what} has {name}")

    try:
        found = json.loads(text, object_pairs_hook=_unique, parse_constant=no_constant)
    except RecursionError:
        raise InvalidArgument(f"{what} is deeper than {MAX_DEPTH}") from None
    except json.JSONDecodeError as e:
        raise InvalidArgument(f"{what} isn't JSON: {e}") from None
    if not isinstance(found, dict):
        raise InvalidArgument(f"{what} isn't an object")
    if _depth(found) > MAX_DEPTH:
        raise InvalidArgument(f"{what} is deeper than {MAX_DEPTH}")
    want = set(fields)
    if set(found) != want:
        raise InvalidArgument(f"{what} lacks {sorted(want - set(found))} or has unknown {sorted(set(found) - want)}")
    return found
