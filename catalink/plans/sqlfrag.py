"""DuckDB SQL fragments mirroring ``catalink.functions.expressions``."""

from __future__ import annotations

from collections.abc import Sequence

from catalink import config as C
from catalink.functions.expressions import BLANKS

_BLANK = r"[\p{Z}\s\x1c-\x1f\x85]"
_NUM = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
_INT = r"[+-]?\d+"
NBSP = "\u00a0"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {q(BLANKS)})"


def normalize_ws(x: str) -> str:
    return strip(f"replace({x}, '{NBSP}', ' ')")


def missing(x: str, tokens: Sequence[str] = C.MISSING_TOKENS) -> str:
    s = strip(x)
    return f"CASE WHEN {s} NOT IN ({', '.join(q(t) for t in tokens)}) THEN {s} END"


def safe_double(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN regexp_full_match({s}, '{_NUM}') THEN TRY_CAST({s} AS DOUBLE) END"


def safe_long(x: str) -> str:
    s = strip(x)
    d = safe_double(x)
    return (f"CASE WHEN regexp_full_match({s}, '{_INT}') THEN TRY_CAST({s} AS BIGINT) "
            f"WHEN ({d}) = floor({d}) AND abs({d}) < 9.2e18 THEN CAST({d} AS BIGINT) END")


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"
