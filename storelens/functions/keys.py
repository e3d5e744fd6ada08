"""Surrogate keys: md5 hex of the concatenated, NULL-guarded column texts."""

from __future__ import annotations

from storelens.functions.sql import as_column, lit
from storelens.sources.schemas import KEY_NULL


def md5_key_sql(*xs: str, sep: str = "", null: str = KEY_NULL) -> str:
    """md5(coalesce(a,'_') || sep || coalesce(b,'_') ...).

    With the default ``sep=""`` keys match the warehouse's existing keys, which
    means ('ab','c') and ('a','bc') collide; pass a separator for new keys.
    """
    parts = [f"coalesce(CAST({x} AS STRING), {lit(null)})" for x in xs]
    joined = f"concat_ws({lit(sep)}, {', '.join(parts)})" if sep else f"concat({', '.join(parts)})"
    return f"md5({joined})"


md5_key = as_column(md5_key_sql)
