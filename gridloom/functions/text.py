"""Text and JSON helpers."""

from __future__ import annotations

import json

from gridloom.functions._base import grid_function, quoted


@grid_function("prefix STRING, items ARRAY<STRING>", "STRING")
def prefix_join(prefix, items, sep: str = ",") -> str:
    """Join an array of strings, each with a prefix; NULL for a NULL or empty array.

    ``prefix`` is an expression, so a constant is written ``"'t1.'"``.
    """
    return f"CASE WHEN size({items}) > 0 THEN array_join(transform({items}, i_ -> concat({prefix}, i_)), {quoted(sep)}) END"


@grid_function("document STRING", "STRING")
def json_slice(document, key: str = "", rename: str | None = None) -> str:
    """One member of a JSON object as an object of its own, ``{}`` when the member is absent."""
    path = quoted("$[" + json.dumps(key, ensure_ascii=False) + "]")
    value = f"try_variant_get(try_parse_json({document}), {path}, 'variant')"
    start = quoted("{" + json.dumps(rename or key, ensure_ascii=False) + ":")
    return f"CASE WHEN {value} IS NOT NULL THEN concat({start}, to_json({value}), '}}') ELSE '{{}}' END"
