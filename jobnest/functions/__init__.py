"""Scalar column functions (JVM-side built-ins only, no Python UDFs)."""

from jobnest.functions.json import (
    parse_body,
    parse_once,
    flatten_struct_columns,
    infer_json_schema,
    lists_as_text,
)
from jobnest.functions.scalars import (
    strict_int,
    strict_long,
    require,
    dotted_component,
    url_key,
    split_list_param,
    translate_name,
    day_before,
    month_before,
    audit_timestamp,
    render_in_zone,
    bookkeeping_columns,
)
from jobnest.functions.nested import (
    first_id,
    first_nested_id,
    pluck,
    all_present,
    flag,
)

__all__ = [
    "parse_body", "parse_once", "flatten_struct_columns", "infer_json_schema", "lists_as_text",
    "strict_int", "strict_long", "require", "dotted_component", "url_key", "split_list_param",
    "translate_name", "day_before", "month_before", "audit_timestamp", "render_in_zone", "bookkeeping_columns",
    "first_id", "first_nested_id", "pluck", "all_present", "flag",
]
