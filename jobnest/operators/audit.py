"""X3 without the failure: which landed body breaks which strict rule, and where (S1 bodies, G2/G3 rules).

The metro load stops at the first body that breaks a rule.  The audit reads the same bodies and gives one row per broken
rule instead, so that a load can be held back, or mended, with all places known:

* ``null:body``, ``json`` at ``$``: no body, or one that can't be read with the schema; nothing else is told of it
* ``missing:lines``, ``missing:stations``: a city or line without its list (an empty list is none)
* ``null:...``, ``cast:...`` of ``city_id`` (of cities with lines), ``metro_line_id`` and ``metro_station_id``
* ``part:metro_station_id``: an id without a second dotted part
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobnest.functions.json import parse_once
from jobnest.operators.metro import CITY

CORRUPT = "_corrupt"
_FINDING = "array<struct<path:string,rule:string,value:string>>"


def _found(path: Column, rule: str, value: Column | None = None) -> Column:
    return F.struct(path.alias("path"), F.lit(rule).alias("rule"), (F.lit(None) if value is None else value).cast("string").alias("value"))


def _number(value: Column, path: Column, name: str, shown: Column | None = None) -> Column:
    """The finding on a text that must be an integer, or NULL."""
    shown = value if shown is None else shown
    return (F.when(value.isNull(), _found(path, f"null:{name}", shown))
            .when(value.try_cast("bigint").isNull(), _found(path, f"cast:{name}", shown)))


def _station(s: Column, path: Column) -> Column:
    parts = F.split(s["id"], r"\.")
    at = F.concat(path, F.lit(".id"))
    return (F.when(s["id"].isNotNull() & (F.size(parts) < 2), _found(at, "part:metro_station_id", s["id"]))
            .otherwise(_number(F.get(parts, 1), at, "metro_station_id", s["id"])))


def _listed(items: Column, path: Column, each, name: str) -> Column:
    """Findings of all items of a list, or the one that the list is missing."""
    at = F.concat(path, F.lit(f".{name}"))
    inner = F.flatten(F.transform(items, lambda x, i: each(x, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")))))
    return F.when(items.isNull(), F.array(_found(at, f"missing:{name}"))).otherwise(inner).cast(_FINDING)


def _line(line: Column, path: Column) -> Column:
    own = F.array(_number(line["id"], F.concat(path, F.lit(".id")), "metro_line_id"))
    return F.concat(own.cast(_FINDING), _listed(line["stations"], path, lambda s, at: F.array(_station(s, at)), "stations"))


def _city(c: Column | dict[str, Column]) -> Column:
    own = F.when(F.size(c["lines"]) > 0, F.array(_number(c["id"], F.lit("$.id"), "city_id"))).otherwise(F.array())
    return F.concat(own.cast(_FINDING), _listed(c["lines"], F.lit("$"), _line, "lines"))


def _unread(text: Column) -> Column:
    return F.array(_found(F.lit("$"), "json", F.substring(text, 1, 80)))


def readable(schema: T.StructType) -> T.StructType:
    """``schema`` with a column for what can't be read with it."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def metro_audit(bodies: DataFrame, keep: list[str], body_col: str | None = "body") -> DataFrame:
    """(``keep``, path, rule, value) of every broken rule; no rows if the load can't fail on these bodies.

    ``body_col=None`` takes cities read as records with the schema ``readable(CITY)``.  No shuffle: bodies stay where they
    are read."""
    if body_col is None:
        c = {f.name: F.col(f.name) for f in readable(CITY).fields}
        found = F.when(c[CORRUPT].isNotNull(), _unread(c[CORRUPT])).otherwise(_city(c))
        found = bodies.select(*keep, found.alias("_found"))
    else:
        body = F.col(body_col)
        city = F.from_json(body, readable(CITY), {"columnNameOfCorruptRecord": CORRUPT})

        def findings(c: Column) -> list[Column]:
            broken = c["_city"].isNull() | c["_city"][CORRUPT].isNotNull()
            found = (F.when(c["_missing"], F.array(_found(F.lit("$"), "null:body")))
                     .when(broken, _unread(c["_city"][CORRUPT])).otherwise(_city(c["_city"])))
            return [found.alias("_found")]

        found = parse_once(bodies, F.struct(body.isNull().alias("_missing"), city.alias("_city")), findings, keep)
    # the findings are a column of their own: field access inside a generator is rewritten by the optimizer
    # (Spark 4.1 gave no rows for records there)
    return found.select(*keep, F.inline(F.filter(F.col("_found").cast(_FINDING), lambda f: f.isNotNull())))
