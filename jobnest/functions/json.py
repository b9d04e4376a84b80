"""JSON parsing helpers (E1) and schema walking for json_normalize-style output.

Only a schema ever reaches the driver: inference is one distributed
``schema_of_variant_agg`` aggregate that merges the per-row schemas JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


CORRUPT = "_corrupt_record"


def parse_body(col: str | Column, schema: T.DataType | str, keep_corrupt: bool = False) -> Column:
    """Permissive JSON parse; malformed text does not fail the job.

    Malformed text yields a struct of NULL fields; with ``keep_corrupt`` the
    struct also carries the raw text in ``_corrupt_record`` so callers can tell
    a broken document from an empty one.
    """
    c = F.col(col) if isinstance(col, str) else col
    if keep_corrupt and isinstance(schema, T.StructType):
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        return F.from_json(c, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})


def parse_once(df: DataFrame, parsed: Column, project, keep: list[str] | None = None) -> DataFrame:
    """Project columns out of one parsed document so the parse runs once per row.

    Catalyst pushes a later filter on a projected column below the projection
    and inlines the parse into the filter, once per referenced field.  Emitting
    the projected row through a one-element ``inline`` (a Generate) stops that:
    predicates on generated columns stay above it.
    """
    keep = keep or []
    staged = df.select(*keep, parsed.alias("_doc"))
    row = F.struct(*[F.col(c) for c in keep], *project(F.col("_doc")))
    return staged.select(F.inline(F.array(row)))


def infer_json_schema(df: DataFrame, col: str) -> T.StructType:
    """Merge the schema of every JSON object in ``col`` (one aggregate, one row back).

    Mixed-type fields come back as VARIANT, which :func:`lists_as_text` turns into
    raw JSON text.  Rows that are not objects are ignored.
    """
    row = (df.select(F.try_parse_json(F.col(col)).alias("_v"))
             .where(F.expr("schema_of_variant(_v) LIKE 'OBJECT<%'"))
             .agg(F.expr("schema_of_variant_agg(_v)").alias("s"))
             .first())
    return schema_of_object(row["s"] if row is not None else None)


def schema_of_object(text: str | None) -> T.StructType:
    """The schema that ``schema_of_variant_agg`` spells; anything but an object has no fields."""
    if not text or not text.startswith("OBJECT<"):
        return T.StructType([])
    parsed = T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))
    assert isinstance(parsed, T.StructType)
    return parsed


def lists_as_text(schema: T.DataType) -> T.DataType:
    """Keep lists (and mixed-type VARIANT fields) whole as JSON text; recurse into objects."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, lists_as_text(f.dataType), True)
                             for f in schema.fields])
    if isinstance(schema, (T.ArrayType, T.MapType, T.VariantType)):
        return T.StringType()
    if isinstance(schema, T.DecimalType):
        return T.DoubleType()
    return schema


def flatten_struct_columns(schema: T.StructType, root: str, sep: str = ".") -> list[Column]:
    """One column per leaf of nested objects, named with dotted paths (``a.m.x``)."""
    out: list[Column] = []

    def walk(st: T.StructType, path: list[str]) -> None:
        for f in st.fields:
            p = path + [f.name]
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, p)          # an empty object contributes no column
            else:
                ref = ".".join(f"`{x}`" for x in [root] + p)
                out.append(F.col(ref).alias(sep.join(p)))

    walk(schema, [])
    return out
