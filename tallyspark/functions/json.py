"""JSON helpers.

A response body holding a JSON array is parsed once, to VARIANT; its elements
become rows, and scalar fields are read from the parsed elements and cast.
Non-scalar field values (objects, arrays) read as NULL, as a scalar extractor
does. Casts run in ANSI mode, so a non-numeric string for a numeric field
raises instead of turning into NULL. An object that names a key twice is not
valid JSON here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bodies longer than this are parsed element by element, as one VARIANT has a size limit of 16 MiB.
WHOLE_BODY_CHARS = 4 << 20


def scalar_text(value: Column, field: str) -> Column:
    """Text of ``$.field`` of a VARIANT; NULL when missing, JSON null, object or array.

    Only text that looks like an object or array is asked for its type (a
    string may begin with a bracket too); the question is a branch of its own,
    so it is not worked out for other values.
    """
    path = f"$['{field}']"
    text = F.try_variant_get(value, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
    return F.when(text.rlike(r"^[\[{]"), F.when(kind == "STRING", text)).otherwise(text)


def json_scalar(element: Column, field: str) -> Column:
    """Scalar text of ``$.field`` of a JSON text; NULL when missing, JSON null, object or array, or no JSON."""
    return scalar_text(F.try_parse_json(element), field)


def json_elements(body: Column) -> Column:
    """The elements of a JSON array body as VARIANTs; NULL for a NULL body or JSON null.

    Any other body (an error object, a page, a cut-off array) raises and names
    its file, so bad responses never turn into missing rows.
    """
    bad = F.raise_error(F.concat(F.lit("response body is not a JSON array: "), F.input_file_name(), F.lit(" "),
                                 F.substring(body, 1, 80))).cast("array<variant>")
    # a parser reads the first value and ignores what follows, so the text has to end like an array as well
    inner = F.btrim(body, F.lit(" \t\r\n"))
    array = inner.startswith("[") & inner.endswith("]")
    whole = F.try_variant_get(F.try_parse_json(F.when(array, body)), "$", "array<variant>")
    parts = F.transform(F.from_json(body, "array<string>", {"mode": "PERMISSIVE"}), lambda x: F.try_parse_json(x))
    parsed = F.when(F.length(body) <= WHOLE_BODY_CHARS, whole).otherwise(F.when(array, parts))
    return F.when(body.isNull() | (inner == "null"), F.lit(None).cast("array<variant>")) \
        .otherwise(F.coalesce(parsed, bad))


def parse_json_rows(df: DataFrame, body_col: str, fields: dict[str, str],
                    keep: list[str] | None = None) -> DataFrame:
    """Explode a JSON-array body column and extract typed scalar fields.

    ``fields`` maps field name -> Spark SQL type. Fields that later steps do
    not use are pruned by the optimizer before the cast, so they are never
    read.
    """
    keep = list(keep or [])
    elements = df.select(*keep, F.explode(json_elements(F.col(body_col))).alias("_el"))
    return elements.select(*keep, *[scalar_text(F.col("_el"), n).cast(t).alias(n) for n, t in fields.items()])
