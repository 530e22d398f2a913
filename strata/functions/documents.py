"""JSON documents: parse once, read fields, unnest arrays, encode.

Rules that keep results equal to a row store's ``->`` / ``->>`` operators:

* declare every leaf as ``string`` and cast afterwards - a number then
  arrives as its text, and a quoted number still casts;
* a payload that is JSON ``null`` is a row of NULLs, not an error;
* malformed JSON, and a document of another shape than the schema's (an object
  where an array is due, text where a list is), fails the job (``on_bad='fail'``)
  or is flagged for the quarantine (``on_bad='flag'``, ``is_bad_document``),
  never silently turned into NULLs or into a row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import ColLike, _col

FAIL = "fail"
FLAG = "flag"

# Lossless text for timestamps (microseconds kept; the default keeps millis).
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _null_literal_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == F.lit("null"), F.lit(None).cast("string")).otherwise(c)


def parse(c: ColLike, schema: str, on_bad: str = FAIL) -> Column:
    """Text -> typed struct/array, parsed once for all the fields read."""
    c = _null_literal_to_null(_col(c))
    if on_bad == FAIL:
        opens = _opening(schema)
        fits = F.when(F.ltrim(c).startswith(opens), c).when(c.isNotNull(), F.raise_error(
            F.concat(F.lit(f"the document does not begin with {opens}: "), F.substring(c, 1, 80))))
        return F.from_json(fits, schema, {"mode": "FAILFAST"})
    return F.from_json(F.when(~is_bad_document(c, schema), c), schema)


#: Stand for an escaped backslash, an escaped quote and the ends of a number while ``numbers_as_text``
#: works; no JSON text holds these characters unescaped.
_BACKSLASH, _QUOTE, _NUMBER = "\u0002", "\u0003", "\u0001"
_TOKEN = '("[^"]*+")|(-?[0-9][0-9.eE+-]*+)'


def numbers_as_text(c: ColLike) -> Column:
    """The JSON text with each bare number quoted, so that ``1.50``, ``1e3`` or thirty
    digits are read as they are written (the parser would give ``1.5``, ``1000.0`` and a rounded double).

    Numbers inside strings, keys and everything else stay.  Text that is not JSON is
    returned as it is, so that it still fails or is flagged.  Use it where the leaves are
    read as text; a sub-document that is kept as text has its numbers quoted as well."""
    c = _col(c)
    hidden = F.replace(F.replace(c, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    # a string is followed by two marks, which go again; a number stands between two
    marked = F.regexp_replace(hidden, _TOKEN, f"$1{_NUMBER}$2{_NUMBER}")
    quoted = F.replace(F.replace(marked, F.lit(_NUMBER * 2), F.lit("")), F.lit(_NUMBER), F.lit('"'))
    shown = F.replace(F.replace(quoted, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    return F.when(is_bad_json(c), c).otherwise(shown)


def _opening(schema: str) -> str:
    return "[" if schema.lstrip().lower().startswith("array") else "{"


def is_bad_document(c: ColLike, schema: str) -> Column:
    """True when the text is not JSON, or JSON of another shape than
    ``schema`` (struct or array of structs; leaves are strings and always fit).
    NULL text and JSON null are not bad."""
    c = _null_literal_to_null(_col(c))
    if _opening(schema) == "{":
        inner = schema.strip()[len("struct<"):-1]
        wrong = F.from_json(c, f"struct<{inner}, _wrong:string>", {"columnNameOfCorruptRecord": "_wrong"}).getField("_wrong").isNotNull()
    else:
        element = schema.strip()[len("array<"):-1]
        items = F.from_json(c, "array<string>")
        wrong = items.isNull() | F.exists(items, lambda x: F.coalesce(_wrong_element(x, element), F.lit(False)))
    return c.isNotNull() & (F.try_parse_json(c).isNull() | ~F.ltrim(c).startswith(_opening(schema)) | F.coalesce(wrong, F.lit(False)))


def _wrong_element(x: Column, element: str) -> Column:
    if not element.strip().lower().startswith("struct"):
        return F.lit(False)
    inner = element.strip()[len("struct<"):-1]
    parsed = F.from_json(x, f"struct<{inner}, _wrong:string>", {"columnNameOfCorruptRecord": "_wrong"})
    return ~F.ltrim(x).startswith("{") | parsed.getField("_wrong").isNotNull()


def is_bad_json(c: ColLike) -> Column:
    """True when the text is not JSON at all (NULL text is not bad)."""
    c = _col(c)
    return c.isNotNull() & F.try_parse_json(c).isNull()


def field(doc: ColLike, path: str) -> Column:
    """``doc->'a'->>'b'`` is ``field(doc, 'a.b')`` on the parsed struct."""
    out = _col(doc)
    for part in path.split("."):
        out = out.getField(part)
    return out


def path_text(c: ColLike, path: str) -> Column:
    """C2 for a one-off path on unparsed text (``$.a.b``)."""
    return F.get_json_object(_col(c), "$" + path if path.startswith("[") else "$." + path)


def unnest(arr: ColLike) -> Column:
    """One row per element; NULL and empty arrays give no rows."""
    return F.explode(_col(arr))


def unnest_with_position(arr: ColLike, pos: str = "pos", value: str = "value") -> Column:
    """U4: element and its 0-based position."""
    return F.posexplode(_col(arr)).alias(pos, value)


def encode(*cols: ColLike) -> Column:
    """K7: a record as one JSON text."""
    return to_text(F.struct(*[_col(c) for c in cols]))


def to_text(c: ColLike) -> Column:
    """K7 for any struct / array column (lossless timestamps)."""
    return F.to_json(_col(c), JSON_WRITE_OPTIONS)


def rowset(df: DataFrame, text: str, element_schema: str, keep: list[str] | None = None,
           on_bad: str = FAIL) -> DataFrame:
    """A5: a JSON array of flat records (kept as text) -> one row per record.

    ``element_schema`` is the struct DDL of one element, leaves as strings.
    """
    keep = keep or []
    parsed = parse(text, f"array<struct<{element_schema}>>", on_bad)
    return df.select(*keep, F.explode(parsed).alias("_r")).select(*keep, "_r.*")
