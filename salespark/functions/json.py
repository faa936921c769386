"""JSON access with Python ``dict`` semantics, on Spark VARIANT.

The event on the wire is schemaless JSON.  Python code distinguishes an
absent key from a key holding ``null`` (``"k" in event`` / ``event.get(k, d)``),
which ``from_json`` with a fixed schema cannot.  We parse the text once into a
VARIANT and read fields with ``try_variant_get``:

* absent key            -> SQL NULL
* key holding JSON null -> a VARIANT null (not SQL NULL)

so ``has_key`` is an ``IS NOT NULL`` test on the variant-typed extraction.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def parse(text: Column | str, strict: bool = False) -> Column:
    """JSON text -> VARIANT; NULL for text that is not JSON (dead letter).

    ``strict=True`` fails the query on bad JSON instead, as ``json.loads`` in
    the original jobs did."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_object(text: Column | str, v: Column | str) -> Column:
    """The text parsed and its top level is a JSON object (a parsed JSON
    text that starts with ``{`` is an object; no schema walk per row)."""
    return _c(v).isNotNull() & F.ltrim(_c(text)).startswith("{")


def field(v: Column | str, key: str, as_type: str = "variant") -> Column:
    """``event[key]`` as ``as_type`` (NULL when absent or not convertible)."""
    return F.try_variant_get(v, f"$.{key}", as_type)


def fields(v: Column | str, keys) -> Column:
    """struct of ``event[key]`` as VARIANTs, in one walk over the object (NULL: absent)."""
    return F.try_variant_get(v, "$", "struct<" + ", ".join(f"{k}: variant" for k in keys) + ">")


def as_type(value: Column, as_type: str) -> Column:
    """A VARIANT value as ``as_type`` (NULL when not convertible)."""
    return F.try_variant_get(value, "$", as_type)


def text_of(value: Column) -> Column:
    """The JSON text of a VARIANT value; NULL: absent."""
    return F.to_json(value)


def read(value: Column, text: Column, as_type: str) -> Column:
    """``as_type(value, as_type)`` with the value's ``text_of`` at hand, as a string, int, double or decimal.

    ``try_variant_get`` builds a cast anew for every row.  A string without escapes, and a number without an exponent,
    are read off their text, which gives the same value for a small part of that; all others go the long way.  Pass
    ``text`` as a column: it is read several times."""
    long_way = F.try_variant_get(value, "$", as_type)
    if as_type == "string":
        plain = text.startswith('"') & ~text.contains("\\")
        return F.when(plain, F.substr(text, F.lit(2), F.length(text) - 2)).otherwise(long_way)
    k = F.schema_of_variant(value)
    plain = k == "BIGINT" if as_type == "int" else (k == "BIGINT") | k.startswith("DECIMAL")
    return F.when(plain, text.try_cast(as_type)).otherwise(long_way)


def has_key(v: Column | str, key: str) -> Column:
    """``key in event`` -- true also when the value is JSON null."""
    return field(v, key).isNotNull()


def kind(v: Column | str, key: str) -> Column:
    """JSON type of ``event[key]``: BIGINT, DECIMAL(p,s), DOUBLE, STRING,
    BOOLEAN, VOID (null), OBJECT<...>, ARRAY<...>; NULL when absent."""
    return F.schema_of_variant(field(v, key))


def is_number(v: Column | str, key: str) -> Column:
    """Present and a JSON number (Python int or float)."""
    return type_is_number(field(v, key))


def type_is_number(value: Column) -> Column:
    """A VARIANT value that is a JSON number."""
    k = F.schema_of_variant(value)
    return k.isin(*NUMERIC_KINDS) | k.startswith("DECIMAL")


def get_default(v: Column | str, key: str, as_type: str, default: Column) -> Column:
    """``event.get(key, default)``: the default only when the key is absent;
    an explicit null stays null (this is *not* ``coalesce``)."""
    return F.when(has_key(v, key), field(v, key, as_type)).otherwise(default)


def variant_lit(json_text: str) -> Column:
    """A constant VARIANT from JSON text, e.g. ``variant_lit('"N/A"')``."""
    return F.parse_json(F.lit(json_text))


def as_map(v: Column | str) -> Column:
    """A JSON object variant as ``map<string,variant>`` (keeps unknown keys)."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def struct_as_map(*cols: Column) -> Column:
    """Named columns -> ``map<string,variant>`` (values keep their JSON types)."""
    return F.try_variant_get(F.to_variant_object(F.struct(*cols)), "$",
                             "map<string,variant>")


def merge(base: Column, new: Column, new_keys: list[str]) -> Column:
    """``{**event, **new}``: unknown keys of ``event`` kept, new keys win."""
    keep = F.map_filter(base, lambda k, _v: ~k.isin(*new_keys))
    return F.map_concat(keep, new)


def extend(text: Column, v: Column | str, new: dict[str, Column], known: Column) -> Column:
    """JSON text of ``merge`` of the object ``v``, whose ``text_of`` is ``text``, and the columns ``new`` by their keys.  ``known``: whether
    ``v`` has one of those keys already.

    If it has none, and no escapes, the new keys are put behind its own, in the order of their names, as in a VARIANT; else the
    two are merged as maps."""
    merged = write(merge(as_map(v), struct_as_map(*[c.alias(k) for k, c in new.items()]), list(new)))
    more = write(F.struct(*[new[k].alias(k) for k in sorted(new)]))
    # bytes are cut in no time, characters have to be counted first
    joined = F.concat(F.substr(text.cast("binary"), F.lit(1), F.octet_length(text) - 1), F.lit(",").cast("binary"),
                      F.substr(more.cast("binary"), F.lit(2), F.octet_length(more) - 1)).cast("string")
    return F.when(known | (text == "{}") | text.contains("\\"), merged).otherwise(joined)


def write(obj: Column) -> Column:
    """Object -> JSON text; null values are written (as Python does)."""
    return F.to_json(obj, {"ignoreNullFields": "false"})
