"""JSON text ⇄ columns, all JVM-side.

* typed parse with a corrupt-record column (malformed lines are kept, not fatal);
* single-field reads without a schema;
* stamping of ``ts`` into the text of an object, every other byte kept, or by writing the object anew;
* record → JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from actimetry.schemas import CORRUPT_COL, LOG_RAW


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_logs(df: DataFrame, value_col: str = "value", schema: T.StructType = LOG_RAW,
               keep: list[str] | None = None) -> DataFrame:
    """Parse JSON text in ``value_col`` into typed columns.

    PERMISSIVE mode: a malformed line, or one with text after the object, yields null fields and its text in
    ``_corrupt_record``; the batch goes on. A null line is marked corrupt with
    empty text. ``keep`` lists input columns to carry along.
    """
    keep = list(keep or [])
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType())])
    parsed = F.from_json(F.col(value_col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL})
    out = df.select(*keep, parsed.alias("_r"), F.col(value_col).alias("_text"), is_one_document(value_col).alias("_one"))
    fields = [F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields]
    corrupt = F.when(F.col("_r").isNull(), F.lit("")).otherwise(
        F.coalesce(F.col(f"_r.{CORRUPT_COL}"), F.when(~F.col("_one"), F.col("_text"))))
    return out.select(*keep, *fields, corrupt.alias(CORRUPT_COL))


def json_field(value, path: str) -> Column:
    """Read one field from JSON text without a schema (``$.type`` style path)."""
    return F.get_json_object(_col(value), path)


def json_value(value, path: str, type_name: str = "string") -> Column:
    """Typed read of one field via the VARIANT type (``variant_get``); a missing field or a
    value that does not fit the type gives null."""
    return F.try_variant_get(F.try_parse_json(_col(value)), path, type_name)


def is_one_document(value) -> Column:
    """True if the text is one JSON value and nothing after it. Two readings have to agree, as each alone lets some tails
    by: as the only element of an array, and as a field with another field after it."""
    c = _col(value)
    alone = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    closed = F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit(',"end":1}')), "$.end") == "1"
    return F.coalesce(alone & closed, F.lit(False))


def is_object(value) -> Column:
    """True if the text is one JSON object and nothing after it."""
    return F.coalesce(_col(value).rlike(r"^\s*\{"), F.lit(False)) & is_one_document(value)


def json_object(value) -> Column:
    """JSON object text → ``map<string, variant>`` (every field, in order, any type; of a
    repeated key the last value); null for text that is not one JSON object."""
    obj = F.when(is_one_document(value), F.from_json(_col(value), "map<string,variant>"))
    keys = F.array_distinct(F.map_keys(obj))
    last = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(
        F.filter(F.map_entries(obj), lambda e: e["key"] == k), -1)["value"]))
    return F.when(F.size(keys) == F.size(F.map_keys(obj)), obj).otherwise(last)


def object_field(obj, name: str, type_name: str = "string") -> Column:
    """A typed field of a ``json_object`` map (null if absent or not of that type)."""
    return F.try_variant_get(F.element_at(obj, F.lit(name)), "$", type_name)


def stamp_object(obj, ts_ms, field: str = "ts") -> Column:
    """JSON text of a ``json_object`` map with ``field`` set to ``ts_ms`` (an incoming
    value is overwritten, other fields kept in order)."""
    kept = F.map_filter(obj, lambda k, v: k != F.lit(field))
    return F.to_json(F.map_concat(kept, F.create_map(F.lit(field), _col(ts_ms).cast("variant"))))


def stamp_json(value, ts_ms, field: str = "ts") -> Column:
    """Return the JSON object text with ``field`` set to ``ts_ms`` (any incoming value is
    overwritten, other fields kept in order). Malformed text gives null."""
    return stamp_object(json_object(value), ts_ms, field)


def _depth(text: Column) -> Column:
    """How many objects and arrays a piece of JSON opens beyond those it closes; braces in strings don't count."""
    bare = F.regexp_replace(F.regexp_replace(text, r"\\(?s:.)", ""), r'"[^"]*+"', "")
    return F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", ""))


def stamp_text(value, ts_ms, field: str = "ts") -> Column:
    """JSON object text with its own ``field`` set to ``ts_ms``, all other bytes as they came: numbers, order, spacing and repeated keys stay.

    An incoming value is overwritten where it stands, at each of its places if the key repeats; without one, the field is
    added at the end. Fields of nested objects are left alone. Text that is not one JSON object gives null. Only a key written
    with escapes, or a value that is an object, an array or a string of over 200 escapes, has the object written anew (``stamp_json``).
    """
    text, stamp = _col(value), _col(ts_ms).cast("long").cast("string")
    key = rf'"{field}"\s*:'
    old = r'^(\s*+)(?:"[^"\\]*+(?:\\(?s:.)[^"\\]*+){0,200}+"|[^"\[\]{},\s]++)'
    comma = F.when(text.rlike(r"^\s*+\{\s*+\}\s*+\z"), F.lit("")).otherwise(F.lit(","))
    added = F.regexp_replace(text, F.lit(r"\}(\s*+)\z"), F.concat(comma, F.lit(f'"{field}":'), stamp, F.lit("}$1")))
    # keys split the text into pieces outside strings; a piece after a key of the object itself starts with its value
    pieces, keys = F.split(text, key), F.regexp_extract_all(text, F.lit(key), F.lit(0))
    depths = F.transform(pieces, _depth)

    def own(i):
        return F.aggregate(F.slice(depths, F.lit(1), i), F.lit(0), lambda a, x: a + x) == 1

    places = F.filter(F.sequence(F.lit(1), F.size(keys)), own)
    spliced = F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(F.concat(
        F.element_at(keys, F.greatest(i, F.lit(1))), F.when(own(i), F.regexp_replace(p, F.lit(old), F.concat(F.lit("$1"), stamp))).otherwise(p)))), "")
    plain = F.forall(places, lambda i: F.element_at(pieces, i + 1).rlike(old))
    missed = F.map_contains_key(json_object(text), field)           # a key that is there, but not in plain letters
    return (F.when(~is_object(text), F.lit(None).cast("string"))
            .when(~text.contains(f'"{field}"') & ~text.contains("\\u"), added)
            .when((F.size(keys) > 0) & (F.size(places) > 0), F.when(plain, spliced).otherwise(stamp_json(text, ts_ms, field)))
            .when(text.contains("\\u") & F.coalesce(missed, F.lit(False)), stamp_json(text, ts_ms, field)).otherwise(added))


def to_json_record(cols: list | None = None) -> Column:
    """Serialise the given columns (default all) as one JSON object; null fields are omitted."""
    if not cols:
        return F.to_json(F.struct(F.col("*")))
    return F.to_json(F.struct(*[_col(c) for c in cols]))
