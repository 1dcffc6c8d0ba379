"""Schema-driven rewriting of every string in a nested document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concordat.functions.text import let, redact_paths


def map_strings(col: Column, dtype: T.DataType, fn: Callable[[Column], Column]) -> Column:
    """Apply `fn` to all strings below `col`, at any depth; map keys stay as they are.

    The recursion runs over the schema while the plan is built; the result is one
    expression tree.
    """
    if isinstance(dtype, T.StringType):
        return fn(col)
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: map_strings(x, dtype.elementType, fn))
    if isinstance(dtype, T.MapType):
        return F.transform_values(col, lambda _, v: map_strings(v, dtype.valueType, fn))
    if isinstance(dtype, T.StructType):
        rebuilt = F.struct(*[map_strings(col[f.name], f.dataType, fn).alias(f.name) for f in dtype.fields])
        return F.when(col.isNotNull(), rebuilt)
    return col


_ANY = "map<string,variant>"

# The fields that name an entry of a list, in the order in which they are asked.
_IDENTITY = (
    ("bom-ref",), ("license.id",), ("license.name",), ("expression",), ("type", "url"), ("alg", "content"), ("name",), ("ref",), ("id",),
)


def merge(raw: Column, typed: Column, dtype: T.DataType) -> Column:
    """JSON text of a record: the raw one, with what has changed in the typed record laid over it.

    A three-way merge along the typed schema. What the typed record says is compared with what it said when it was read (the raw
    text parsed again); fields that have not changed keep their raw text, as do all fields that the schema does not know, at any depth.
    Entries of a list of records are matched by identity (bom-ref, licence id or name, expression, type and url, name), the first of a
    name with the first of that name and so on, so that unknown fields stay with their owners when entries are added, removed or
    moved. An entry that the typed list no longer has is gone; a field whose typed value is null keeps its raw value.
    """
    return F.when(raw.isNull(), F.to_json(typed)).otherwise(_merged(raw, F.from_json(raw, dtype), typed, dtype))


def _json(value: Column) -> Column:
    """JSON text of any value; null for null."""
    whole = F.to_json(F.struct(value.alias("k")))
    return F.when(value.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - 6))


def _merged(raw: Column, was: Column, now: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        changed = _merge_records(raw, was, now, dtype)
    elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        changed = _merge_lists(raw, now, dtype)
    else:
        changed = _json(now)
    return F.when(now.isNull() | now.eqNullSafe(was), raw).when(raw.isNull(), _json(now)).otherwise(changed)


def _merge_records(raw: Column, was: Column, now: Column, dtype: T.StructType) -> Column:
    def laid(fields: Column) -> Column:
        def text(name: str) -> Column:
            return F.to_json(F.element_at(fields, F.lit(name)))

        new = [_merged(text(f.name), was[f.name], now[f.name], f.dataType) for f in dtype.fields]
        value = lambda k: F.coalesce(*[F.when(k == f.name, v) for f, v in zip(dtype.fields, new, strict=True)], F.to_json(F.element_at(fields, k)))
        known = F.filter(
            F.array(*[F.when(now[f.name].isNotNull(), F.lit(f.name)) for f in dtype.fields]), lambda k: k.isNotNull())
        names = F.array_union(F.map_keys(fields), known)
        shown = F.transform(names, lambda k: F.concat(_json(k), F.lit(":"), value(k)))
        return F.concat(F.lit("{"), F.array_join(shown, ","), F.lit("}"))

    return let(F.from_json(raw, _ANY), laid)


def _identity(entry: Column) -> Column:
    """The name of a list entry given as JSON text; all unnamed ones share one."""
    parts = [F.concat(F.lit(f"{fields[0]} "), *[F.get_json_object(entry, f"$.{x}" if "-" not in x else f"$['{x}']") for x in fields]) for fields in _IDENTITY]
    return F.coalesce(*parts, F.lit(""))


def _merge_lists(raw: Column, now: Column, dtype: T.ArrayType) -> Column:
    def paired(sides: Column) -> Column:
        old, new, old_names, names = sides["old"], sides["new"], sides["old_names"], sides["names"]

        def entry(value: Column, i: Column) -> Column:
            name = F.get(names, i)
            nth = F.size(F.filter(F.slice(names, F.lit(1), i), lambda x: x == name))  # entries of this name before
            owner = F.get(F.filter(F.transform(old_names, lambda x, j: F.when(x == name, j)), lambda j: j.isNotNull()), nth)

            def laid(text: Column) -> Column:
                return _merged(text, F.from_json(text, dtype.elementType), value, dtype.elementType)

            return F.coalesce(let(F.get(old, owner), laid), F.get(new, i))

        return F.concat(F.lit("["), F.array_join(F.transform(now, entry), ","), F.lit("]"))

    old = F.transform(F.from_json(raw, "array<variant>"), lambda v: F.to_json(v))
    new = F.transform(now, lambda v: F.to_json(v))
    texts = F.struct(old.alias("old"), new.alias("new"))
    return let(texts, lambda t: let(F.struct(
        t["old"].alias("old"), t["new"].alias("new"), F.transform(t["old"], _identity).alias("old_names"), F.transform(t["new"], _identity).alias("names")), paired))


def without_tools(raw: Column) -> Column:
    """Raw head of a document without metadata.tools, which are about to be stamped anew."""
    whole = F.from_json(raw, _ANY)
    rest = F.to_json(F.map_filter(F.from_json(F.get_json_object(raw, "$.metadata"), _ANY), lambda k, v: k != "tools"))
    kept = F.map_filter(whole, lambda k, v: k != "metadata")
    return F.coalesce(F.to_json(F.map_concat(kept, F.create_map(F.lit("metadata"), F.try_parse_json(rest)))), raw)


# A JSON string literal; possessive, so that long texts need no stack.
_LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def redact_json(raw: Column, extra: tuple[str, ...] = ()) -> Column:
    """JSON text with every string value redacted, at any depth; keys stay as they are."""
    literals, gaps = F.regexp_extract_all(raw, F.lit(_LITERAL), F.lit(0)), F.split(raw, _LITERAL)

    def shown(literal: Column, after: Column) -> Column:
        text = F.from_json(F.concat(F.lit('{"k":'), literal, F.lit("}")), "k string")["k"]
        quoted = F.to_json(F.struct(redact_paths(text, extra).alias("k")))
        value = F.substring(quoted, F.lit(6), F.length(quoted) - 6)
        return F.when(F.startswith(F.ltrim(after), F.lit(":")), literal).otherwise(value)

    def piece(gap: Column, i: Column) -> Column:
        literal = F.get(literals, i)
        return F.concat(gap, F.when(literal.isNull(), "").otherwise(shown(literal, F.get(gaps, i + 1))))

    return F.array_join(F.transform(gaps, piece), "")


def redact_document(col: Column, dtype: T.DataType, extra: tuple[str, ...] = ()) -> Column:
    return map_strings(col, dtype, lambda s: redact_paths(s, extra))
