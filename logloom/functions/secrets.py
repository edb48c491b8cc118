"""Secrets of nested settings, removed where a schema marks them, on VARIANT values.

A schema is a dict of ``type`` and, by type:

* ``secret``: the value goes;
* ``object``: ``members``, a schema for each name; other members stay;
* ``dict`` and ``array``: ``inner``, the schema of every entry;
* ``union``: ``list`` of schemas, all of which apply;
* anything else (also ``any``): the value stays.

The walk becomes one nested expression, so its depth is the schema's, and values stay
in the engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.functions.text import bound

_MAP, _LIST = "map<string, variant>", "array<variant>"
SECRET = "array<struct<path: array<string>, set: boolean>>"


def _as(value: Column, kind: str) -> Column:
    """``value`` as a map or a list; null where it is neither."""
    return F.try_variant_get(value, "$", kind)


def has_secret(schema: dict | None) -> bool:
    """Whether anything below a schema is marked; what isn't needs no walk."""
    if schema is None:
        return False
    parts = [*schema.get("members", {}).values(), schema.get("inner"), *schema.get("list", [])]
    return schema["type"] == "secret" or any(has_secret(p) for p in parts)


def stripped(schema: dict, value: Column) -> Column:
    """``value`` (VARIANT) without its secrets; null where nothing is left of it."""
    kind = schema["type"]
    if kind == "secret":
        return F.lit(None).cast("variant")
    if not has_secret(schema):
        return value
    if kind == "union":
        for part in schema["list"]:
            value = stripped(part, value)
        return value
    if kind == "array":
        # an entry that is a secret itself leaves a null in its place
        kept = lambda entries: F.transform(entries, lambda v: F.coalesce(stripped(schema["inner"], v), F.parse_json(F.lit("null"))))
        return bound(value, lambda value: bound(_as(value, _LIST), lambda entries: F.when(entries.isNotNull(), F.to_variant_object(kept(entries))).otherwise(value)))
    return bound(value, lambda value: bound(_as(value, _MAP), lambda members: F.when(members.isNotNull(), F.to_variant_object(_kept(schema, members))).otherwise(value)))


def _kept(schema: dict, members: Column) -> Column:
    """What is left of an object's or dict's members."""
    if schema["type"] == "dict":
        return F.map_filter(F.transform_values(members, lambda _, v: stripped(schema["inner"], v)), lambda _, v: v.isNotNull())
    marked = {name: part for name, part in schema["members"].items() if has_secret(part)}
    kept = F.map_filter(members, lambda k, _: ~k.isin(*marked))
    one = lambda name: lambda left: F.when(left.isNotNull(), F.create_map(F.lit(name), left)).otherwise(F.create_map().cast(_MAP))
    for name, part in marked.items():
        if part["type"] != "secret":
            kept = F.map_concat(kept, bound(stripped(part, F.element_at(members, name)), one(name)))
    return kept


def positions(schema: dict, value: Column, path: Column | None = None) -> Column:
    """path and set of each secret that the schema marks in ``value``, in its order.

    Members of an object are listed also where they hold nothing; entries of dicts and
    arrays only where there are any.
    """
    path = F.array().cast("array<string>") if path is None else path
    none = F.array().cast(SECRET)
    if schema["type"] == "secret":
        return F.array(F.struct(path.alias("path"), value.isNotNull().alias("set")))
    if not has_secret(schema):
        return none
    if schema["type"] == "union":
        found = bound(value, lambda value: F.concat(*(positions(part, value, path) for part in schema["list"])))
        merged = lambda found: F.transform(F.array_distinct(F.transform(found, lambda x: x["path"])), lambda p: F.struct(p.alias("path"), F.exists(found, lambda x: (x["path"] == p) & x["set"]).alias("set")))
        return bound(found, merged)
    if schema["type"] == "array":
        entries = F.coalesce(_as(value, _LIST), F.array().cast(_LIST))
        return F.flatten(F.transform(entries, lambda v, i: positions(schema["inner"], v, F.concat(path, F.array(i.cast("string"))))))

    def of_members(members: Column) -> Column:
        if schema["type"] == "dict":
            return F.flatten(F.transform(F.array_sort(F.map_keys(members)), lambda k: positions(schema["inner"], F.element_at(members, k), F.concat(path, F.array(k)))))
        return F.concat(*(positions(part, F.element_at(members, name), F.concat(path, F.array(F.lit(name)))) for name, part in schema["members"].items() if has_secret(part)))

    return bound(F.coalesce(_as(value, _MAP), F.create_map().cast(_MAP)), of_members)


def strip_secrets(schema: dict, text: Column) -> Column:
    """A struct of value (JSON text without secrets, null if nothing is left) and secrets (``positions``).

    Null and broken JSON give a null value with an object's secrets unset.  Members of
    what was walked through stand by name.
    """
    return bound(F.try_parse_json(text), lambda value: F.struct(F.to_json(stripped(schema, value)).alias("value"), positions(schema, value).alias("secrets")))
