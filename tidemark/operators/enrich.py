"""Typed metadata of the eleven record types, as one projection.

Each type owns one namespace: a struct whose fields are null when the payload has no
usable value, and which is null itself when all fields are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import dates, text
from tidemark.functions import values as v
from tidemark.functions.values import Value
from tidemark.sources.payloads import is_safe_table, public_columns, routed

Getter = Callable[[str], Value]
Reader = Callable[[Value], Column]
Columns = Callable[[str], Column]


@dataclass(frozen=True)
class TypeRule:
    """How one type is read: raw values out of the payload, then fields out of those.

    The two steps become two projections, so that a value used in several places of a
    rule is read once.
    """

    reads: dict[str, Reader]
    fields: Callable[[Columns], dict[str, Column]]


def _same(*names: str, **renamed: str) -> Callable[[Columns], dict[str, Column]]:
    pairs = {**{n: n for n in names}, **renamed}
    return lambda raw: {field: raw(name) for field, name in pairs.items()}


def _address(raw: Columns) -> dict[str, Column]:
    on_map = raw("lat").between(-90, 90) & raw("lng").between(-180, 180)
    return {
        "lat": F.when(on_map, raw("lat")), "lng": F.when(on_map, raw("lng")),
        "city": raw("city"), "country": raw("country"),
    }


def _contact(raw: Columns) -> dict[str, Column]:
    return {
        "firstname": raw("firstname"), "lastname": raw("lastname"),
        "dateofbirth": dates.strict_date(raw("dateofbirth")),
        "birth_ts": dates.strict_date_seconds(raw("dateofbirth")),
    }


def _date(raw: Columns) -> dict[str, Column]:
    return {
        "start_ts": dates.datetime_seconds(raw("start")), "end_ts": dates.datetime_seconds(raw("end")),
        "allday": raw("allday"),
    }


def _dated(*names: str) -> Callable[[Columns], dict[str, Column]]:
    """The named fields as read, with strict start and deadline dates as seconds."""
    return lambda raw: {
        **{n: raw(n) for n in names},
        "start_ts": dates.strict_date_seconds(raw("start")),
        "deadline_ts": dates.strict_date_seconds(raw("deadline")),
    }


RULES: dict[str, TypeRule] = {
    "account": TypeRule({"accounttype": v.scalar_text}, _same("accounttype")),
    "address": TypeRule(
        {"lat": v.number_or_null, "lng": v.number_or_null, "city": v.string_text, "country": v.string_text}, _address),
    "contact": TypeRule(
        {"firstname": v.scalar_text, "lastname": v.scalar_text, "dateofbirth": v.scalar_text}, _contact),
    "date": TypeRule({"start": v.scalar_text, "end": v.scalar_text, "allday": v.flag_or_null}, _date),
    "file": TypeRule(
        {"mime": v.string_text, "filename": v.string_text, "size": v.positive_int_or_null, "url": v.string_text},
        _same("filename", "size", "url", mime_type="mime")),
    "product": TypeRule({"code": v.scalar_text, "weight": v.int_or_null}, _same("code", "weight")),
    "project": TypeRule(
        {"projid": v.scalar_text, "alias": v.scalar_text, "start": v.scalar_text, "deadline": v.scalar_text},
        _dated("projid", "alias")),
    "resource": TypeRule({"quota": v.int_or_null, "used": v.int_or_null}, _same("quota", "used")),
    "tag": TypeRule({"tag": v.scalar_text}, _same("tag")),
    "task": TypeRule(
        {"start": v.scalar_text, "deadline": v.scalar_text, "expense": v.int_or_null, "done": v.flag_or_null},
        _dated("expense", "done")),
    "text": TypeRule({"mime": v.scalar_text}, _same("mime")),
}


def field_columns(alias: str, raw: Columns, existing: Column | None = None) -> dict[str, Column]:
    """The fields of one type as flat columns; a parsed value wins over an existing one."""
    cols = RULES[alias].fields(raw)
    return {
        f"_{alias}_{name}": col if existing is None else F.coalesce(col, existing[name]) for name, col in cols.items()}


def namespace(alias: str) -> Column:
    """The struct of one type over its flat columns, null when all of them are."""
    names = list(RULES[alias].fields(F.col))
    cols = {name: F.col(f"_{alias}_{name}") for name in names}
    some = reduce(lambda a, b: a | b, [c.isNotNull() for c in cols.values()])
    return F.when(some, F.struct(*[c.alias(name) for name, c in cols.items()])).alias(alias)


def route(content_alias: Column, metadata_alias: Column) -> Column:
    """The type an item is parsed as: content first, then metadata; trimmed, lower case."""
    return F.coalesce(text.lower(text.non_blank(content_alias)), text.lower(text.non_blank(metadata_alias)))


def parser_of(alias: Column) -> Column:
    """The first parser that takes the item: its domain parser, else the fallback."""
    return F.when(alias.isin(*RULES), alias).otherwise("fallback")


def merge_maps(old: Column, new: Column) -> Column:
    """Open metadata: new keys win, other old keys stay, an empty result changes nothing."""
    kept = F.map_filter(old, lambda key, _: ~F.array_contains(F.map_keys(new), key))
    return F.when(F.coalesce(F.size(new), F.lit(0)) <= 0, old).otherwise(F.map_concat(kept, new))


def _read_table(rows: DataFrame, alias: str, keep: list[Column]) -> DataFrame:
    rule = RULES[alias]
    raw = [read(v.column_value(rows, name)).alias(f"_{name}") for name, read in rule.reads.items()]
    return rows.select(*keep, *raw)


def enrich_payload(rows: DataFrame, alias: str) -> DataFrame:
    """The namespace fields of one payload table, column types taken from its schema."""
    raw = _read_table(rows, alias, [F.col("id")])
    cols = RULES[alias].fields(lambda name: F.col(f"_{name}"))
    return raw.select("id", *[c.alias(name) for name, c in cols.items()])


def enriched_union(tables: dict[str, DataFrame], aliases: dict[str, str]) -> DataFrame:
    """Payload rows of all tables with their namespaces: one narrow branch per table.

    The rules of a type run where its table is scanned, on typed columns, so that a
    branch compiles to one stage and the shuffle that joins entries to payloads carries
    the result. ``aliases`` maps table names to type aliases, in any case; a table of
    another type takes the fallback.
    """
    branches = []
    for name, rows in tables.items():
        if not is_safe_table(name):
            continue
        alias = routed(aliases.get(name))
        kept = public_columns(rows, name, alias)
        text_body = v.scalar_text(v.column_value(rows, "text")) if alias == "text" else F.lit(None).cast("string")
        base = [
            F.lit(name).alias("dbtable"), F.col("id").alias("entry_id"),
            F.to_variant_object(F.struct(*kept)).alias("payload"), text_body.alias("body"),
        ]
        if alias in RULES:
            kept_names = ["dbtable", "entry_id", "payload", "body"]
            flat = field_columns(alias, lambda name: F.col(f"_{name}"))
            fields = _read_table(rows, alias, base).select(*kept_names, *[c.alias(n) for n, c in flat.items()])
            branches.append(fields.select(*kept_names, F.lit(alias).alias("parser"), namespace(alias)))
        else:
            branches.append(rows.select(*base, F.lit("fallback").alias("parser")))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
    absent = [F.lit(None).cast("string").alias(other) for other in RULES if other not in out.columns]
    return out.select("*", *absent)


def _shared_reads() -> dict[tuple[str, Reader], list[str]]:
    """Each distinct (payload key, reader) with the types that use it."""
    shared: dict[tuple[str, Reader], list[str]] = {}
    for alias, rule in RULES.items():
        for key, read in rule.reads.items():
            shared.setdefault((key, read), []).append(alias)
    return shared


def enrich_items(items: DataFrame) -> DataFrame:
    """Add one struct column per type and ``parser``; four projections, no shuffle.

    The payload is a ``VARIANT``; a value is read only on rows of a type that has it. A
    namespace column already on the item is merged.
    """
    def raw_name(key: str, read: Reader) -> str:
        return f"_{key}__{read.__name__}"

    payload, alias = F.col("content.payload"), F.col("_alias")
    routed = items.withColumn("_alias", route(F.col("content.type.alias"), F.col("type_alias")))
    reads = _shared_reads()
    users = {key: sorted({a for (k, _), used_by in reads.items() if k == key for a in used_by}) for key, _ in reads}
    picked = {f"_v_{key}": F.when(alias.isin(types), v.variant_value(payload, key).col) for key, types in users.items()}
    read_cols = {
        raw_name(key, read): F.when(alias.isin(used_by), read(v.Value(F.col(f"_v_{key}"), T.VariantType())))
        for (key, read), used_by in reads.items()
    }
    flat: dict[str, Column] = {}
    for name, rule in RULES.items():
        existing = F.col(name) if name in items.columns else None
        found = field_columns(name, lambda key, rule=rule: F.col(raw_name(key, rule.reads[key])), existing)
        flat |= {field: F.when(alias == name, col) for field, col in found.items()}
    out = routed.withColumns(picked).withColumns(read_cols).withColumns(flat)
    out = out.withColumns({**{name: namespace(name) for name in RULES}, "parser": parser_of(alias)})
    return out.drop("_alias", *picked, *read_cols, *flat)
