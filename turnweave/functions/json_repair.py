"""Repair, normalisation and validation of scenario JSON that a language model wrote.

The shapes are irregular (lists of single-key objects, maps keyed by scenario, strings in
place of objects), so entries are read as maps of raw JSON strings and settled one by one;
all of it is built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import canonical_scenario_id, none_if_empty, scenario_index, scenario_index_in_name, strip, topic_label

OBJECT = "map<string,string>"


def newlines_in_strings(c: Column) -> Column:
    """Raw line ends inside JSON strings become spaces; elsewhere they stay."""
    # a string literal: quote, escaped or plain characters, quote; only these parts change
    parts = F.regexp_extract_all(c, F.lit(r'(?s)"(?:\\.|[^"\\])*"|[^"]+|"'), F.lit(0))
    fixed = F.transform(parts, lambda p: F.when(p.startswith('"'), F.translate(p, "\n\r", "  ")).otherwise(p))
    return F.array_join(fixed, "")


def json_object_text(c: Column) -> Column:
    """The outermost object in a response, without code fences, line ends repaired."""
    raw = strip(F.regexp_replace(c, r"(?i)```(?:json)?|```", ""))
    inner = none_if_empty(F.regexp_extract(raw, r"(?s)(\{.*\})", 1))
    return newlines_in_strings(F.coalesce(inner, raw))


def _is_object(c: Column) -> Column:
    return F.coalesce(strip(c).startswith("{"), F.lit(False))


def scenarios(c: Column) -> Column:
    """``array<struct<id, description>>`` of a repaired object, in order of scenario index;
    null where it has no list of scenarios."""
    top = F.from_json(c, OBJECT)
    entries = F.filter(F.from_json(F.element_at(top, "scenarios"), "array<string>"), _is_object)  # loose strings have no id
    is_list = strip(F.element_at(top, "scenarios")).startswith("[")
    named = F.filter(F.map_entries(top), lambda e: F.lower(strip(e["key"])).startswith("scenario"))
    loose = F.transform(named, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))

    def pick(raw: Column) -> Column:
        e = F.map_entries(F.from_json(raw, OBJECT))
        own = F.filter(e, lambda x: F.lower(strip(x["key"])).startswith("scenario"))
        return F.when(F.size(e) == 1, F.element_at(e, 1)).when(F.size(own) > 0, F.element_at(own, 1))

    listed = F.filter(F.transform(entries, pick), lambda x: x.isNotNull())
    chosen = F.when(F.coalesce(is_list, F.lit(False)), listed).when(F.size(loose) > 0, loose)

    def settle(e: Column) -> Column:
        sid, value = canonical_scenario_id(e["key"]), e["value"]
        outer = F.from_json(value, OBJECT)
        again = F.coalesce(F.element_at(outer, sid), F.element_at(outer, e["key"]))
        inner = F.when(_is_object(again), F.from_json(again, OBJECT)).otherwise(outer)
        text = F.when(_is_object(value), F.element_at(inner, "description")).otherwise(value)
        return F.struct(sid.alias("id"), none_if_empty(strip(text)).alias("description"))

    kept = F.filter(F.transform(chosen, settle), lambda x: x["description"].isNotNull())

    def rank(x: Column) -> Column:
        n = scenario_index(x["id"])
        return F.when(n.isNull(), F.lit(2 * 10**9)).when(n == 0, F.lit(10**9)).otherwise(n)

    return F.transform(F.array_sort(F.transform(kept, lambda x, i: F.struct(rank(x).alias("r"), i.alias("i"), x.alias("x")))), lambda y: y["x"])


def scenarios_error(found: Column, want: int) -> Column:
    """What is wrong with normalised scenarios; null if nothing is."""
    ids = F.transform(found, lambda x: x["id"])
    doubled = F.element_at(F.filter(ids, lambda i: F.size(F.filter(ids, lambda j: i == j)) > 1), 1)
    return (
        F.when(found.isNull(), F.lit("missing list of scenarios"))
        .when(F.size(found) < want, F.concat(F.lit(f"need at least {want} scenarios, got "), F.size(found).cast("string")))
        .when(F.size(F.array_distinct(ids)) < F.size(ids), F.concat(F.lit("duplicate scenario id: "), doubled))
    )


def progress_item(topic: Column, scenario: Column, description: Column, base: Column | None = None) -> dict[str, Column]:
    """Old and new progress records in one form: ``scenario_id`` under the topic's label, ``base_scenario_id`` without it.

    The label is what full-width parentheses of the topic enclose, else the topic itself.  Records whose
    scenario has no index stay as they are; a ``base`` that they have already is kept.
    """
    raw = strip(scenario)
    index = F.coalesce(scenario_index_in_name(raw), scenario_index_in_name(canonical_scenario_id(raw)))
    own = F.concat(F.lit("scenario"), index.cast("string"))
    none = F.lit(None).cast("string") if base is None else none_if_empty(base)
    return {
        "topic": topic_label(topic),
        "base_scenario_id": F.coalesce(none, own),
        "scenario_id": F.when(index.isNull(), scenario).otherwise(F.concat_ws("_", topic_label(topic), own)),
        "description": F.when(index.isNull(), description).otherwise(F.coalesce(strip(description), F.lit(""))),
    }
