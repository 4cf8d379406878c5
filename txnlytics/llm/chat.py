"""Chat formatting: tool calls linked to results, ordered by dependency, validated, written as canonical JSON."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from txnlytics.session import materialise


@dataclass(frozen=True)
class Argument:
    """One argument of a tool: ``string``, ``integer``, ``number`` or ``boolean``."""

    kind: str
    required: bool = True


Schemas = Mapping[str, Mapping[str, Argument]]

# --- Fixed values: JSON spellings of the argument kinds --------------------------
KIND_PATTERNS = {
    "integer": r"^-?(0|[1-9][0-9]*)\z",
    "number": r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?\z",
    "boolean": r"^(true|false)\z",
}


def json_text(text: Column) -> Column:
    """A string as a JSON string; null as ``null``."""
    quoted = F.to_json(F.struct(text.alias("v")))
    return F.when(text.isNull(), "null").otherwise(quoted.substr(F.lit(6), F.length(quoted) - 6))


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted array of what is wrong with a call: unknown tool, missing, unknown or ill-typed arguments."""
    found = F.array(F.lit("unknown tool"))
    for tool, fields in sorted(schemas.items()):
        known = F.array(*[F.lit(f) for f in sorted(fields)]).cast("array<string>")
        extra = F.transform(
            F.array_except(F.coalesce(F.map_keys(arguments), F.array().cast("array<string>")), known),
            lambda k: F.concat(F.lit("unknown "), k),
        )
        checks = []
        for field, rule in sorted(fields.items()):
            value = arguments[field]
            if rule.required:
                checks.append(F.when(value.isNull(), F.lit(f"missing {field}")))
            if rule.kind in KIND_PATTERNS:
                checks.append(F.when(~value.rlike(KIND_PATTERNS[rule.kind]), F.lit(f"not {rule.kind}: {field}")))
        wrong = F.array_compact(F.array(*checks).cast("array<string>"))
        found = F.when(name == tool, F.array_sort(F.concat(wrong, extra))).otherwise(found)
    return found


def canonical_scalar(text: Column) -> Column:
    """One spelling for each JSON number or boolean: whole numbers as such, others as the shortest double, no minus zero.

    Whole numbers that are spelled as such keep all their digits; what a double can't hold keeps its spelling.
    """
    number = text.try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    short = F.regexp_replace(F.regexp_replace(number.cast("string"), r"\.0(?=E|\z)", ""), "E", "e")
    plain = text.rlike(KIND_PATTERNS["integer"]) | text.rlike(KIND_PATTERNS["boolean"]) | (F.abs(number) == float("inf"))
    return F.when(number == 0, "0").when(plain, text).when(whole, number.cast("bigint").cast("string")).otherwise(short)


def canonical_arguments(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """JSON object with sorted keys and no blanks; well-typed numbers and booleans are bare, the rest are strings."""
    pairs = F.array_sort(F.map_entries(F.coalesce(arguments, F.create_map().cast("map<string,string>"))))

    def bare(key: Column, value: Column) -> Column:
        yes = F.lit(False)
        for tool, fields in sorted(schemas.items()):
            for field, rule in sorted(fields.items()):
                if rule.kind in KIND_PATTERNS:
                    yes = yes | ((name == tool) & (key == field) & value.rlike(KIND_PATTERNS[rule.kind]))
        return yes

    members = F.transform(
        pairs,
        lambda x: F.concat(
            json_text(x["key"]),
            F.lit(":"),
            F.when(F.coalesce(bare(x["key"], x["value"]), F.lit(False)), canonical_scalar(x["value"])).otherwise(json_text(x["value"])),
        ),
    )
    return F.concat(F.lit("{"), F.concat_ws(",", members), F.lit("}"))


def dependency_depth(calls: DataFrame) -> DataFrame:
    """(call_id, after) rows -> (call_id, depth): calls that must come before; null where ``after`` runs in a circle.

    Pointer doubling: each round a call adds its pointer's depth and takes over its
    pointer, so a chain of n calls takes log2(n) joins on the identifier, each of which
    spreads evenly since identifiers are unique. An ``after`` that names no call is none.
    """
    ids = calls.select(F.col("call_id").alias("to")).hint("shuffle_hash")
    state = materialise(
        calls.join(ids, F.col("after") == F.col("to"), "left").select(
            "call_id", F.col("to").alias("next"), F.when(F.col("to").isNotNull(), 1).otherwise(0).cast("long").alias("depth")
        ),
        "depth",
    )
    total = state.count()
    reach = 1
    while reach <= total and not state.filter(F.col("next").isNotNull()).isEmpty():
        ahead = state.select(F.col("call_id").alias("id"), F.col("next").alias("next2"), F.col("depth").alias("depth2")).hint("shuffle_hash")
        joined = state.join(ahead, F.col("next") == F.col("id"), "left")
        state = materialise(
            joined.select(
                "call_id", F.col("next2").alias("next"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth")
            ),
            "depth",
        )
        reach *= 2
    return state.select("call_id", F.when(F.col("next").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """Tool calls with their results as canonical JSON.

    ``calls``: conv_id, call_id, after, name, arguments (map of JSON scalars as text);
    ``results``: call_id, content. Returns per call: conv_id, call_id, depth (its place in a
    topological order of the conversation: sort by depth, then call_id), n_results,
    ``errors``, ``valid`` and ``json``.

    Calls and results with a null identifier link with nothing and are left out. Of calls
    that repeat an identifier the one with the smallest (conv_id, name, after, arguments as JSON) stays. Results
    are counted and the smallest content is linked; a call without one has ``null``. A null
    name or arguments are an unknown tool and an empty object. A call that waits for itself
    in a circle has a null depth and is not valid. Empty tables give an empty table; other
    columns are not read. Everything is keyed by call identifiers and pre-aggregated, so no
    conversation is ever collected.
    """
    entries = F.to_json(F.array_sort(F.map_entries("arguments")))
    first = F.min_by(F.struct("conv_id", "name", "after", "arguments"), F.struct(F.col("conv_id").isNull(), "conv_id", F.coalesce("name", F.lit("")), F.coalesce("after", F.lit("")), F.coalesce(entries, F.lit(""))))
    unique = materialise(
        calls.filter(F.col("call_id").isNotNull()).groupBy("call_id").agg(first.alias("c")).select("call_id", "c.*"), "calls"
    )
    answered = (
        results.filter(F.col("call_id").isNotNull())
        .groupBy("call_id")
        .agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    )
    depth = dependency_depth(unique.select("call_id", "after"))
    # Hash joins by identifier; the hashed side has one row per identifier.
    joined = unique.join(answered.hint("shuffle_hash"), "call_id", "left").join(depth.hint("shuffle_hash"), "call_id")
    errors = argument_errors(F.col("name"), F.col("arguments"), schemas)
    body = F.concat(
        F.lit('{"arguments":'), canonical_arguments(F.col("name"), F.col("arguments"), schemas),
        F.lit(',"id":'), json_text(F.col("call_id")),
        F.lit(',"name":'), json_text(F.col("name")),
        F.lit(',"result":'), json_text(F.col("content")),
        F.lit("}"),
    )
    return joined.select(
        "conv_id",
        "call_id",
        "depth",
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        errors.alias("errors"),
        ((F.size(errors) == 0) & F.col("depth").isNotNull()).alias("valid"),
        body.alias("json"),
    )
