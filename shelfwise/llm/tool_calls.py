"""Tool calls and their results as linked, ordered, validated canonical JSON.

Calls and results are hash-joined by identifier, so neither a conversation nor a tool needs a group
of its own. Calls may depend on others of their conversation; each gets a level above those of all
it depends on, and rows ordered by level and sequence are in topological order. Calls are numbered
in the order of conversation and sequence and cut into parts of at most ``PART``. One pass over a part
settles all calls whose needs lie in it; those that wait for a call of another part are joined
with what is settled and go into the parts of the next round. So rounds follow the borders that
chains cross, not their length. Each round is a folder of one written table.

Arguments are checked against the tool's schema (``type``, ``enum``, ``minimum``, ``maximum``,
``minLength``, ``maxLength``, ``pattern``, ``items``, ``minItems``, ``maxItems``, ``required`` and ``properties``,
which allow no others, at every depth; a rule without ``type`` allows any), and every call becomes one
line of canonical JSON: sorted keys, no blanks, nothing escaped that need not be, whole numbers
without a fraction.

Cases: calls without a conversation or an identifier are left out, as are results without an
identifier or for no call; of calls that share both, the first by sequence and content counts, of
results for one call the first by content; a call without a result has ``null``; dependencies on
unknown calls are left out; calls on a cycle, or behind one, have a null level; arguments that are
null, no JSON (``NaN`` and infinities, also as ``1e999``, are none), or no object are an error of the
call, as are a key that an object has twice, values nested deeper than ``DEPTH`` and a tool without a
schema, and such arguments are written as ``null``; ``1.0`` is an integer; half of a surrogate pair stays
an escape; an empty table gives an empty result; other columns play no part.
"""

import json
import math
import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.batches import small
from shelfwise.operators.encode import with_positions
from shelfwise.session import materialize, scratch_path

PART = 50_000
DEPTH = 64

KINDS = {
    "string": lambda x: isinstance(x, str),
    "integer": lambda x: isinstance(x, int) and not isinstance(x, bool),
    "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool),
    "boolean": lambda x: isinstance(x, bool),
    "array": lambda x: isinstance(x, list),
    "object": lambda x: isinstance(x, dict),
}


class Refused(ValueError):
    """What is wrong with a text as arguments."""


def _number(text):
    value = float(text)
    if not math.isfinite(value):
        raise Refused("no object")
    return int(value) if value.is_integer() and abs(value) < 2 ** 53 else value


def _no_constant(text):
    raise Refused("no object")


def _object(pairs):
    found = dict(pairs)
    if len(found) < len(pairs):
        raise Refused("repeated key")
    return found


def parsed(text) -> dict:
    """The object that a text holds."""
    try:
        value = json.loads(text, parse_float=_number, parse_constant=_no_constant,
                           object_pairs_hook=_object)
    except RecursionError:
        raise Refused("too deep") from None
    except Refused:
        raise
    except (TypeError, ValueError):
        raise Refused("no object") from None
    if not isinstance(value, dict):
        raise Refused("no object")
    layer = [value]
    for _ in range(DEPTH):
        layer = [x for held in layer for x in (held.values() if isinstance(held, dict) else held)
                 if isinstance(x, (dict, list))]
        if not layer:
            return value
    raise Refused("too deep")


def violations(arguments, schema) -> list[str]:
    """What is wrong with the arguments of one call, sorted."""
    if schema is None:
        return ["unknown tool"]
    return sorted(_members(arguments, schema, ""))


def _members(value, rule, path) -> Iterator[str]:
    rules = rule.get("properties", {})
    for name in rule.get("required", ()):
        if name not in value:
            yield f"{path}{name}: missing"
    for name, member in value.items():
        if name not in rules:
            yield f"{path}{name}: unexpected"
        else:
            yield from _wrong(member, rules[name], f"{path}{name}")


def _wrong(value, rule, path) -> Iterator[str]:
    kind = rule.get("type")
    if kind is not None and not KINDS[kind](value):
        yield f"{path}: not {kind}"
        return
    if "enum" in rule and canonical(value) not in map(canonical, rule["enum"]):
        yield f"{path}: not allowed"
        return
    if KINDS["number"](value):
        if value < rule.get("minimum", value):
            yield f"{path}: below minimum"
        if value > rule.get("maximum", value):
            yield f"{path}: above maximum"
    elif isinstance(value, str):
        if not rule.get("minLength", 0) <= len(value) <= rule.get("maxLength", len(value)):
            yield f"{path}: wrong length"
        if "pattern" in rule and not re.search(rule["pattern"], value):
            yield f"{path}: no match"
    elif isinstance(value, list):
        if not rule.get("minItems", 0) <= len(value) <= rule.get("maxItems", len(value)):
            yield f"{path}: wrong length"
        for i, item in enumerate(value if "items" in rule else ()):
            yield from _wrong(item, rule["items"], f"{path}[{i}]")
    elif isinstance(value, dict) and ("properties" in rule or "required" in rule):
        yield from _members(value, rule, f"{path}.")


def canonical(value) -> str:
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return re.sub("[\ud800-\udfff]", lambda half: f"\\u{ord(half[0]):04x}", text)


def serialised(batches: Iterator[pa.RecordBatch], schemas) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        valid, lines = [], []
        for row in batch.to_pylist():
            schema = schemas.get(row["tool"])
            try:
                arguments = parsed(row["arguments"])
                errors = violations(arguments, schema)
            except Refused as refused:
                arguments, errors = None, [f"arguments: {refused}"]
                errors = errors if schema is not None else ["unknown tool"]
            valid.append(not errors)
            lines.append(canonical({
                "arguments": arguments, "call_id": row["call_id"], "conv_id": row["conv_id"],
                "depends_on": sorted(row["depends_on"] or ()), "errors": errors,
                "level": row["level"], "result": row["result"], "tool": row["tool"]}))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in ("conv_id", "call_id", "seq", "level")),
             pa.array(valid), pa.array(lines, pa.string())], names=_NAMES)


_NAMES = ["conv_id", "call_id", "seq", "level", "valid", "json"]
CALL = ["conv_id", "call_id"]


def settled(group: pa.Table) -> pa.Table:
    """Of the calls of a part: the level of those whose needs are all met or met within the part;
    of the others what they still need and the level they have at least."""
    rows = group.select([*CALL, "seq", "base", "needs"]).to_pylist()
    place = {(row["conv_id"], row["call_id"]): i for i, row in enumerate(rows)}
    level = [row["base"] for row in rows]
    lacks, waiting_for = [0] * len(rows), [[] for _ in rows]
    for i, row in enumerate(rows):
        for needed in row["needs"]:
            lacks[i] += 1
            at = place.get((row["conv_id"], needed))
            if at is not None:
                waiting_for[at].append(i)
    ready = [i for i, n in enumerate(lacks) if not n]
    for i in ready:  # grows as calls become ready
        for j in waiting_for[i]:
            level[j] = max(level[j], level[i] + 1)
            lacks[j] -= 1
            if not lacks[j]:
                ready.append(j)
    done = set(ready)
    for i, row in enumerate(rows):
        row["level"] = level[i] if i in done else None
        row["base"] = level[i]
        row["needs"] = [] if i in done else [
            needed for needed in row["needs"] if place.get((row["conv_id"], needed)) not in done]
    names = [*group.select([*CALL, "seq", "base", "needs"]).schema]
    return pa.Table.from_pylist(rows, pa.schema([*names, pa.field("level", pa.int32())]))


def levels(calls: DataFrame, needs: DataFrame, part: int = PART) -> DataFrame:
    """Calls with their level: 0 without dependencies, else one above the highest of them."""
    spark, root = calls.sparkSession, scratch_path(calls.sparkSession, "levels")
    lists = needs.groupBy(*CALL).agg(F.collect_list("needed").alias("needs"))
    none = F.array().cast(lists.schema["needs"].dataType)
    waiting = calls.select(*CALL, "seq").join(lists, CALL, "left").select(
        *CALL, "seq", F.lit(0).alias("base"), F.coalesce("needs", none).alias("needs"))
    number = 0
    while True:
        parts = with_positions(waiting, "position", *CALL[:1], "seq", *CALL[1:]).withColumn(
            "part", F.floor(F.col("position") / part)).drop("position")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in waiting.schema.fields)
        found = materialize(parts.groupBy("part").applyInArrow(settled, f"{kinds}, level int"),
                            "levels", f"{root}/round={number}")
        met = found.where("level IS NOT NULL").select(
            "conv_id", F.col("call_id").alias("needed"), "level")
        left = found.where("level IS NULL")
        if met.isEmpty() or left.isEmpty():
            break
        number += 1
        open_needs = left.select(*CALL, "seq", "base", F.explode("needs").alias("needed")).join(
            met, ["conv_id", "needed"], "left")
        waiting = open_needs.groupBy(*CALL, "seq").agg(
            F.max(F.greatest("base", F.col("level") + 1)).cast("int").alias("base"),
            F.collect_list(F.when(F.col("level").isNull(), F.col("needed"))).alias("needs"))
    schema = found.select(*CALL, "level").schema
    return spark.read.schema(schema).parquet(root).where("level IS NOT NULL")


def linked(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """``calls`` (conv_id, call_id, seq, tool, arguments, depends_on) with ``results`` (call_id,
    result) and tools' ``schemas`` as one row a call: identifiers, ``level``, ``valid``, ``json``.
    """
    known = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*CALL).agg(
        F.min(F.struct("seq", "tool", "arguments", "depends_on")).alias("call")).select(
        *CALL, "call.*")
    known = materialize(known, "calls")
    needs = known.select(*CALL, F.explode(F.array_distinct("depends_on")).alias("needed"))
    needs = needs.join(known.select("conv_id", F.col("call_id").alias("needed")),
                       ["conv_id", "needed"], "left_semi")
    needs = materialize(needs, "needs")
    depends = needs.groupBy(*CALL).agg(F.collect_list("needed").alias("depends_on"))
    answers = results.where("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min("result").alias("result")).hint("shuffle_hash")
    rows = known.drop("depends_on").join(answers, "call_id", "left").join(
        depends, CALL, "left").join(levels(known, needs), CALL, "left").select(
        *CALL, "seq", "tool", "arguments", "result", "depends_on", "level")
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{name} {types[name]}" for name in _NAMES[:4])
    return rows.mapInArrow(partial(serialised, schemas=schemas),
                           f"{schema}, valid boolean, json string")
