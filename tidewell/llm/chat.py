"""Op 7. Chat formatting with tool-call linking, by DataFrame functions alone.

Events (messages, tool calls, tool results) come from ``parse`` or ``by_turns``. Calls and results are joined by
(conversation, identifier); of calls or results that share one, the first counts and the others are ``duplicate``. A
call depends on the results of the calls that string values of its arguments name as ``"$id"``; a result depends on its
call. Events are ordered so that each follows what it depends on and otherwise keeps its turn: an event is due at its
turn or, if later, when the last thing it depends on is due, and ties go by depth. Depths come from rounds in which each
open reference either ends at a call with none open, or skips to what a call with a single one refers to, so a chain of
n calls takes log n rounds and no call ever has more references than it names; where calls refer to several others that
do so too, one level of those closes in each round. What can't be closed depends on itself and is marked ``cycle``.

Arguments are parsed once. References are the string values of what was parsed, however they were written. Checks against
schemas go by value: 1.0 is an integer, and so is one beyond 64 bits. Every event is serialised as canonical JSON (keys
sorted, numbers and spacing normalised); arguments that can't be parsed, or repeat a key, stay as text under ``raw``.

A conversation is never one row or one task's window: events are range-sorted by conversation and order, and a position
is the number of its conversation's events in earlier partitions plus its rank in its own.

Rows: a null text is a null content; null conv_id is a conversation of its own; null turn comes first; a call or result
without an identifier is ``unanswered`` or ``orphan``; arguments that aren't a JSON object are invalid. Repeated rows
stay, as duplicates if they have an identifier. A very long text is one row's value and travels once. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm._common import discard, written

#: Parameters of a tool: (type, required). Types: string, integer, number, boolean, array, object.
Schemas = dict[str, dict[str, tuple[str, bool]]]

_TYPES = {
    "string": "STRING", "integer": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)", "number": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)", "boolean": "BOOLEAN",
    "array": "ARRAY.*", "object": "OBJECT.*",
}
#: A string value that begins with a dollar sign and is no key, in canonical JSON without escaped quotes and backslashes.
_REFERENCE = r'"\$[^"]++"(?!:)'
_BACKSLASH, _QUOTE = "\u0001", "\u0002"  # what stands for those two meanwhile: JSON text has no such characters
_DEEP = 1 << 40
_EVENT = ["conv_id", "turn", "part", "role", "kind", "id", "name", "arguments", "content"]


def parse(messages: DataFrame) -> DataFrame:
    """Events of messages (conv_id, turn, role, text). An assistant's text may be a JSON object with ``tool_calls``
    [{id, name, arguments}], a tool's one with ``tool_call_id`` and ``content``; all else is a message."""
    shape = "struct<tool_calls:array<struct<id:string,name:string,arguments:string>>,tool_call_id:string,content:string>"
    m = messages.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text",
        F.when(F.col("role").isin("assistant", "tool"), F.from_json("text", shape)).alias("j"),
    )
    none = F.lit(None).cast("string")
    called = F.transform(
        "j.tool_calls",
        lambda c, i: F.struct(
            i.alias("part"), F.lit("call").alias("kind"), c["id"].alias("id"), c["name"].alias("name"),
            c["arguments"].alias("arguments"), none.alias("content"),
        ),
    )
    one = lambda kind, id_, content: F.array(F.struct(F.lit(0).alias("part"), F.lit(kind).alias("kind"), id_.alias("id"), none.alias("name"), none.alias("arguments"), content.alias("content")))
    is_call = (F.col("role") == "assistant") & (F.size(F.coalesce("j.tool_calls", F.array())) > 0)
    is_result = (F.col("role") == "tool") & F.col("j.tool_call_id").isNotNull()
    events = F.when(is_call, called).when(
        is_result, one("result", F.col("j.tool_call_id"), F.col("j.content")),
    ).otherwise(one("message", none, F.col("text")))
    return m.select("conv_id", "turn", "role", F.explode(events).alias("e")).select(
        "conv_id", "turn", F.col("e.part").cast("long").alias("part"), "role", "e.kind", "e.id", "e.name",
        "e.arguments", "e.content",
    )


def by_turns(messages: DataFrame) -> DataFrame:
    """Events of plain conversations: a user's turn calls the tool ``reply``, the assistant's next turn is its result."""
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    at = lambda t: F.concat_ws(":", F.col("conv_id").cast("string"), t.cast("string"))
    id_ = F.when(user & F.col("turn").isNotNull(), at(F.col("turn"))).when(assistant & F.col("turn").isNotNull(), at(F.col("turn") - 1))
    return messages.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.lit(0).cast("long").alias("part"), "role",
        F.when(user, "call").when(assistant, "result").otherwise("message").alias("kind"), id_.alias("id"), F.when(user, "reply").alias("name"),
        F.when(user, F.to_json(F.struct("text", "turn"))).alias("arguments"), F.when(
            ~F.coalesce(user, F.lit(False)), F.col("text"),
        ).alias("content"),
    )


def _whole(value: Column) -> Column:
    """Whether a number has no fraction: decimals by their digits, doubles by their value."""
    double = F.try_variant_get(value, "$", "double")
    return F.when(F.schema_of_variant(value).rlike("^(DOUBLE|FLOAT)$"), F.rint(double) == double).otherwise(F.to_json(value).rlike(r"^-?[0-9]+(\.0*)?$"))


def _named(arguments: Column) -> Column:
    """The distinct identifiers that string values of the arguments name as ``"$id"``."""
    flat = F.replace(F.replace(F.to_json(F.try_parse_json(arguments)), F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    found = F.regexp_extract_all(flat, F.lit(_REFERENCE), F.lit(0))
    whole = lambda t: F.replace(F.replace(t, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    return F.array_distinct(F.transform(found, lambda t: F.substring(F.try_variant_get(F.try_parse_json(whole(t)), "$", "string"), 2, (1 << 31) - 1)))


def problems(schemas: Schemas) -> Column:
    """What is wrong with a call's ``arguments`` by its tool's schema, as sorted strings; null for other events."""
    given = F.from_json("arguments", "map<string,variant>")
    no = F.array().cast("array<string>")
    checks = F.array(F.lit("unknown tool"))
    for name, parameters in schemas.items():
        found = F.transform(
            F.array_except(F.map_keys(given), F.array(*map(F.lit, parameters))),
            lambda k: F.concat(F.lit("unknown parameter "), k),
        )
        for p, (kind, required) in sorted(parameters.items()):
            value = F.element_at(given, p)
            right = F.schema_of_variant(value).rlike(f"^{_TYPES[kind]}$")
            if kind == "integer":
                right = right & _whole(value)
            wrong = F.when(
                value.isNull(), F.array(F.lit(f"missing {p}")) if required else no,
            ).when(~right, F.array(F.lit(f"{p} is not {kind}"))).otherwise(no)
            found = F.concat(found, wrong)
        checks = F.when(F.col("name") == name, F.array_sort(found)).otherwise(checks)
    return F.when(
        F.col("kind") == "call",
        F.when(
            F.try_parse_json("arguments").isNull() | ~F.schema_of_variant(F.try_parse_json("arguments")).startswith("OBJECT"),
            F.array(F.lit("arguments are no object")),
        ).otherwise(checks),
    )


def _links(events: DataFrame) -> DataFrame:
    """conv_id, id, and the first call and first result with that identifier (structs, null if there is none)."""
    first = lambda kind: events.filter((F.col("kind") == kind) & F.col("id").isNotNull()).groupBy("conv_id", "id").agg(F.min(F.struct("turn", "part", "tie")).alias(kind))
    calls, results = first("call").alias("c"), first("result").alias("r")
    joined = calls.join(
        results.hint("shuffle_hash"),
        F.col("c.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("c.id") == F.col("r.id")), "full",
    )
    return joined.select(
        F.when(F.col("c.id").isNotNull(), F.col("c.conv_id")).otherwise(F.col("r.conv_id")).alias("conv_id"),
        F.coalesce("c.id", "r.id").alias("id"), "call", "result",
    )


def _references(events: DataFrame, links: DataFrame) -> DataFrame:
    """conv_id, id and refs [{on, due, depth}] of the calls that name other calls of their conversation."""
    named = events.filter("kind = 'call' and id is not null").select(
        "conv_id", "id", "turn", F.struct("turn", "part", "tie").alias("own"), F.explode(_named(F.col("arguments"))).alias("on"),
    )
    calls = links.filter("call is not null").select(
        F.col("conv_id").alias("c"), F.col("id").alias("i"), "call",
        F.coalesce("result.turn", "call.turn").alias("turn_of"),
    )
    first = named.join(
        calls.select("c", "i", "call"),
        F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")) & F.col("own").eqNullSafe(F.col("call")),
    ).select("conv_id", "id", "turn", "on")
    found = first.join(calls.select("c", "i", "turn_of"), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("on") == F.col("i")))
    return found.groupBy("conv_id", "id").agg(
        F.collect_set(F.struct("on", F.greatest("turn", "turn_of").alias("due"), F.lit(2).cast("long").alias("depth"))).alias("refs")
    )


def _due(events: DataFrame, links: DataFrame) -> DataFrame:
    """conv_id, id, due and depth of the calls that depend on others; due is null and depth -1 on a cycle or behind one."""
    state = written(
        _references(events, links).select(
            "conv_id", "id", F.lit(None).cast("long").alias("due"), F.lit(0).cast("long").alias("depth"), "refs",
        ),
        "state",
    )
    closed = -1
    while True:
        now, total = state.agg(F.count_if(F.size("refs") == 0), F.count(F.lit(1))).first()
        if now <= closed or now == total:
            break
        closed, before = now, state
        target = state.select(
            F.col("conv_id").alias("c"), F.col("id").alias("i"), F.col("due").alias("t_due"),
            F.col("depth").alias("t_depth"), F.col("refs").alias("t_refs"),
        )
        opened = state.filter("size(refs) > 0").select("conv_id", "id", "due", "depth", F.explode("refs").alias("r"))
        joined = opened.join(target, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("r.on") == F.col("i")), "left")
        n = F.when(F.col("t_refs").isNull(), 0).otherwise(F.size("t_refs"))
        step = lambda d: F.least(F.col("r.depth") + F.coalesce(d, F.lit(0)), F.lit(_DEEP))  # noqa: E731  a cycle's depth would double for ever
        only = F.get("t_refs", F.lit(0))
        jump = F.struct(only["on"].alias("on"), F.greatest("r.due", "t_due", only["due"]).alias("due"), step(only["depth"]).alias("depth"))
        passed = n <= 1
        state = written(
            joined.groupBy("conv_id", "id").agg(
                F.max(
                    F.greatest("due", F.when(passed, F.greatest("r.due", "t_due")))
                ).alias("due"), F.max(F.greatest("depth", F.when(passed, step(F.col("t_depth"))))).alias("depth"),
                F.collect_set(F.when(n == 1, jump).when(n > 1, F.col("r"))).alias("refs"),
            ).unionByName(state.filter("size(refs) = 0")), "state",
        )
        discard(before)
    over = F.size("refs") == 0
    return state.select("conv_id", "id", F.when(over, F.col("due")).alias("due"), F.when(over, F.col("depth")).otherwise(-1).alias("depth"))


def format_events(events: DataFrame, schemas: Schemas) -> DataFrame:
    """conv_id, position (from 0), turn, part, role, kind, id, status, depth, problems and json of every event."""
    events = written(events.select(*_EVENT, F.xxhash64(*_EVENT[3:]).alias("tie")), "events")
    links = written(_links(events), "links")
    late = _due(events, links)
    key = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id")) & (F.col(f"{a}.id") == F.col(f"{b}.id"))
    calls = links.alias("l").join(late.alias("d"), key("l", "d"), "left").select(
        "l.*", "d.due", F.coalesce("d.depth", F.lit(0)).alias("call_depth"),
    )
    x = events.alias("e").join(calls.alias("c"), key("e", "c"), "left")
    own = F.struct("e.turn", "e.part", "e.tie")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    other = F.when(is_call, F.col("result")).otherwise(F.col("call"))
    mine = F.when(is_call, F.col("call")).otherwise(F.col("result"))
    status = (
        F.when(~(is_call | is_result), "message").when(F.col("e.id").isNotNull() & (own != mine), "duplicate")
        .when(
            is_call & (F.col("call_depth") < 0), "cycle",
        ).when(other.isNotNull(), "linked").when(is_call, "unanswered").otherwise("orphan")
    )
    linked = F.col("status") == "linked"
    depth = F.greatest(F.col("call_depth"), F.lit(0)) + F.when(is_result, 1).otherwise(0)
    due = F.when(is_result, F.greatest("e.turn", "call.turn", "due")).otherwise(F.greatest("e.turn", "due"))
    v = lambda s: F.try_parse_json(s)
    text = lambda **k: F.to_json(F.to_variant_object(F.struct(*(c.alias(n) for n, c in sorted(k.items())))))
    call = {"role": F.col("role"), "type": F.lit("call"), "id": F.col("e.id"), "name": F.col("name"), "arguments": v(F.col("arguments"))}
    unread = F.col("arguments").isNotNull() & call["arguments"].isNull()
    json = (
        F.when(is_call & unread, text(**call, raw=F.col("arguments"))).when(is_call, text(**call))
        .when(is_result, text(role=F.col("role"), type=F.lit("result"), id=F.col("e.id"), content=F.col("content")))
        .otherwise(text(role=F.col("role"), content=F.col("content")))
    )
    shown = x.withColumn("status", status).select(
        "e.conv_id", "e.turn", "e.part", "role", "kind", "e.id", "status", F.when(linked, depth).when(
            is_call & (F.col("status") == "unanswered"), F.greatest("call_depth", F.lit(0)),
        ).otherwise(0).alias("depth"),
        F.when(
            linked | (F.col("status") == "unanswered"), due,
        ).otherwise(F.col("e.turn")).alias("due"), problems(schemas).alias("problems"), json.alias("json"), "tie",
    )
    order = ["due", "depth", "turn", "part", "tie"]
    ranged = written(shown.repartitionByRange("conv_id", *order).withColumn("p", F.spark_partition_id()), "ranged")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = ranged.groupBy("conv_id", "p").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv_id").alias("c"), F.col("p").alias("q"), before.alias("before"),
    )
    placed = ranged.join(counts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("p") == F.col("q")))
    rank = F.row_number().over(Window.partitionBy("conv_id", "p").orderBy(*order))
    return placed.select(
        "conv_id", (F.col("before") + rank - 1).cast("long").alias("position"), "turn", "part", "role", "kind", "id",
        "status", "depth", "problems", "json",
    )
