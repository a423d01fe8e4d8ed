"""Linking tool calls to their results in conversations.

Messages hold JSON: a call ``{"tool_call": {"id", "name", "arguments", "after"}}`` or a
result ``{"tool_result": {"id", "content"}}``. Calls and results are first brought to one
row per conversation and identifier, then joined on both. ``after`` names the call whose
result a call uses, or lists several; the longest path through them is the call's step.
Chains are found by pointer doubling, calls with several dependencies level by level, so
sorting by conversation, step and turn gives a topological order without bringing a
conversation together in one task. Arguments are validated against the tool's schema, and
each link is written as canonical JSON: keys sorted, no blanks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import staged

#: Types a schema may name, as the variant type reports them.
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\))$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<",
    "object": "^OBJECT<",
}
#: What is read of a message that is JSON but has no value as a variant, as it repeats a key.
SPOILT = "tool_call struct<id:string,name:string>, tool_result struct<id:string,content:string>"
#: Schemas become an expression evaluated per call.
MOST_TOOLS = 500

Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]

#: The tools of the registered query: parameter to (type, required).
TOOLS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True), "exact": ("boolean", False)},
    "summarise": {"text": ("string", True), "max_words": ("integer", True)},
    "translate": {"text": ("string", True), "to": ("string", True)},
}


def arguments_problem(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, the first problem by name; NULL where nothing is.

    Checked in this order: ``unknown tool``, ``no arguments`` (none, or not an object),
    ``unknown <parameter>``, ``missing <parameter>``, ``type <parameter>``. A JSON null counts as missing.
    """
    if len(schemas) > MOST_TOOLS:
        raise ValueError(f"more than {MOST_TOOLS} tools")
    problem = F.lit("unknown tool")
    keys = F.map_keys(F.try_variant_get(arguments, "$", "map<string,variant>"))
    for tool, parameters in schemas.items():
        found: list[Column] = [F.when(keys.isNull(), F.lit("no arguments"))]
        allowed = F.array(*[F.lit(p) for p in parameters]).cast("array<string>")
        odd = F.array_min(F.array_except(keys, allowed))
        found.append(F.when(odd.isNotNull(), F.concat(F.lit("unknown "), odd)))
        kinds = {p: F.schema_of_variant(F.try_variant_get(arguments, f"$['{p}']", "variant")) for p in parameters}
        there = {p: F.coalesce(kinds[p], F.lit("VOID")) != "VOID" for p in parameters}
        for p in sorted(p for p, (_, needed) in parameters.items() if needed):
            found.append(F.when(~there[p], F.lit(f"missing {p}")))
        for p in sorted(parameters):
            found.append(F.when(there[p] & ~kinds[p].rlike(TYPES[parameters[p][0]]), F.lit(f"type {p}")))
        problem = F.when(name == tool, F.coalesce(*found)).otherwise(problem)
    return problem


def _same(left: str, right: str) -> Column:
    return F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col(left) == F.col(right))


def steps(calls: DataFrame) -> DataFrame:
    """``conv_id, id, step, broken`` for calls ``conv_id, id, needs`` with unique identifiers.

    ``step`` counts the calls on the longest path before. ``broken`` is ``cycle`` where a
    path never ends, else ``missing`` where one ends at a call that does not exist; ``step``
    is NULL for a cycle. Each round doubles the distance looked back, up to a call with no or
    several dependencies, so these rounds are the logarithm of the longest chain. Calls with
    several are then settled once all they depend on are, one level of them a round.
    """
    named = calls.select(F.col("conv_id").alias("_c"), F.col("id").alias("_i"))
    wanted = calls.select("conv_id", "id", F.explode_outer(F.array_distinct("needs")).alias("need"))
    edges = staged(
        wanted.join(named, _same("need", "_i"), "left").select(
            "conv_id", "id", F.col("_i").alias("up"), (F.col("need").isNotNull() & F.col("_i").isNull()).alias("missing")
        ),
        "edges",
    )
    state = edges.groupBy("conv_id", "id").agg(
        F.count("up").alias("n_up"), F.max("up").alias("up"), F.max("missing").alias("missing")
    )
    one = F.col("n_up") == 1
    state = staged(
        state.select(
            "conv_id", "id", F.when(one, F.col("up")).alias("up"), F.when(one, F.col("up")).otherwise(F.col("id")).alias("base"),
            one.cast("bigint").alias("step"), "missing", (F.col("n_up") > 1).alias("joins"),
        ),
        "steps",
    )
    total, reach = state.count(), 1
    while reach <= 2 * total and state.where("up IS NOT NULL").limit(1).count():
        above = state.select(
            F.col("conv_id").alias("_c"), F.col("id").alias("_i"), F.col("up").alias("_up"), F.col("base").alias("_base"),
            F.col("step").alias("_step"), F.col("missing").alias("_missing"),
        )
        state = staged(
            state.join(above, _same("up", "_i"), "left").select(
                "conv_id", "id", F.col("_up").alias("up"), F.coalesce("_base", "base").alias("base"),
                (F.col("step") + F.coalesce("_step", F.lit(0))).alias("step"),
                (F.col("missing") | F.coalesce("_missing", F.lit(False))).alias("missing"), "joins",
            ),
            "steps",
        )
        reach *= 2
    cycle = F.col("up").isNotNull()
    if not state.where("joins").limit(1).count():
        return state.select(
            "conv_id", "id", F.when(~cycle, F.col("step")).alias("step"),
            F.when(cycle, "cycle").when(F.col("missing"), "missing").alias("broken"),
        )
    # What each call with several dependencies needs: the ends of their chains, that are settled or such calls themselves.
    bases = state.select(F.col("conv_id").alias("_c"), F.col("id").alias("_i"), "base", "step", F.col("missing").alias("gap"), cycle.alias("loop"))
    joins = state.where("joins").select(F.col("conv_id").alias("_jc"), F.col("id").alias("_ji"))
    inner = edges.join(joins, F.col("conv_id").eqNullSafe(F.col("_jc")) & (F.col("id") == F.col("_ji")), "left_semi")
    paths = staged(
        inner.where("up IS NOT NULL").join(bases, _same("up", "_i")).select(
            "conv_id", "id", "base", (F.col("step") + 1).alias("step"), (F.col("missing") | F.col("gap")).alias("gap"), "loop"
        ),
        "paths",
    )
    own = state.where("joins").select("conv_id", "id", F.col("missing").alias("own"))
    ends = state.where("up IS NULL AND NOT joins").select(
        F.col("conv_id").alias("_c"), F.col("id").alias("_b"), F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("lacks")
    )
    settled, known = staged(ends, "settled"), -1
    while known < (now := settled.count()):
        known = now
        ready = paths.join(settled, _same("base", "_b"), "left").groupBy("conv_id", "id").agg(
            F.max(F.col("at") + F.col("step")).alias("at"), F.max(F.col("gap") | F.coalesce("lacks", F.lit(False))).alias("lacks"),
            F.bool_and(F.col("at").isNotNull() & ~F.col("loop")).alias("done"),
        ).where("done")
        mine = own.select(F.col("conv_id").alias("_c"), F.col("id").alias("_i"), "own")
        level = ready.join(mine, _same("id", "_i")).select(
            F.col("conv_id").alias("_c"), F.col("id").alias("_b"), "at", (F.col("lacks") | F.col("own")).alias("lacks")
        )
        settled = staged(ends.unionByName(level), "settled")
    found = state.join(settled, _same("base", "_b"), "left")
    lost = cycle | F.col("at").isNull()
    return found.select(
        "conv_id", "id", F.when(~lost, F.col("step") + F.col("at")).alias("step"),
        F.when(lost, "cycle").when(F.col("missing") | F.col("lacks"), "missing").alias("broken"),
    )


def link_tool_calls(
    messages: DataFrame, schemas: Schemas = TOOLS, conv: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """One row per identifier of a conversation: ``conv_id, id, turn, name, step, status, n_calls, n_results, record``.

    Of calls that share conversation and identifier the first by turn counts, of results
    likewise; equal turns are settled by the text. ``status`` is the first that holds of
    ``no call``, ``repeated call``, ``cycle``, ``missing dependency``, ``repeated key`` (the
    call's JSON repeats one, so its arguments and dependencies are not read), a problem of the
    arguments, ``no result``, ``early result`` (at or before its call's turn), ``ok``. Messages
    that are NULL, empty, no JSON object or without an identifier link to nothing and give no
    row. A NULL conversation is one of its own; a NULL turn comes before any other. An empty
    table gives an empty result, columns other than the three are ignored. ``record`` is the link as canonical JSON, and
    NULL without a call.
    """
    value = F.try_parse_json(F.col(text).cast("string"))

    def get(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("value", path, kind)

    read = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(text).cast("string").alias("raw"), value.alias("value"))
    read = read.withColumn("spoilt", F.when(F.col("value").isNull(), F.from_json("raw", SPOILT)))
    said = staged(
        read.select(
            "conv_id", "turn", "raw", F.coalesce(
                get("$.tool_call.id"), get("$.tool_result.id"), "spoilt.tool_call.id", "spoilt.tool_result.id"
            ).alias("id"),
            F.coalesce(get("$.tool_call.id"), "spoilt.tool_call.id").isNotNull().alias("is_call"),
            F.coalesce(get("$.tool_call.name"), "spoilt.tool_call.name").alias("name"),
            F.col("value").isNull().alias("twice"),
            F.to_json(get("$.tool_call.arguments", "variant")).alias("arguments"),
            get("$.tool_call.after").alias("after"), get("$.tool_call.after", "array<string>").alias("several"), F.coalesce(get("$.tool_result.content"), "spoilt.tool_result.content").alias("content"),
        ).where("id IS NOT NULL"),
        "tool-messages",
    )
    first = F.struct("turn", "raw")
    calls = said.where("is_call").groupBy("conv_id", "id").agg(
        F.count("*").alias("n_calls"), F.min_by(F.struct("turn", "name", "arguments", "after", "several", "twice"), first).alias("call")
    ).select("conv_id", "id", "n_calls", "call.*")
    calls = staged(calls, "calls")
    results = said.where(~F.col("is_call")).groupBy(F.col("conv_id").alias("_conv"), F.col("id").alias("_id")).agg(
        F.count("*").alias("n_results"), F.min_by(F.struct("turn", "content"), first).alias("result")
    )
    needs = F.coalesce(F.array_compact("several"), F.array("after"))
    order = steps(calls.select("conv_id", "id", needs.alias("needs"))).select(F.col("conv_id").alias("_oc"), F.col("id").alias("_oi"), "step", "broken")
    placed = calls.join(order, F.col("conv_id").eqNullSafe(F.col("_oc")) & (F.col("id") == F.col("_oi")))
    both = placed.join(results, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("id") == F.col("_id")), "full")
    arguments = F.try_parse_json("arguments")
    status = F.coalesce(
        F.when(F.col("n_calls").isNull(), F.lit("no call")), F.when(F.col("n_calls") > 1, F.lit("repeated call")),
        F.when(F.col("broken") == "cycle", F.lit("cycle")), F.when(F.col("broken") == "missing", F.lit("missing dependency")),
        F.when(F.col("twice"), F.lit("repeated key")), arguments_problem(F.col("name"), arguments, schemas),
        F.when(F.col("n_results").isNull(), F.lit("no result")),
        F.when(F.col("result.turn") <= F.col("turn"), F.lit("early result")), F.lit("ok"),
    )
    record = F.to_json(F.struct(
        F.when(F.col("several").isNotNull(), F.try_parse_json("after")).otherwise(F.col("after").cast("variant")).alias("after"),
        arguments.alias("arguments"), F.col("id"), F.col("name"), F.col("result.content").alias("result"), F.col("step"),
    ))
    return both.select(
        F.coalesce("conv_id", "_conv").alias("conv_id"), F.coalesce("id", "_id").alias("id"), F.coalesce("turn", "result.turn").alias("turn"),
        "name", "step", status.alias("status"),
        F.coalesce("n_calls", F.lit(0)).cast("bigint").alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        F.when(F.col("n_calls").isNotNull(), record).alias("record"),
    )


def messages_from_turns(conversations: DataFrame) -> DataFrame:
    """Tool messages that follow from ordinary conversations, ``conv_id, turn, text``.

    A user's turn calls a tool, chosen with its arguments by the turn's length; an
    assistant's turn is the result of the call one turn before. Some calls lack an argument
    or have one of a wrong type, some use the result of the call two turns before. Turns of
    any other role, or none, are messages without an identifier. A turn without a number is
    identified by its text: no result can name such a call, no call such a result.
    """
    size = F.length("text")
    digest = F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 16)
    ident = F.coalesce(F.concat(F.lit("c"), F.col("turn").cast("string")), F.concat(F.lit("call "), digest))
    answered = F.coalesce(F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")), F.concat(F.lit("result "), digest))
    arguments = (
        F.when(size % 3 == 0, F.to_json(F.struct(F.col("text").alias("query"), size.alias("limit"))))
        .when((size % 3 == 1) & (size % 5 == 0), F.to_json(F.struct(F.col("text"), F.lit("many").alias("max_words"))))
        .when(size % 3 == 1, F.to_json(F.struct(F.col("text"), size.alias("max_words"))))
        .when(size % 7 == 0, F.to_json(F.struct(F.col("text"))))
        .otherwise(F.to_json(F.struct(F.col("text"), F.lit("de").alias("to"))))
    )
    name = F.get(F.array(F.lit("search"), F.lit("summarise"), F.lit("translate")), size % 3)
    after = F.when((size % 2 == 1) & (F.col("turn") >= 2), F.concat(F.lit("c"), (F.col("turn") - 2).cast("string")))
    call = F.to_json(F.struct(F.struct(
        ident.alias("id"), name.alias("name"), F.parse_json(arguments).alias("arguments"), after.alias("after")
    ).alias("tool_call")))
    result = F.to_json(F.struct(F.struct(
        answered.alias("id"), F.col("text").alias("content")
    ).alias("tool_result")))
    other = F.to_json(F.struct(F.struct(F.col("role"), F.col("text").alias("content")).alias("message")))
    said = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(other)
    return conversations.select("conv_id", "turn", said.alias("text"))
