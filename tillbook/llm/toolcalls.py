"""Linking of tool calls and results in chats, with DataFrame functions only.

Calls and results meet in a join by the hash of conversation and identifier; whether a partition's side is
kept in a hash table or sorted is left to the planner, which knows the sizes. A call that refers to another
call's result comes after it. The order of turns mostly says so already; calls that refer to a later one,
and those that depend on them, are put in order by repeated joins along references. Arguments are checked against the tool's schema within the row, and everything is written as canonical
JSON: keys sorted, no white space, null members left out.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.common import cut

CALLS = "conv_id long, call_id string, turn long, name string, arguments string"
RESULTS = "conv_id long, call_id string, turn long, content string"
SCHEMAS = "name string, parameter string, type string, required boolean"
_KEY = ["conv_id", "call_id"]

#: JSON Schema's type names and how Spark describes a variant of that type.
_TYPES = {
    "string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$",
    "object": "^OBJECT<.*>$", "array": "^ARRAY<.*>$", "null": "^VOID$",
}


def parse_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in the JSON of chat messages (conv_id, turn, role, text).

    An assistant's message may hold ``{"tool_calls": [{"id", "name", "arguments": {...}}]}``, a tool's
    message ``{"tool_call_id", "content"}``. Other texts, and text that isn't JSON, hold neither.
    """
    calls = messages.where("role = 'assistant'").select(
        "conv_id", "turn", F.explode(F.from_json("text", "tool_calls array<struct<id string, name string, arguments string>>")["tool_calls"]).alias("c")
    )
    results = messages.where("role = 'tool'").select("conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("r"))
    return (
        calls.select("conv_id", F.col("c.id").alias("call_id"), "turn", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments")),
        results.where("r.tool_call_id is not null").select("conv_id", F.col("r.tool_call_id").alias("call_id"), "turn", F.col("r.content").alias("content")),
    )


def _delayed(first: DataFrame) -> DataFrame | None:
    """(conv_id, call_id, after_turn, step) for the calls that turns don't put in a topological order: those
    that refer to a call of the same or a later place, and all that depend on them. Both numbers are null for
    calls on a cycle of references, and behind one. None if turns will do.

    References to identifiers that the conversation doesn't have are ignored. The rounds are as many as
    the longest chain of such calls has members, not as many as a conversation has.
    """
    needs = first.select(*_KEY, "turn", F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(r'"\$([^"\\]+)"'), F.lit(1)))).alias("need"))
    there = first.select("conv_id", F.col("call_id").alias("need"), F.col("turn").alias("need_turn"))
    edges = cut(needs.join(there, ["conv_id", "need"]))
    late = F.struct(F.col("need_turn").alias("t"), F.col("need").alias("c")) >= F.struct(F.col("turn").alias("t"), F.col("call_id").alias("c"))
    new = cut(edges.where(late).select(*_KEY).distinct())
    if new.isEmpty():
        return None
    affected = new
    while not new.isEmpty():
        reached = new.select("conv_id", F.col("call_id").alias("need"))
        new = cut(edges.join(reached, ["conv_id", "need"], "left_semi").select(*_KEY).distinct().join(affected, _KEY, "left_anti"))
        affected = cut(affected.union(new))
    # a call is placed once all it needs are; those that aren't affected have their turn
    mine = cut(edges.join(affected, _KEY, "left_semi"))
    place = F.struct(F.col("turn").alias("after_turn"), F.lit(0).alias("step")).alias("place")
    placed = cut(first.select(*_KEY, place).join(affected, _KEY, "left_anti"))
    rest, found = mine, None
    while not rest.isEmpty():
        met = placed.select("conv_id", F.col("call_id").alias("need"), F.struct("place.after_turn", (F.col("place.step") + 1).alias("step")).alias("need_place"))
        ready = rest.join(met, ["conv_id", "need"], "left").groupBy(*_KEY, "turn").agg(
            F.bool_and(F.col("need_place").isNotNull()).alias("all"), F.max("need_place").alias("last")
        )
        new = cut(ready.where("all").select(*_KEY, F.greatest(place, "last").alias("place")))
        if new.isEmpty():
            break
        found = new if found is None else found.union(new)
        placed = cut(placed.union(new))
        rest = cut(rest.join(new, _KEY, "left_anti"))
    if found is None:
        return affected.select(*_KEY, F.lit(None).cast("long").alias("after_turn"), F.lit(None).cast("int").alias("step"))
    return affected.join(found, _KEY, "left").select(*_KEY, "place.after_turn", "place.step")


def _typed(value: Column, wanted: Column) -> Column:
    found = F.schema_of_variant(value)
    holds = [(wanted == name) & found.rlike(pattern) for name, pattern in _TYPES.items()]
    either = holds[0]
    for h in holds[1:]:
        either = either | h
    return wanted.isNull() | ~wanted.isin(*_TYPES) | either


def _errors() -> Column:
    """Sorted messages: unreadable arguments, an unknown tool, and per parameter missing, unknown or mistyped."""
    given, known = F.map_keys("given"), F.map_keys("parameters")
    required = F.map_keys(F.map_filter("parameters", lambda _, p: F.coalesce(p["required"], F.lit(False))))
    wrong = F.map_keys(F.map_filter("given", lambda k, v: F.array_contains(known, k) & ~_typed(v, F.element_at(F.col("parameters"), k)["type"])))

    def told(kind: str, names: Column) -> Column:
        return F.transform(names, lambda n: F.concat(F.lit(kind + " "), n))

    found = F.concat(told("missing", F.array_except(required, given)), told("mistyped", wrong), told("unknown", F.array_except(given, known)))
    return (
        F.when(F.col("given").isNull(), F.array(F.lit("unreadable arguments")))
        .when(F.col("parameters").isNull(), F.array(F.lit("unknown tool")))
        .otherwise(F.array_sort(found))
    )


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and per result without one: conv_id, call_id, turn, name, status, result_turn,
    after_turn, step, errors, json.

    (after_turn, step, call_id) orders a conversation's calls topologically by their references, an
    argument's string ``$<call_id>``: a call's own turn and 0, unless it waits for one of the same or a
    later place; null for calls on or behind a cycle of references. Status: ``linked``, ``unanswered``, ``duplicate`` (an earlier call of the conversation has the
    identifier; by name and arguments, if of the same turn) or ``orphan`` (a result without a call).
    Of several results the first by turn counts, then by content. Equal rows count once; null
    identifiers link with nothing; null arguments are unreadable. Empty tables give empty results;
    other columns play no part.
    """
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments").distinct()
    results = results.select("conv_id", "call_id", "turn", "content")
    by_tool = schemas.where("name is not null and parameter is not null").groupBy("name", "parameter").agg(
        F.max("type").alias("type"), F.max("required").alias("required")
    ).groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("parameter", F.struct("type", "required")))).alias("parameters"))

    keyed = calls.where("conv_id is not null and call_id is not null")
    leading = keyed.groupBy(_KEY).agg(F.min(F.struct("turn", "name", "arguments")).alias("first"))
    first = leading.select(*_KEY, F.col("first.*"))
    answers = results.where("conv_id is not null and call_id is not null").groupBy(_KEY).agg(F.min(F.struct("turn", "content")).alias("answer"))
    delayed = _delayed(first)
    leads = F.col("first").isNotNull() & F.struct("turn", "name", "arguments").eqNullSafe(F.col("first"))
    led = calls.join(leading, _KEY, "left").withColumn("leads", leads)
    joined = (
        led.join(answers, _KEY, "left")
        .join(by_tool, "name", "left")
        .withColumn("given", F.from_json("arguments", "map<string,variant>"))
        .withColumn("parsed", F.try_parse_json("arguments"))
    )
    if delayed is None:
        joined = joined.withColumn("after_turn", F.col("turn")).withColumn("step", F.lit(0))
    else:
        joined = joined.join(delayed.withColumn("waits", F.lit(True)), _KEY, "left")
        joined = joined.withColumn("after_turn", F.when(F.col("waits"), F.col("after_turn")).otherwise(F.col("turn")))
        joined = joined.withColumn("step", F.when(F.col("waits"), F.col("step")).otherwise(F.lit(0)))
    answered = F.when(F.col("leads"), F.col("answer"))
    status = (
        F.when(~F.col("leads") & F.col("call_id").isNotNull() & F.col("conv_id").isNotNull(), "duplicate")
        .when(answered.isNotNull(), "linked").otherwise("unanswered")
    )
    canonical = F.to_json(F.struct(
        F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), "name", answered["content"].alias("result")
    ))
    done = joined.select(
        "conv_id", "call_id", "turn", "name", status.alias("status"), answered["turn"].alias("result_turn"),
        *[F.when(F.col("leads"), F.col(c)).alias(c) for c in ("after_turn", "step")], _errors().alias("errors"), canonical.alias("json"),
    )
    orphans = results.distinct().join(first.select(*_KEY), _KEY, "left_anti").select(
        "conv_id", "call_id", "turn", F.lit(None).cast("string").alias("name"), F.lit("orphan").alias("status"), F.col("turn").alias("result_turn"),
        F.lit(None).cast("long").alias("after_turn"), F.lit(None).cast("int").alias("step"), F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.col("call_id").alias("id"), F.col("content").alias("result"))).alias("json"),
    )
    return done.unionByName(orphans)


def exchanges(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Question and answer as call and result, for chats without tools: a user's turn calls ``respond``
    under the identifier ``<turn>`` and refers to the exchange two turns before, if there is one; the
    assistant's turn after it is the result. Needs a turn number; equal rows are fine."""
    messages = messages.select("conv_id", "turn", "role", "text")
    turn = F.col("turn").cast("string")
    users = messages.where("role = 'user'")
    before = users.select("conv_id", (F.col("turn") + 2).alias("turn"), F.lit(True).alias("follows")).distinct()
    calls = users.join(before, ["conv_id", "turn"], "left").select(
        "conv_id", turn.alias("call_id"), "turn", F.lit("respond").alias("name"),
        F.to_json(F.struct(
            F.when(F.col("follows"), F.concat(F.lit("$"), (F.col("turn") - 2).cast("string"))).alias("after"), F.col("text").alias("prompt")
        )).alias("arguments"),
    )
    results = messages.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).cast("string").alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results
