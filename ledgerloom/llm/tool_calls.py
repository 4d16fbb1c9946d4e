"""Tool calls of conversations: linked to their results, ordered, checked and written as canonical JSON.

Calls and results meet in hash joins on (conversation, call id). A call may name a parent call whose result it uses;
its depth is the number of calls before it on that path, and (depth, turn) is a topological order. Depths are found
by pointer doubling: each round every call jumps to its ancestor's ancestor, so a chain of n calls takes log2(n)
rounds however many of them one conversation holds, and no conversation is gathered in a task. Calls that still have
an ancestor after that many rounds hang on a cycle. Arguments are parsed as variants, whose objects keep their keys
sorted, so writing them again is canonical; they are validated field by field against the tool's schema.

Cases: exact repeats of a call are one call; other calls with an id used before in the conversation are
``duplicate_call`` (the first by turn, name, arguments and parent is the call); exact repeats of a result are one result; of several results
with an id the first by turn and content counts and the others are rows of their own, ``repeated_result``; a first result
without a call is ``orphan_result``; a result without an id is ``result_without_id``; a call without an id is ``no_id``;
neither links to anything; a parent that is no call leaves the call at depth 0; a null conversation is one conversation;
empty tables give no rows; other columns are not read. The status of a call is the first that applies of: no_id,
duplicate_call, cycle, unknown_tool, invalid_arguments, missing_result, ok. So every call and every result is in the
output: as a row, or as the result of the one call that it answers.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.llm.tables import id_key, written

#: Schemas: tool -> field -> (type, required). A call may not have other fields.
Schemas = dict[str, dict[str, tuple[str, bool]]]
TYPES = {"integer": ("BIGINT",), "number": ("BIGINT", "DECIMAL", "DOUBLE"), "string": ("STRING",), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",)}


def violations(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """How many fields of the arguments (JSON text) break the schema of the tool; null for an unknown tool."""
    fields = F.from_json(arguments, "map<string,variant>")
    kinds = F.transform_values(fields, lambda k, v: F.regexp_extract(F.call_function("schema_of_variant", v), "^[A-Z]+", 0))
    broken = F.lit(None).cast("int")
    for tool, schema in schemas.items():
        wrong = [
            F.when(F.map_contains_key(kinds, field), (~F.element_at(kinds, field).isin(*TYPES[kind])).cast("int")).otherwise(int(required))
            for field, (kind, required) in schema.items()
        ]
        known = F.array(*[F.lit(f) for f in schema]).cast("array<string>")
        extra = F.size(F.array_except(F.map_keys(kinds), known))
        all_wrong = F.when(F.call_function("try_parse_json", arguments).isNull() | fields.isNull(), 1).otherwise(sum(wrong, F.lit(0)) + extra)
        broken = F.when(name == tool, all_wrong).otherwise(broken)
    return broken


def depths(calls: DataFrame) -> DataFrame:
    """(conv, call_id, depth) of calls (conv, call_id, parent_id) that are unique by conv and call_id; depth is null on a cycle."""
    known = calls.select(F.col("conv").alias("p_conv"), F.col("call_id").alias("p_id"))
    linked = calls.join(known, (F.col("conv") == F.col("p_conv")) & (F.col("parent_id") == F.col("p_id")), "left")
    state = written(linked.select("conv", "call_id", F.col("p_id").alias("up"), F.when(F.col("p_id").isNull(), 0).otherwise(1).cast("bigint").alias("depth")), "call-depths")
    rounds = math.ceil(math.log2(max(2, state.count()))) + 1
    for _ in range(rounds):
        if state.where("up is not null").isEmpty():
            break
        above = state.select(F.col("conv").alias("a_conv"), F.col("call_id").alias("a_id"), F.col("up").alias("a_up"), F.col("depth").alias("a_depth"))
        open_ = state.where("up is not null").join(above, (F.col("conv") == F.col("a_conv")) & (F.col("up") == F.col("a_id")))
        moved = open_.select("conv", "call_id", F.col("a_up").alias("up"), (F.col("depth") + F.col("a_depth")).alias("depth"))
        state = written(state.where("up is null").unionByName(moved), "call-depths")
    return state.select("conv", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """(conv_id, call_id, turn, depth, status, message) of every call and of every result that no call takes up.

    ``calls``: conv_id, turn, call_id, parent_id, name, arguments (JSON text). ``results``: conv_id, turn, call_id,
    content. ``message`` is one JSON object with sorted keys and no white space; fields without a value are left out.
    """
    called = calls.select("conv_id", id_key("conv_id").alias("conv"), "turn", "call_id", "parent_id", "name", "arguments").distinct()
    body = F.struct("turn", "name", "arguments", "parent_id")
    first = called.where("call_id is not null").groupBy(F.col("conv").alias("f_conv"), F.col("call_id").alias("f_id")).agg(F.min(body).alias("first"))
    marked = called.join(first, (F.col("conv") == F.col("f_conv")) & (F.col("call_id") == F.col("f_id")), "left")
    marked = written(marked.select(*called.columns, F.coalesce(body.eqNullSafe(F.col("first")) & F.col("call_id").isNotNull(), F.lit(False)).alias("leads")), "tool-calls")
    placed = depths(marked.where("leads").select("conv", "call_id", "parent_id")).select(F.col("conv").alias("d_conv"), F.col("call_id").alias("d_id"), "depth")

    said = results.select("conv_id", id_key("conv_id").alias("r_conv"), F.col("call_id").alias("r_id"), "turn", "content").distinct()
    said = written(said, "tool-results")
    answer = F.struct("turn", "content")
    answers = said.where("r_id is not null").groupBy("r_conv", "r_id").agg(F.min(answer).alias("answer"))
    whole = marked.join(placed, F.col("leads") & (F.col("conv") == F.col("d_conv")) & (F.col("call_id") == F.col("d_id")), "left")
    whole = whole.join(answers, F.col("leads") & (F.col("conv") == F.col("r_conv")) & (F.col("call_id") == F.col("r_id")), "left")
    broken = violations(F.col("name"), F.col("arguments"), schemas)
    status = (
        F.when(F.col("call_id").isNull(), "no_id").when(~F.col("leads"), "duplicate_call").when(F.col("depth").isNull(), "cycle")
        .when(broken.isNull(), "unknown_tool").when(broken > 0, "invalid_arguments").when(F.col("answer").isNull(), "missing_result").otherwise("ok")
    )
    judged = whole.select("conv_id", "call_id", "turn", F.coalesce("depth", F.lit(0).cast("bigint")).alias("depth"), "parent_id", "name", "arguments", F.col("answer.content").alias("result"), status.alias("status"))
    first = answers.select(F.col("r_conv").alias("f_conv"), F.col("r_id").alias("f_id"), "answer")
    asked = marked.where("leads").select("conv", "call_id")
    identified = said.where("r_id is not null").join(first, (F.col("r_conv") == F.col("f_conv")) & (F.col("r_id") == F.col("f_id")))
    identified = identified.join(asked, (F.col("r_conv") == F.col("conv")) & (F.col("r_id") == F.col("call_id")), "left")
    kind = F.when(~answer.eqNullSafe(F.col("answer")), "repeated_result").when(F.col("call_id").isNull(), "orphan_result")
    identified = identified.select(*said.columns, kind.alias("status")).where("status is not null")
    unlinked = identified.unionByName(said.where("r_id is null").withColumn("status", F.lit("result_without_id")))
    nothing = F.lit(None).cast("string")
    lost = unlinked.select(
        "conv_id", F.col("r_id").alias("call_id"), "turn", F.lit(0).cast("bigint").alias("depth"), nothing.alias("parent_id"),
        nothing.alias("name"), nothing.alias("arguments"), F.col("content").alias("result"), "status",
    )
    message = F.to_json(F.struct(
        F.call_function("try_parse_json", F.col("arguments")).alias("arguments"), F.col("call_id").alias("call_id"), F.col("name").alias("name"),
        F.col("parent_id").alias("parent_id"), F.col("result").alias("result"), F.col("status").alias("status"),
    ))
    return judged.unionByName(lost).select("conv_id", "call_id", "turn", "depth", "status", message.alias("message"))


#: Tools of the registered query.
SCHEMAS: Schemas = {
    "answer": {"text": ("string", True), "limit": ("integer", True)},
    "search": {"text": ("string", True), "limit": ("integer", True), "strict": ("boolean", False)},
}


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that conversation turns stand for.

    An assistant's turn is a call that asks for its text, and the user's turn after it carries the result. Every third
    turn uses an earlier parent, every fifth a limit that is not a number, every seventh a tool without a schema.
    """
    def call_id(turn: Column) -> Column:
        return F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    turn, text = F.col("turn"), F.coalesce(F.col("text"), F.lit(""))
    place = F.col("conv_id") + turn
    parent = turn - F.when(turn % 3 == 0, 4).otherwise(2)
    limit = F.when(place % 5 == 0, '"many"').otherwise(turn.cast("string"))
    quoted = F.regexp_extract(F.to_json(F.struct(text.alias("t"))), r"(?s)^\{\"t\":(.*)\}\z", 1)
    arguments = F.concat(F.lit('{ "text": '), quoted, F.lit(', "limit": '), limit, F.lit(" }"))
    calls = turns.where("role = 'assistant'").select(
        "conv_id", "turn", call_id(turn).alias("call_id"), F.when(parent >= 0, call_id(parent)).alias("parent_id"),
        F.when(place % 7 == 0, "browse").when(place % 2 == 0, "answer").otherwise("search").alias("name"), arguments.alias("arguments"),
    )
    results = turns.where("role = 'user'").select("conv_id", "turn", call_id(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


ORACLE = """with calls as (select distinct conv_id, turn, 'c' || conv_id || '-' || turn as call_id,
    case when turn - (case when turn % 3 = 0 then 4 else 2 end) >= 0 then 'c' || conv_id || '-' || (turn - (case when turn % 3 = 0 then 4 else 2 end)) end as parent_id,
    case when (conv_id + turn) % 7 = 0 then 'browse' when (conv_id + turn) % 2 = 0 then 'answer' else 'search' end as name,
    coalesce(text, '') as text, (conv_id + turn) % 5 = 0 as bad from conversations where role = 'assistant'),
ranked as (select *, row_number() over (partition by conv_id, call_id order by turn, name, cast(to_json(text) as varchar), parent_id) = 1 as leads from calls),
depths as (with recursive d as (
    select conv_id, call_id, 0::bigint as depth from ranked r where leads and not exists (select 1 from ranked p where p.leads and p.conv_id = r.conv_id and p.call_id = r.parent_id)
    union all select r.conv_id, r.call_id, d.depth + 1 from ranked r join d on r.conv_id = d.conv_id and r.parent_id = d.call_id where r.leads)
  select * from d),
said as (select distinct conv_id, 'c' || conv_id || '-' || (turn - 1) as call_id, turn, text as content from conversations where role = 'user'),
numbered as (select *, row_number() over (partition by conv_id, call_id order by turn nulls first, content nulls first) as nth from said),
results as (select * from numbered where nth = 1 and call_id is not null),
judged as (select r.conv_id, r.call_id, r.turn, coalesce(d.depth, 0) as depth, r.parent_id, r.name,
    '{"limit":' || case when bad then '"many"' else cast(r.turn as varchar) end || ',"text":' || cast(to_json(r.text) as varchar) || '}' as arguments,
    case when leads then s.content end as result,
    case when not leads then 'duplicate_call' when r.name = 'browse' then 'unknown_tool' when bad then 'invalid_arguments' when s.call_id is null then 'missing_result' else 'ok' end as status
  from ranked r left join depths d on r.leads and r.conv_id = d.conv_id and r.call_id = d.call_id
  left join results s on r.leads and r.conv_id = s.conv_id and r.call_id = s.call_id
  union all select conv_id, call_id, turn, 0, null, null, null, content, case when call_id is null then 'result_without_id' when nth > 1 then 'repeated_result' else 'orphan_result' end from numbered s
  where nth > 1 or not exists (select 1 from ranked r where r.leads and r.conv_id = s.conv_id and r.call_id = s.call_id))
select conv_id, call_id, turn, depth, status, '{' || concat_ws(',', '"arguments":' || arguments, '"call_id":' || cast(to_json(call_id) as varchar),
  '"name":' || cast(to_json(name) as varchar), '"parent_id":' || cast(to_json(parent_id) as varchar), '"result":' || cast(to_json(result) as varchar),
  '"status":"' || status || '"') || '}' as message from judged"""
