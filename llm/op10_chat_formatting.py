"""Chat formatting: tool calls linked to their results, in DataFrame functions only.

Messages are rows (conv_id, turn, role, text).  An assistant text that is a JSON
object with ``tool_calls`` ([{"id", "name", "arguments"}]) calls tools; a text of
role ``tool`` that is a JSON object with ``tool_call_id`` is a result; any other
text is content.  Results are hash-joined to calls by conversation and
identifier, arguments are validated against the tools' schemas, and each message
is serialised as canonical JSON (keys in order, no spaces).

Topological order: a result must follow its call, whatever turn it was recorded
at.  Results depend only on calls, so the order is closed: sorting a conversation
by (order_turn, order_step, order_call, turn) is a topological order.  It is
given as columns, so no conversation is ever gathered or sorted in one task.

Defined results: a null conv_id or identifier links nothing; of calls that share
an identifier the first one is meant (least turn, then place in its message);
several results of a call all follow it; a result without a call stays at its
turn, unlinked; invalid JSON, null and empty texts are content; a call to an
unknown tool or with missing, unknown or wrongly typed arguments is invalid; a
text too long for a variant (128 MB) is content;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: JSON type: the types that a variant of it has
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",), "array": ("ARRAY",), "object": ("OBJECT",)}

#: name of a tool: its arguments (type, whether required)
TOOLS = {
    "count_words": {"text": ("string", True), "limit": ("integer", False)},
    "find": {"pattern": ("string", True), "text": ("string", True)},
}


def _typed(value: Column, kind: str) -> Column:
    said = F.schema_of_variant(value)
    return reduce(lambda a, b: a | b, (said.startswith(t) for t in TYPES[kind]))


def valid_call(name: Column, arguments: Column, tools: dict) -> Column:
    """Whether a call's arguments (variant) fit the schema of its tool."""
    out = F.lit(False)
    for tool, fields in tools.items():
        keys = F.json_object_keys(F.to_json(arguments))
        fits = keys.isNotNull() & (F.size(F.array_except(keys, F.array(*(F.lit(f) for f in fields)))) == 0)
        for field, (kind, required) in fields.items():
            value = F.try_variant_get(arguments, f"$.{field}", "variant")
            fits = fits & F.when(F.array_contains(keys, field), _typed(value, kind)).otherwise(F.lit(not required))
        out = F.when(name == tool, F.coalesce(fits, F.lit(False))).otherwise(out)
    return out


def canonical(fields: dict[str, Column]) -> Column:
    """A JSON object of variants, keys in order; null fields are left out."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))))


def link_tool_calls(messages: DataFrame, tools: dict = TOOLS) -> DataFrame:
    """Returns conv_id, turn, role, kind, call_id, n_calls, n_valid, linked, order_turn, order_step, order_call, json."""
    parsed = messages.select("conv_id", "turn", "role", "text").withColumn("v", F.when(F.col("role").isin("assistant", "tool"), F.try_parse_json("text")))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    parsed = parsed.withColumn("calls", F.when(F.col("role") == "assistant", get("$.tool_calls", "array<variant>")))
    parsed = parsed.withColumn("call_id", F.when(F.col("role") == "tool", get("$.tool_call_id", "string")))
    item = lambda c: (F.try_variant_get(c, "$.id", "string"), F.try_variant_get(c, "$.name", "string"), F.try_variant_get(c, "$.arguments", "variant"))

    def checked(c: Column) -> Column:
        call_id, name, arguments = item(c)
        return F.struct(arguments.alias("arguments"), call_id.alias("id"), name.alias("name"), valid_call(name, arguments, tools).alias("valid"))

    parsed = parsed.withColumn("calls", F.transform("calls", checked))
    first = parsed.where(F.size("calls") > 0).select("conv_id", "turn", F.posexplode("calls").alias("at", "call"))
    first = first.where("call.id IS NOT NULL AND conv_id IS NOT NULL").groupBy("conv_id", F.col("call.id").alias("call_id")).agg(F.min(F.struct("turn", "at")).alias("call"))
    results = parsed.where("call_id IS NOT NULL AND conv_id IS NOT NULL").join(first, ["conv_id", "call_id"], "left")
    others = parsed.where("call_id IS NULL OR conv_id IS NULL").withColumn("call", F.lit(None).cast(first.schema["call"].dataType))
    every = results.unionByName(others)
    linked = F.col("call").isNotNull()
    kind = F.when(F.col("call_id").isNotNull(), "result").when(F.size("calls") > 0, "calls").otherwise("content")
    every = every.withColumn("kind", kind)
    told = F.when(F.col("kind") == "content", F.col("text")).otherwise(F.coalesce(get("$.content", "string"), F.to_json(get("$.content", "variant"))))
    json = canonical({"content": told, "role": F.col("role"), "tool_call_id": F.col("call_id"), "tool_calls": F.when(F.col("kind") == "calls", F.col("calls"))})
    return every.select(
        "conv_id", "turn", "role", "kind", "call_id",
        F.when(F.col("kind") == "calls", F.size("calls")).otherwise(0).cast("long").alias("n_calls"),
        F.when(F.col("kind") == "calls", F.size(F.filter("calls", lambda c: c["valid"]))).otherwise(0).cast("long").alias("n_valid"),
        linked.alias("linked"),
        F.when(linked, F.col("call.turn")).otherwise(F.col("turn")).alias("order_turn"),
        F.when(linked, 1).otherwise(0).cast("long").alias("order_step"),
        F.when(linked, F.col("call.at")).otherwise(0).cast("long").alias("order_call"),
        json.alias("json"),
    )


def with_tools(conversations: DataFrame) -> DataFrame:
    """The conversations, and for each assistant turn a tool call made from it and that call's result.

    Every assistant text becomes the content of a message that also counts the
    words of that text by a call.  By the turn modulo 8 the call is sound, has a
    limit of a wrong type, lacks its text, or names an unknown tool.  Its result
    is recorded one turn early if conv_id is odd, so that order matters, and
    under another identifier if conv_id is divisible by 7.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    said = turns.where("role = 'assistant'")
    call_id = F.format_string("call_%d_%d", "conv_id", "turn")
    kind = F.col("turn") % 8
    arguments = (
        F.when(kind == 3, F.to_json(F.struct(F.lit("5").alias("limit"), "text")))
        .when(kind == 5, F.to_json(F.struct(F.lit(5).alias("limit"))))
        .otherwise(F.to_json(F.struct("text", F.col("turn").alias("limit"))))
    )
    name = F.when(kind == 7, "count_lines").otherwise("count_words")
    content = F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("content")))
    call = F.concat(F.lit('{"tool_calls":[{"name":"'), name, F.lit('","id":"'), call_id, F.lit('","arguments":'), arguments, F.lit("}],"), F.substring(content, 2, 2**31 - 1))
    calls = said.select("conv_id", "turn", "role", call.alias("text"))
    answer = F.to_json(F.struct(F.size(F.split("text", " ")).cast("string").alias("content"), F.when(F.col("conv_id") % 7 == 0, F.lit("lost")).otherwise(call_id).alias("tool_call_id")))
    results = said.select("conv_id", (F.col("turn") - F.when(F.col("conv_id") % 2 == 1, 1).otherwise(0)).alias("turn"), F.lit("tool").alias("role"), answer.alias("text"))
    return turns.where("role != 'assistant' OR role IS NULL").unionByName(calls).unionByName(results)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = with_tools(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return link_tool_calls(messages)
