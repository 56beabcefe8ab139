"""Chat formatting: tool calls linked with their results.

Messages give calls and results, calls are hash-joined with results by identifier, put in a topological order, their
arguments validated against schemas, and every link becomes one line of canonical JSON. DataFrame functions only.

A message can be JSON: an object with tool_calls, an array of {id, name, arguments}, or one with tool_call_id and
content. Any other message is prose and counts as an exchange: what a user or the system says calls the tool "respond"
under the identifier turn:<turn>, and what the assistant says is the result of the call of the turn before.

Order: a call may use results through {"$ref": id} in its arguments; it has to come after the calls of those. Calls
without references are of level 0; each round gives the next level to the calls whose references all have one, as Kahn's
method does, so the order by level, then turn, then place in the message, is topological. A call that refers to a missing
call, or to itself around a cycle, gets no level; it comes last and is not ordered. Nor is one whose result is older.

Nulls: a message without conversation, turn or role is left out; a null text is an empty one. Of several results of a
call the first that isn't older than the call goes with it (the last of the older ones if there are no others); every
other is a link of its own with the same identifier and no name, and n_results tells how many there are. Of several
calls with one identifier each is kept and has the same result. Repeated rows count once. A result without a call is a
link without a call. An empty table gives no links; other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut

#: Schemas of tools: required and optional properties with their JSON types; a prompt has at least one character.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {"respond": {"prompt": ("string", True), "speaker": ("string", True)}}
#: Turns in a block, within which places are counted before blocks are added up.
BLOCK = 256

_CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string>>,tool_call_id:string,content:string>"
_REF = r'"\$ref"\s*:\s*"((?:[^"\\]|\\.)*)"'
# what Spark names the types of variants, by JSON type
_VARIANT = {"string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$", "array": "^ARRAY<", "object": "^OBJECT<", "null": "^VOID$"}


def messages(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), each once, without rows that can't be placed."""
    return (
        conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
        .where("conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL")
        .distinct()
    )


def events(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (conv_id, turn, seq, call_id, name, arguments) and results (conv_id, turn, call_id, content)."""
    parsed = rows.withColumn("p", F.when(F.col("text").rlike(r"^\s*\{"), F.from_json("text", _CALLS)))
    structured = F.col("p.tool_calls").isNotNull() | F.col("p.tool_call_id").isNotNull()
    prose = parsed.where(~F.coalesce(structured, F.lit(False)))
    explicit = parsed.select("conv_id", "turn", F.posexplode("p.tool_calls").alias("seq", "c")).select(
        "conv_id", "turn", "seq", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.coalesce("c.arguments", F.lit("{}")).alias("arguments")
    )
    implicit = prose.where("role <> 'assistant'").select(
        "conv_id",
        "turn",
        F.lit(0).alias("seq"),
        F.concat(F.lit("turn:"), F.col("turn").cast("string")).alias("call_id"),
        F.lit("respond").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), F.col("role").alias("speaker"))).alias("arguments"),
    )
    answers = parsed.where(F.col("p.tool_call_id").isNotNull()).select("conv_id", "turn", F.col("p.tool_call_id").alias("call_id"), F.coalesce("p.content", F.lit("")).alias("content"))
    said = prose.where("role = 'assistant'").select("conv_id", "turn", F.concat(F.lit("turn:"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("text").alias("content"))
    return explicit.unionByName(implicit), answers.unionByName(said)


def valid_arguments(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """Whether the arguments are an object that fits the tool's schema; false for a tool without a schema."""
    value = F.try_parse_json(arguments)
    kind = lambda v: F.schema_of_variant(v)
    out = F.lit(False)
    for tool, properties in schemas.items():
        fits = F.coalesce(kind(value).startswith("OBJECT"), F.lit(False))
        for key, (json_type, required) in properties.items():
            at = F.try_variant_get(value, f"$.{key}", "variant")
            right = kind(at).rlike(_VARIANT[json_type])
            fits = fits & (F.coalesce(right, F.lit(False)) if required else F.coalesce(right, F.lit(True)))
        out = F.when(name == tool, fits).otherwise(out)
    return F.coalesce(out, F.lit(False))


def canonical(arguments: Column) -> Column:
    """The JSON text with sorted keys and no white space between; null where it isn't JSON."""
    return F.to_json(F.try_parse_json(arguments))


def link(conversations: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]] | None = None) -> DataFrame:
    """(conv_id, place, level, turn, seq, call_id, name, valid, ordered, n_results, result_turn, line): a row for each link.

    place counts the links of a conversation from 1, in topological order.
    """
    calls, results = events(messages(conversations))
    # of several results the first that isn't older than the call; if all are older, the last of those
    key, at = ["conv_id", "call_id"], F.struct("turn", "content")
    asked = calls.where("call_id IS NOT NULL").groupBy(*key).agg(F.min("turn").alias("first_turn"))
    since = F.coalesce(F.col("turn") >= F.col("first_turn"), F.lit(True))
    chosen = (
        results.where("call_id IS NOT NULL")
        .join(asked, key, "left")
        .groupBy(*key)
        .agg(F.coalesce(F.min(F.when(since, at)), F.max(F.when(~since, at))).alias("r"), F.count("*").alias("n_results"))
        .select(*key, F.col("r.turn").alias("result_turn"), F.col("r.content").alias("result"), "n_results")
    )
    # the others are links of their own, so that none is lost
    others = results.distinct().join(chosen, key).where((F.col("turn") != F.col("result_turn")) | (F.col("content") != F.col("result")))
    others = others.select(*key, "turn", F.lit(-1).alias("seq"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"), F.col("turn").alias("result_turn"), F.col("content").alias("result"), "n_results")
    linked = calls.join(chosen, key, "full_outer").unionByName(others).withColumns({"turn": F.coalesce("turn", "result_turn"), "seq": F.coalesce("seq", F.lit(-1)), "n_results": F.coalesce("n_results", F.lit(0))})
    mark = F.coalesce("call_id", F.lit("")).alias("mark")  # messages of one turn can each have a call of one place
    needs = calls.select("conv_id", "turn", "seq", mark, "call_id", F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(_REF), 1))).alias("ref"))
    level = levels(needs, calls)
    late = F.coalesce(F.col("result_turn") >= F.col("turn"), F.lit(True))
    # -1: it has references and no level
    got = linked.withColumn("mark", mark).join(level, ["conv_id", "turn", "seq", "mark"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    got = got.withColumn("ordered", (F.col("level") >= 0) & late)
    got = got.withColumn("valid", valid_arguments(F.col("name"), F.col("arguments"), schemas or SCHEMAS))
    # keys are in the order of the alphabet; a field that is null is left out
    line = F.to_json(
        F.struct(
            F.coalesce(canonical(F.col("arguments")), F.col("arguments")).alias("arguments"),
            F.col("call_id").alias("id"),
            "name",
            "result",
            "valid",
        )
    )
    return _placed(got.withColumn("line", line)).select("conv_id", "place", "level", "turn", "seq", "call_id", "name", "valid", "ordered", "n_results", "result_turn", "line")


def levels(needs: DataFrame, calls: DataFrame) -> DataFrame:
    """(conv_id, turn, seq, mark, level) of the calls with references (..., call_id, ref); -1 without a level."""
    key = ["conv_id", "turn", "seq", "mark"]
    waiting = cut(needs)
    done = waiting.select(*key, F.lit(0).alias("level")).limit(0)
    if waiting.isEmpty():
        return done
    known = calls.where("call_id IS NOT NULL").select("conv_id", F.col("call_id").alias("ref")).distinct()
    missing = cut(waiting.join(known, ["conv_id", "ref"], "left_anti").select(*key).distinct())
    number = 0
    while True:
        number += 1
        open_ = waiting.where("call_id IS NOT NULL").select("conv_id", F.col("call_id").alias("ref")).distinct()
        blocked = waiting.join(open_, ["conv_id", "ref"], "left_semi").select(*key).unionByName(missing).distinct()
        ready = cut(waiting.select(*key).distinct().join(blocked, key, "left_anti"))
        if ready.isEmpty():
            return done.unionByName(waiting.select(*key).distinct().withColumn("level", F.lit(-1)))
        done = done.unionByName(ready.withColumn("level", F.lit(number)))
        waiting = cut(waiting.join(ready, key, "left_anti"))


def _placed(rows: DataFrame) -> DataFrame:
    """With the place within the conversation: within blocks of turns, plus the links of the blocks before.

    No task gets a whole conversation, however many turns it has.
    """
    from pyspark.sql import Window

    rows = rows.withColumn("block", F.struct(F.col("level") < 0, "level", F.floor(F.col("turn") / BLOCK).alias("turns")))
    blocks = rows.groupBy("conv_id", "block").count()
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offset = blocks.select("conv_id", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "seq", "call_id", "name", "arguments", "result")
    return rows.withColumn("n", F.row_number().over(within)).join(offset, ["conv_id", "block"]).withColumn("place", F.col("n") + F.col("before"))


def query(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    return link(conversations)
