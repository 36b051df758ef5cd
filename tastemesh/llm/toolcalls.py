"""Chat formatting (operator 9): tool-call linking.

Calls and results meet by identifier in a hash join; calls are ordered by what
they depend on; arguments are validated against the tools' schemas; every
linked call becomes one canonical JSON message (keys sorted, no white space).
All of it is DataFrame and SQL functions; JSON is Spark's variant type, whose
text form has sorted keys.

* calls: (call_id, conv_id, turn, name, arguments, after); ``after`` names the
  call whose result this one uses;
* results: (call_id, turn, content).

Levels are distances to a call that depends on none, found by pointer doubling:
each round every call looks twice as far back, so a conversation of a million
calls takes 20 rounds, and no conversation is ever gathered into one task.
Ordering by (level, turn) is topological.  Calls still looking back after
log2(calls) + 2 rounds wait on a cycle: status ``cycle``, no level.

Statuses: ``linked``; ``no_result``; ``cycle``; ``no_id`` (a call or result with a null
identifier, never joined); ``orphan`` (a result without a call); ``duplicate``.  Calls
with one identifier are one call, the earliest, with their number in n_calls; of
several results the earliest counts, their number is n_results.  The others, as far
as they differ, are rows of the status ``duplicate`` with no level; equal rows are one,
with their number.  A
dependency that does not exist is an error, and the call starts at level 0.
Null texts are absent arguments; empty tables give no rows; other columns of the
input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemesh.llm.common import written

#: tool -> parameter -> (JSON type, required)
SCHEMAS = {
    "ask": {"text": ("string", True), "words": ("integer", True)},
    "configure": {"text": ("string", True)},
}
# the names under which a variant shows its JSON types
_KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "boolean": ("BOOLEAN",),
          "number": ("BIGINT", "DECIMAL", "DOUBLE"), "object": ("OBJECT",), "array": ("ARRAY",)}


def argument_errors(name: str, arguments: str, schemas: dict = SCHEMAS) -> Column:
    """What is wrong with a JSON text of arguments, in the schema's order: ``unknown tool``,
    ``no object``, ``missing p``, ``type of p``, ``unknown p``."""
    args, tool = F.col(arguments), F.col(name)
    value = F.try_parse_json(args)
    given = F.json_object_keys(args)
    no_object = value.isNull() | ~F.schema_of_variant(value).startswith("OBJECT")
    out = F.array(F.lit("unknown tool"))
    for t, params in schemas.items():
        found = []
        for p, (kind, required) in params.items():
            part = F.variant_get(value, f"$.{p}", "variant")
            shape = F.regexp_extract(F.schema_of_variant(part), "^[A-Z]+", 0)
            absent = part.isNull() | (F.schema_of_variant(part) == "VOID")
            found.append(F.when(absent, F.lit(f"missing {p}") if required else F.lit(None))
                         .when(~shape.isin(*_KINDS[kind]), F.lit(f"type of {p}")))
        unknown = F.transform(F.array_sort(F.array_except(
            given, F.array(*[F.lit(p) for p in params]))), lambda k: F.concat(F.lit("unknown "), k))
        checks = F.concat(F.array_compact(F.array(*found).cast("array<string>")), unknown)
        out = F.when(tool == t, F.when(no_object, F.array(F.lit("no object")))
                     .otherwise(checks)).otherwise(out)
    return out


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of calls (call_id, after): unique ids, ``after`` null or an id."""
    look = written(calls.select("call_id", F.col("after").alias("back"),
                                F.when(F.col("after").isNull(), 0).otherwise(1).cast("long")
                                .alias("level")), "levels")
    n = look.filter("back is not null").count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        there = look.select(F.col("call_id").alias("at"), F.col("back").alias("further"),
                            F.col("level").alias("more"))
        # calls that are done have no key to join by: they pass by the join
        going = look.filter("back is not null")
        look = written(going.join(there, going["back"] == there["at"], "left").select(
            "call_id", F.col("further").alias("back"),
            (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")).unionByName(
            look.filter("back is null")), "levels")
        if not look.filter("back is not null").head(1):
            break
    return look.select("call_id", F.when(F.col("back").isNull(), F.col("level")).alias("level"))


def _further(rows: DataFrame, first: DataFrame) -> DataFrame:
    """The distinct ``rows`` that are not the ``first`` of their identifier, with their number n."""
    cols = first.columns
    both = (rows.select(*cols, F.lit(1).cast("long").alias("n"), F.lit(0).alias("main"))
            .unionByName(first.select(*cols, F.lit(0).cast("long").alias("n"),
                                      F.lit(1).alias("main"))))
    return (both.groupBy(*cols).agg(F.sum("n").alias("n"), F.max("main").alias("main"))
            .filter("main = 0").drop("main"))


def _lone_results(results: DataFrame, calls: DataFrame, status: str) -> DataFrame:
    """Rows of results (with their number n) that no call is linked with."""
    return results.select(
        "conv_id", "turn", "call_id", F.lit(None).cast("string").alias("name"),
        F.lit(None).cast(calls.schema["arguments"].dataType).alias("arguments"),
        F.lit(False).alias("dangling"), F.lit(status).alias("status"),
        F.lit(None).cast("long").alias("level"), F.lit(0).cast("long").alias("n_calls"),
        F.col("n").alias("n_results"), F.col("turn").alias("result_turn"), "content")


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row per call, per result without a call and per further call or result of one
    identifier: (conv_id, turn, call_id, name, status, level, valid, errors, n_calls, n_results,
    result_turn, message)."""
    named = calls.filter("call_id is not null")
    answers = results.filter("call_id is not null")
    first = F.min(F.struct("turn", "name", "arguments", "after", "conv_id")).alias("c")
    call = (named.groupBy("call_id").agg(first, F.count(F.lit(1)).alias("n_calls"))
            .select("call_id", "c.*", "n_calls"))
    answer = (answers.groupBy("call_id")
              .agg(F.min(F.struct("turn", "content", "conv_id")).alias("r"),
                   F.count(F.lit(1)).alias("n_results"))
              .select(F.col("call_id").alias("answers"), F.col("r.turn").alias("result_turn"),
                      F.col("r.content").alias("content"), F.col("r.conv_id").alias("result_conv"),
                      "n_results"))
    known = call.select(F.col("call_id").alias("dependency"))
    # calls that wait for none have no key to join by
    waiting = call.filter("after is not null")
    call = (waiting.join(known, waiting["after"] == known["dependency"], "left").unionByName(
        call.filter("after is null").withColumn("dependency", F.col("after")))
            .withColumn("dangling", F.col("after").isNotNull() & F.col("dependency").isNull()))
    call = written(call, "calls")
    level = levels(call.select("call_id", F.col("dependency").alias("after")))
    both = (call.join(level, "call_id")
            .join(answer, F.col("call_id") == F.col("answers"), "full_outer"))
    lone = F.col("call_id").isNull()
    rows = both.select(
        F.when(lone, F.col("result_conv")).otherwise(F.col("conv_id")).alias("conv_id"),
        F.when(lone, F.col("result_turn")).otherwise(F.col("turn")).alias("turn"),
        F.coalesce("call_id", "answers").alias("call_id"), "name", "arguments", "dangling",
        F.when(lone, "orphan").when(F.col("level").isNull(), "cycle")
        .when(F.col("answers").isNull(), "no_result").otherwise("linked").alias("status"),
        "level", F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"), "result_turn", "content")
    unnamed = calls.filter("call_id is null").select(
        "conv_id", "turn", "call_id", "name", "arguments", F.lit(False).alias("dangling"),
        F.lit("no_id").alias("status"), F.lit(None).cast("long").alias("level"),
        F.lit(1).cast("long").alias("n_calls"), F.lit(0).cast("long").alias("n_results"),
        F.lit(None).cast(calls.schema["turn"].dataType).alias("result_turn"),
        F.lit(None).cast("string").alias("content"))
    unnamed = unnamed.unionByName(_lone_results(
        results.filter("call_id is null").withColumn("n", F.lit(1).cast("long")), calls, "no_id"))
    again = _further(named, call.select("call_id", "turn", "name", "arguments", "after", "conv_id")
                     ).select(
        "conv_id", "turn", "call_id", "name", "arguments", F.lit(False).alias("dangling"),
        F.lit("duplicate").alias("status"), F.lit(None).cast("long").alias("level"),
        F.col("n").alias("n_calls"), F.lit(0).cast("long").alias("n_results"),
        F.lit(None).cast(calls.schema["turn"].dataType).alias("result_turn"),
        F.lit(None).cast("string").alias("content"))
    again = again.unionByName(_lone_results(_further(answers, answer.select(
        F.col("answers").alias("call_id"), F.col("result_turn").alias("turn"), "content",
        F.col("result_conv").alias("conv_id"))), calls, "duplicate"))
    rows = again.unionByName(rows).unionByName(unnamed)
    wrong = F.concat(argument_errors("name", "arguments", schemas), F.when(
        F.col("dangling"), F.array(F.lit("missing dependency"))).otherwise(
        F.array().cast("array<string>")))
    rows = rows.withColumn("errors", F.when(F.col("n_calls") == 0,
                                            F.array().cast("array<string>")).otherwise(wrong))
    rows = rows.withColumn("valid", F.col("status").isin("linked", "no_result")
                           & (F.size("errors") == 0))
    # null fields are left out of the object; keys come out sorted
    body = F.to_json(F.struct("call_id", "name", "level", "status", "result_turn",
                              F.col("content").alias("result")))
    args = F.coalesce(F.to_json(F.try_parse_json(F.col("arguments"))), F.lit("null"))
    text = F.concat(F.lit('{"arguments":'), args, F.lit(","), F.substring(body, 2, 2147483647))
    return rows.select("conv_id", "turn", "call_id", "name", "status", "level", "valid",
                       F.array_join("errors", "; ").alias("errors"), "n_calls", "n_results",
                       "result_turn", F.to_json(F.parse_json(text)).alias("message"))


def from_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of a plain conversation table (conv_id, turn, role, text).

    A ``user`` turn is a call ``ask``, a ``system`` turn a call ``configure``; an
    ``assistant`` turn is the result of the turn before it.  A user turn depends on
    the user turn two before, the one at turn 1 on a system turn 0.  Other roles
    are neither.  A null conv_id or turn gives no identifier.
    """
    m = messages.select("conv_id", F.col("turn").cast("long").alias("turn"),
                        F.col("role").cast("string").alias("role"),
                        F.col("text").cast("string").alias("text"))

    def name_of(turn):
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"),
                        turn.cast("string"))
    turn = F.col("turn")
    words = F.size(F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != ""))
    calls = m.filter(F.col("role").isin("user", "system")).select(
        name_of(turn).alias("call_id"), "conv_id", "turn",
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.when(F.col("role") == "user", F.to_json(F.struct(
            F.when(F.col("text").isNotNull(), words).alias("words"), "text")))
        .otherwise(F.to_json(F.struct("text"))).alias("arguments"),
        F.when((F.col("role") == "user") & (turn >= 2), name_of(turn - 2))
        .when((F.col("role") == "user") & (turn == 1), name_of(F.lit(0))).alias("after"))
    results = m.filter(F.col("role") == "assistant").select(
        name_of(turn - 1).alias("call_id"), "conv_id", "turn", F.col("text").alias("content"))
    return calls, results


def op9_tool_call_linking(spark, sf_dir: str) -> DataFrame:
    return link(*from_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


OP9_SQL = """
WITH RECURSIVE calls AS (
  SELECT 'call_' || conv_id || '_' || turn AS call_id, conv_id, turn,
         CASE role WHEN 'user' THEN 'ask' ELSE 'configure' END AS name,
         CASE role WHEN 'user' THEN json_object('text', text, 'words',
                len(regexp_extract_all(text, '[^ \\t\\n\\v\\f\\r]+')))
              ELSE json_object('text', text) END AS arguments,
         CASE WHEN role = 'user' AND turn >= 2 THEN 'call_' || conv_id || '_' || (turn - 2)
              WHEN role = 'user' AND turn = 1 THEN 'call_' || conv_id || '_0' END AS after
  FROM conversations WHERE role IN ('user', 'system')
), results AS (
  SELECT 'call_' || conv_id || '_' || (turn - 1) AS call_id, conv_id, turn, text AS content
  FROM conversations WHERE role = 'assistant'
), known AS (
  SELECT c.*, p.call_id AS dependency FROM calls c LEFT JOIN calls p ON c.after = p.call_id
), depth AS (
  SELECT call_id, CAST(0 AS BIGINT) AS level FROM known WHERE dependency IS NULL
  UNION ALL
  SELECT k.call_id, d.level + 1 FROM known k JOIN depth d ON k.dependency = d.call_id
), linked AS (
  SELECT k.conv_id, k.turn, k.call_id, k.name, k.arguments, d.level, r.turn AS result_turn,
         r.content, CASE WHEN r.call_id IS NULL THEN 'no_result' ELSE 'linked' END AS status,
         CASE WHEN k.after IS NOT NULL AND k.dependency IS NULL THEN 'missing dependency'
              ELSE '' END AS errors,
         1 AS n_calls, CASE WHEN r.call_id IS NULL THEN 0 ELSE 1 END AS n_results
  FROM known k JOIN depth d USING (call_id) LEFT JOIN results r ON r.call_id = k.call_id
  UNION ALL
  SELECT r.conv_id, r.turn, r.call_id, NULL, NULL, NULL, r.turn, r.content, 'orphan', '', 0, 1
  FROM results r WHERE r.call_id NOT IN (SELECT call_id FROM calls)
)
SELECT conv_id, turn, call_id, name, status, level, status <> 'orphan' AND errors = '' AS valid,
       errors, CAST(n_calls AS BIGINT) AS n_calls, CAST(n_results AS BIGINT) AS n_results,
       result_turn,
       '{"arguments":' || coalesce(CAST(arguments AS VARCHAR), 'null')
       || ',"call_id":' || CAST(to_json(call_id) AS VARCHAR)
       || coalesce(',"level":' || level, '') || coalesce(',"name":"' || name || '"', '')
       || coalesce(',"result":' || CAST(to_json(content) AS VARCHAR), '')
       || coalesce(',"result_turn":' || result_turn, '')
       || ',"status":"' || status || '"}' AS message
FROM linked
"""
