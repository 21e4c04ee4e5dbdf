"""Tool-call linking and canonical JSON, with DataFrame functions only.

* Calls and results are joined by (conversation, call id). Rows that are equal in every column are one (``copies`` counts them); every
  other call and every other result is a row of its own. Each call is joined to one result of its id, so ids that are reused on both
  sides never multiply.
* A call may name the call whose result it uses (``after``). Its level is the length of that chain, found by
  pointer doubling (a join on the unique call key per round, rounds written to the shared folder), so it takes the
  logarithm of the longest chain and never looks at a conversation as a whole; ``(level, turn, call_id)`` is a topological order.
* Arguments are parsed as a variant and checked against the tool's schema (name, parameter, type, required).
* A call is serialised as canonical JSON: keys sorted at every depth, no white space.

Cases: a call without result has ``result`` null and the error ``no_result``; a result without call is kept with the error
``no_call``; a chain that does not end (a cycle) has level null and the error ``cycle``; an ``after`` that names no call counts as none, with the error
``unknown_after``; arguments that are null or no JSON object give ``bad_arguments``, an unknown tool ``unknown_tool``; different calls
of one id are all kept with the error ``duplicate_id`` (their level is that of the first by turn), all with the id's
smallest result; its other results are rows of their own with the error ``duplicate_result``; a number without fraction is an integer
however it is written (``3.0``, 20 digits); rows with a null conversation or call id cannot be linked and are kept one by one with ``no_id``; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aerostat.llm.common import table, written

#: JSON types of schemas, by the names that Spark gives a variant's
_TYPES = (("string", "STRING"), ("integer", "BIGINT"), ("boolean", "BOOLEAN"), ("number", "DOUBLE"), ("number", "DECIMAL"),
          ("number", "FLOAT"), ("array", "ARRAY"), ("object", "OBJECT"), ("null", "VOID"))


def json_type(kind: Column) -> Column:
    """The JSON type of a variant type's name."""
    out = F.lit("other")
    for name, start in reversed(_TYPES):
        out = F.when(kind.startswith(start), F.lit(name)).otherwise(out)
    return out


def _distinct(rows: DataFrame, *values: str) -> DataFrame:
    """Rows with an id, equal ones merged, with ``copies``."""
    return rows.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id", *values).agg(F.count("*").alias("copies"))


def _first_of_id(rows: DataFrame, *values: str) -> DataFrame:
    """Per id its smallest row by ``values`` and how many different ones there are."""
    return (rows.groupBy("conv_id", "call_id").agg(F.min(F.struct(*values)).alias("r"), F.count("*").alias("different"))
            .select("conv_id", "call_id", "r.*", "different"))


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level, dangling`` of calls with unique ids; level null on a cycle."""
    known = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    state = (calls.select("conv_id", "call_id", "after").join(known, ["conv_id", "after"], "left")
             .select("conv_id", "call_id", F.when(F.col("known"), F.col("after")).alias("up"),
                     (F.col("after").isNotNull() & F.col("known").isNull()).alias("dangling")))
    state = written(state.withColumn("level", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "chat-levels")
    open_now, open_before, rounds = state.where("up IS NOT NULL").count(), -1, 0
    total = state.count()
    while open_now and (1 << rounds) <= total:  # a chain has at most as many steps as there are calls
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("level").alias("more"))
        done = state.where("up IS NULL").select("conv_id", "call_id", "up", "dangling", "level")
        step = (state.where("up IS NOT NULL").join(above, ["conv_id", "up"])
                .select("conv_id", "call_id", F.col("next").alias("up"), "dangling", (F.col("level") + F.col("more")).alias("level")))
        state, rounds = written(done.unionByName(step), "chat-levels"), rounds + 1
        open_before, open_now = open_now, state.where("up IS NOT NULL").count()
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"), "dangling")


def validate(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``errors`` (sorted names of what is wrong with the arguments) and ``canonical`` arguments."""
    tools = (schemas.groupBy("name").agg(F.collect_set(F.struct("parameter", "type", F.coalesce("required", F.lit(False)).alias("required"))).alias("parameters")))
    parsed = F.try_parse_json(F.col("arguments"))
    fields = F.from_json(F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.col("arguments")), "map<string,variant>")
    with_fields = calls.join(tools, "name", "left").withColumn("canonical", F.to_json(parsed)).withColumn("fields", fields)
    whole = lambda v: F.try_variant_get(v, "$", "double") == F.rint(F.try_variant_get(v, "$", "double"))
    kind = lambda v: F.when((json_type(F.schema_of_variant(v)) == "number") & whole(v), F.lit("integer")).otherwise(json_type(F.schema_of_variant(v)))
    given = F.transform(F.map_entries("fields"), lambda e: F.struct(e["key"].alias("key"), kind(e["value"]).alias("type")))
    with_fields = with_fields.withColumn("given", given)

    def type_of(parameter: Column) -> Column:
        return F.element_at(F.map_from_entries("given"), parameter)
    fits = lambda p: (type_of(p["parameter"]) == p["type"]) | ((p["type"] == "number") & (type_of(p["parameter"]) == "integer"))
    missing = F.transform(F.filter("parameters", lambda p: p["required"] & type_of(p["parameter"]).isNull()), lambda p: F.concat(F.lit("missing:"), p["parameter"]))
    wrong = F.transform(F.filter("parameters", lambda p: type_of(p["parameter"]).isNotNull() & ~fits(p)), lambda p: F.concat(F.lit("type:"), p["parameter"]))
    names = F.transform("parameters", lambda p: p["parameter"])
    extra = F.transform(F.filter("given", lambda g: ~F.array_contains(names, g["key"])), lambda g: F.concat(F.lit("unexpected:"), g["key"]))
    errors = (F.when(F.col("parameters").isNull(), F.array(F.lit("unknown_tool"))).when(F.col("fields").isNull(), F.array(F.lit("bad_arguments")))
              .otherwise(F.array_sort(F.concat(missing, wrong, extra))))
    return with_fields.withColumn("errors", errors).drop("parameters", "fields", "given")


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Link, order, validate and serialise.

    ``calls``: conv_id, call_id (string), turn, name, arguments (JSON text), after (a call id or null);
    ``results``: conv_id, call_id, content; ``schemas``: name, parameter, type, required.
    Returns conv_id, call_id, turn, level, name, valid, errors, copies, json.
    """
    calls = calls.select("conv_id", F.col("call_id").cast("string").alias("call_id"), F.col("turn").cast("long").alias("turn"), "name", "arguments",
                         F.col("after").cast("string").alias("after"))
    results = results.select("conv_id", F.col("call_id").cast("string").alias("call_id"), "content")
    own = written(_distinct(calls, "turn", "name", "arguments", "after"), "chat-calls")
    ids = written(_first_of_id(own, "turn", "after"), "chat-ids")  # without the arguments
    answers = written(_distinct(results, "content"), "chat-results")
    chosen = written(_first_of_id(answers, "content").select("conv_id", "call_id", F.col("content").alias("chosen")), "chat-chosen")
    answers = answers.join(chosen, ["conv_id", "call_id"]).withColumn("extra", ~F.col("content").eqNullSafe(F.col("chosen"))).drop("chosen")
    first = answers.where("NOT extra").select("conv_id", "call_id", "content", F.lit(True).alias("answered"), F.col("copies").alias("given"))
    known = ids.select("conv_id", "call_id", (F.col("different") > 1).alias("reused")).join(levels(ids), ["conv_id", "call_id"])
    linked = (validate(own.withColumn("called", F.lit(True)), schemas).join(known, ["conv_id", "call_id"], "left")
              .join(first, ["conv_id", "call_id"], "full"))
    others = (answers.where("extra").join(ids.select("conv_id", "call_id", F.lit(True).alias("has_call")), ["conv_id", "call_id"], "left")
              .select("conv_id", "call_id", "content", "copies", F.when(F.col("has_call"), F.array(F.lit("duplicate_result")))
                      .otherwise(F.array(F.lit("duplicate_result"), F.lit("no_call"))).alias("errors")))
    lost = (calls.where("conv_id IS NULL OR call_id IS NULL").select("conv_id", "call_id", "turn", "name", "arguments", F.lit(None).cast("string").alias("content"))
            .unionByName(results.where("conv_id IS NULL OR call_id IS NULL").select("conv_id", "call_id", "content"), allowMissingColumns=True)
            .withColumn("errors", F.array(F.lit("no_id"))).withColumn("canonical", F.to_json(F.try_parse_json("arguments")))
            .select("conv_id", "call_id", "turn", F.lit(None).cast("long").alias("level"), "name", "canonical", "content", "errors", F.lit(1).cast("long").alias("copies")))
    note = lambda when, name: F.when(when, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    called, answered = F.coalesce("called", F.lit(False)), F.coalesce("answered", F.lit(False))
    errors = F.array_sort(F.concat(F.coalesce("errors", F.array().cast("array<string>")), note(~called, "no_call"), note(~answered, "no_result"),
                                   note(called & F.col("level").isNull(), "cycle"), note(F.coalesce("dangling", F.lit(False)), "unknown_after"),
                                   note(F.coalesce("reused", F.lit(False)), "duplicate_id")))
    rows = linked.select("conv_id", "call_id", "turn", "level", "name", "canonical", "content", errors.alias("errors"), F.coalesce("copies", "given").alias("copies"))
    rows = rows.unionByName(lost).unionByName(others, allowMissingColumns=True)

    def text(c: str) -> Column:  # a JSON string or null
        return F.coalesce(F.expr(f"substr(to_json(named_struct('x', {c})), 6, length(to_json(named_struct('x', {c}))) - 6)"), F.lit("null"))

    def quoted(c: str) -> Column:
        return F.when(F.col(c).isNull(), F.lit("null")).otherwise(text(c))
    json = F.concat(F.lit('{"arguments":'), F.coalesce("canonical", F.lit("null")), F.lit(',"call_id":'), quoted("call_id"),
                    F.lit(',"conv_id":'), F.coalesce(F.to_json(F.array("conv_id")).substr(F.lit(2), F.length(F.to_json(F.array("conv_id"))) - 2), F.lit("null")),
                    F.lit(',"errors":'), F.to_json("errors"), F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
                    F.lit(',"name":'), quoted("name"), F.lit(',"result":'), quoted("content"), F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"))
    return rows.select("conv_id", "call_id", "turn", "level", "name", (F.size("errors") == 0).alias("valid"), "errors", "copies", json.alias("json"))


TOOLS = [("search", "query", "string", True), ("search", "limit", "integer", False),
         ("count", "text", "string", True), ("count", "exact", "boolean", True),
         ("note", "body", "string", True), ("note", "tags", "array", False)]


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the conversations imply: each user turn calls a tool, the assistant turn after it answers."""
    user = conversations.where("role = 'user'")
    size = F.length("text")
    arguments = (F.when(size % 3 == 0, F.to_json(F.struct(F.col("text").alias("query"), F.when(size % 5 == 0, size.cast("string")).alias("limit"))))
                 .when(size % 3 == 1, F.to_json(F.struct(F.col("text").alias("text"), F.when(size % 7 != 0, size % 2 == 0).alias("exact"))))
                 .otherwise(F.to_json(F.struct(F.array(F.col("role")).alias("tags"), F.col("text").alias("body")))))
    name = F.when(size % 3 == 0, "search").when(size % 3 == 1, "count").when(size % 3 == 2, "note")
    call_id = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    after = F.concat(F.lit("call-"), (F.col("turn") - 2).cast("string"))
    calls = user.select("conv_id", call_id.alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), F.when(F.col("turn") >= 2, after).alias("after"))
    answer = F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string"))
    return calls, conversations.where("role = 'assistant'").select("conv_id", answer.alias("call_id"), F.col("text").alias("content"))


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All calls of all conversations, linked to their results."""
    calls, results = conversation_calls(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(TOOLS, "name string, parameter string, type string, required boolean")
    return link_calls(calls, results, schemas).withColumn("errors", F.array_join("errors", ","))


OP4_SQL = """
WITH RECURSIVE c AS (
  SELECT conv_id, turn, role, text, count(*) AS copies FROM conversations GROUP BY ALL),
calls AS (
  SELECT conv_id, 'call-' || turn AS call_id, turn, length(text) AS n, text, copies, count(*) OVER (PARTITION BY conv_id, turn) > 1 AS reused,
         CASE length(text) % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'count' WHEN 2 THEN 'note' END AS name,
         EXISTS (SELECT 1 FROM c AS p WHERE p.role = 'user' AND p.conv_id = u.conv_id AND p.turn = u.turn - 2) AS linked
  FROM c AS u WHERE role = 'user'),
ids AS (SELECT DISTINCT conv_id, call_id, turn, linked FROM calls),
lv AS (
  SELECT conv_id, turn, CAST(0 AS BIGINT) AS level FROM ids WHERE NOT linked
  UNION ALL
  SELECT k.conv_id, k.turn, lv.level + 1 FROM ids AS k JOIN lv ON k.conv_id = lv.conv_id AND k.turn = lv.turn + 2 WHERE k.linked),
res AS (
  SELECT conv_id, 'call-' || (turn - 1) AS call_id, text AS content, copies,
         row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) AS nth
  FROM c WHERE role = 'assistant'),
j AS (
  SELECT coalesce(k.conv_id, r.conv_id) AS conv_id, coalesce(k.call_id, r.call_id) AS call_id, k.turn, lv.level, k.name, k.text, k.n,
         coalesce(k.copies, r.copies) AS copies, k.call_id IS NOT NULL AS called, r.call_id IS NOT NULL AS answered, r.content, coalesce(k.linked, true) AS linked,
         coalesce(k.reused, false) AS reused, false AS extra
  FROM calls AS k LEFT JOIN lv USING (conv_id, turn)
  FULL JOIN (SELECT * FROM res WHERE nth = 1) AS r ON k.conv_id = r.conv_id AND k.call_id = r.call_id
  UNION ALL
  SELECT r.conv_id, r.call_id, NULL, NULL, NULL, NULL, NULL, r.copies,
         EXISTS (SELECT 1 FROM ids WHERE ids.conv_id = r.conv_id AND ids.call_id = r.call_id), true, r.content, true, false, true
  FROM res AS r WHERE nth > 1),
e AS (
  SELECT *, CASE name
      WHEN 'search' THEN '{' || CASE WHEN n % 5 = 0 THEN '"limit":"' || n || '",' ELSE '' END || '"query":' || to_json(text) || '}'
      WHEN 'count' THEN '{' || CASE WHEN n % 7 <> 0 THEN '"exact":' || CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END || ',' ELSE '' END || '"text":' || to_json(text) || '}'
      WHEN 'note' THEN '{"body":' || to_json(text) || ',"tags":["user"]}' END AS arguments,
    list_sort(list_filter([
      CASE WHEN name = 'search' AND n % 5 = 0 THEN 'type:limit' END, CASE WHEN name = 'count' AND n % 7 = 0 THEN 'missing:exact' END,
      CASE WHEN reused THEN 'duplicate_id' END, CASE WHEN extra THEN 'duplicate_result' END, CASE WHEN NOT called THEN 'no_call' END, CASE WHEN NOT answered THEN 'no_result' END,
      CASE WHEN called AND NOT linked AND turn >= 2 THEN 'unknown_after' END], lambda x: x IS NOT NULL)) AS errs
  FROM j)
SELECT conv_id, call_id, turn, level, name, len(errs) = 0 AS valid, array_to_string(errs, ',') AS errors, copies,
  '{"arguments":' || coalesce(arguments, 'null') || ',"call_id":"' || call_id || '","conv_id":' || conv_id ||
  ',"errors":[' || coalesce(array_to_string(list_transform(errs, lambda x: '"' || x || '"'), ','), '') || '],"level":' || coalesce(CAST(level AS VARCHAR), 'null') ||
  ',"name":' || coalesce('"' || name || '"', 'null') || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') ||
  ',"turn":' || coalesce(CAST(turn AS VARCHAR), 'null') || '}' AS json
FROM e
"""
