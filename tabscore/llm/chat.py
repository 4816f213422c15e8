"""Chat formatting: tool-call linking, ordering, argument validation and canonical JSON.

Calls and results meet in a hash join on (conversation, identifier).  A call may name another call in ``after``: it
stands after that call's results.  Order: every message has the key ``(anchor, depth, turn, kind)``; ``anchor`` is the largest turn among
the message and all it depends on, ``depth`` the number of messages it depends on in a row.  Sorting a conversation by the key is
a topological order that moves a message only if its dependencies stand later.  Dependencies are followed by pointer
doubling: the rounds grow with the logarithm of the longest chain, and what is still open when a round settles nothing is a
cycle.  No conversation is gathered: the result has one row per message, so a conversation of any length is spread like its rows.

Canonical JSON: keys in ascending order, no white space, numbers and strings as Spark's variant writes them.

DataFrame functions only.  Defined results (``status``): ``ok``; ``unanswered`` (a call without result); ``orphan`` (a
result without call); ``duplicate`` (a call whose identifier a call of an earlier turn has; results belong to the earliest, ties: the smaller
argument text); ``bad_json``; ``invalid`` (``errors`` lists parameters); ``missing`` (``after`` names no call); ``cycle``.  Messages with
a null conversation or turn are ``unplaced``, and a null identifier links with nothing.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.common import keep, read

#: JSON types by the names of variant types.
KINDS = {"string": "STRING", "integer": "(TINYINT|SMALLINT|INT|BIGINT)", "number": r"(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(.*\))",
         "boolean": "BOOLEAN", "array": "ARRAY<.*>", "object": "OBJECT<.*>"}


def errors(args: Column, schema: dict) -> Column:
    """Comma-joined faults of a variant object against ``{parameter: {type, required, enum, minimum, maximum}}``."""
    faults = []
    for name, rule in sorted(schema.items()):
        path = f"$['{name}']"
        value = F.try_variant_get(args, path, "variant")
        kind = F.schema_of_variant(value)
        absent = value.isNull() | (kind == "VOID")
        if rule.get("required"):
            faults.append(F.when(absent, f"{name}:missing"))
        if "type" in rule:
            faults.append(F.when(~absent & ~kind.rlike(f"^{KINDS[rule['type']]}$"), f"{name}:type"))
        if "enum" in rule:
            faults.append(F.when(~absent & ~F.coalesce(F.try_variant_get(args, path, "string").isin(rule["enum"]), F.lit(False)), f"{name}:enum"))
        for bound, low in (("minimum", True), ("maximum", False)):
            if bound in rule:
                x = F.try_variant_get(args, path, "double")
                faults.append(F.when((x < rule[bound]) if low else (x > rule[bound]), f"{name}:{bound}"))
    keys = F.json_object_keys(F.to_json(args))
    faults.append(F.when(F.schema_of_variant(args).rlike("^OBJECT<") & (F.size(F.array_except(keys, F.array(*map(F.lit, sorted(schema))))) > 0), "unknown:parameter"))
    faults.append(F.when(~F.schema_of_variant(args).rlike("^OBJECT<"), "arguments:type"))
    return F.concat_ws(",", *faults)


def faults_of(tool: Column, args: Column, schemas: dict) -> Column:
    """Faults by the tool's schema; a tool without one is a fault."""
    out = F.lit("tool:unknown")
    for name, schema in sorted(schemas.items()):
        out = F.when(tool == name, errors(args, schema)).otherwise(out)
    return out


def order_calls(calls: DataFrame, answered: DataFrame) -> DataFrame:
    """``(conv, id, anchor, depth, state)`` of every call: ``calls(conv, id, turn, after)`` with distinct ids,
    ``answered(conv, id, last)`` the last turn of its results."""
    nodes = calls.join(answered, ["conv", "id"], "left").select(
        "conv", "id", "turn", "after", F.greatest("turn", F.coalesce("last", "turn")).alias("end"), F.when(F.col("last").isNull(), 1).otherwise(2).alias("step"))
    up = nodes.select("conv", F.col("id").alias("after"), F.col("end").alias("mx"), F.col("step").cast("long").alias("dp"), F.lit(True).alias("there"))
    state = keep(nodes.select("conv", "id", "turn", "after").join(up, ["conv", "after"], "left").select(
        "conv", "id", "turn", F.when(F.col("there"), F.col("after")).alias("ptr"), "mx", F.coalesce("dp", F.lit(0)).alias("dp"),
        (F.col("after").isNotNull() & F.col("there").isNull()).alias("missing")))
    left = state.where("ptr is not null").count()
    while left:
        far = state.select("conv", F.col("id").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("mx").alias("mx2"), F.col("dp").alias("dp2"))
        state = keep(state.join(far, ["conv", "ptr"], "left").select(
            "conv", "id", "turn", F.col("ptr2").alias("ptr"), F.greatest("mx", "mx2").alias("mx"), (F.col("dp") + F.coalesce("dp2", F.lit(0))).alias("dp"), "missing"))
        now = state.where("ptr is not null").count()
        if now == left:
            break
        left = now
    loop = F.col("ptr").isNotNull()
    return state.select("conv", "id", F.when(loop, F.col("turn")).otherwise(F.greatest("turn", F.coalesce("mx", "turn"))).alias("anchor"),
                        F.when(loop, 0).otherwise(F.col("dp")).cast("long").alias("depth"),
                        F.when(loop, "cycle").when(F.col("missing"), "missing").otherwise("ok").alias("state"))


def link(messages: DataFrame, schemas: dict) -> DataFrame:
    """One row per message of ``messages(conv, turn, kind, role, text, id, tool, args, after)``, ``kind`` one of ``plain``, ``call`` and ``result``:
    conv, turn, kind, anchor, depth, status, errors, json."""
    messages = messages.select("conv", "turn", "kind", "role", "text", "id", "tool", "args", "after")
    fit = F.col("conv").isNotNull() & F.col("turn").isNotNull()
    named = messages.where(fit & F.col("id").isNotNull())
    rows = named.where("kind = 'call'")
    first = rows.groupBy("conv", "id").agg(F.min(F.struct("turn", "args", "after")).alias("x")).select(
        "conv", "id", F.col("x.turn").alias("turn"), F.col("x.after").alias("after"), F.col("x.args").alias("args"))
    answered = named.where("kind = 'result'").groupBy("conv", "id").agg(F.max("turn").alias("last"))
    placed = order_calls(first.select("conv", "id", "turn", "after"), answered)
    known = placed.join(first.select("conv", "id", F.col("turn").alias("first_turn"), F.col("args").alias("first_args")), ["conv", "id"]).join(answered, ["conv", "id"], "left")
    all_ = messages.join(known, ["conv", "id"], "left")
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    linked = F.col("first_turn").isNotNull()
    parsed = F.try_parse_json("args")
    rows = all_.withColumn("v", F.when(call, parsed)).withColumn("errors", F.when(call & F.col("v").isNotNull(), faults_of(F.col("tool"), F.col("v"), schemas)).otherwise(""))
    status = (F.when(~fit, "unplaced")
              .when(call & linked & ~((F.col("turn") == F.col("first_turn")) & F.col("args").eqNullSafe(F.col("first_args"))), "duplicate")
              .when(call & F.col("v").isNull(), "bad_json").when(call & (F.col("errors") != ""), "invalid")
              .when(call & linked & (F.col("state") != "ok"), F.col("state"))
              .when(call & (~linked | F.col("last").isNull()), "unanswered").when(result & ~linked, "orphan").otherwise("ok"))
    anchor = F.when(call & linked, F.greatest("turn", "anchor")).when(result & linked, F.greatest("turn", "anchor")).otherwise(F.col("turn"))
    depth = F.when(call & linked, F.col("depth")).when(result & linked, F.col("depth") + 1).otherwise(0).cast("long")
    function = F.when(call, F.struct(F.when(F.col("v").isNotNull(), F.col("v")).otherwise(F.to_variant_object(F.struct(F.col("args").alias("raw")))).alias("arguments"),
                                     F.col("id"), F.col("tool").alias("name")))
    body = F.struct(F.when(~call, F.col("text")).alias("content"), F.col("role"), function.alias("tool_call"), F.when(result, F.col("id")).alias("tool_call_id"))
    return rows.select("conv", "turn", "kind", anchor.alias("anchor"), depth.alias("depth"), status.alias("status"), "errors", F.to_json(body).alias("json"))


# ---- the query -----------------------------------------------------------------------------------------------------

SCHEMAS = {"answer": {"prompt": {"type": "string", "required": True}, "words": {"type": "integer", "required": True, "minimum": 2},
                      "style": {"type": "string", "enum": ["short", "long"]}}}


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_replace(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("s"))), r'(?s)^\{"s":(.*)\}$', "$1")


def from_conversations(conv: DataFrame) -> DataFrame:
    """Tool messages that the ``conversations`` table yields: a user's turn is a call of ``answer`` with the text as prompt, and an
    assistant's turn is the result of the call of the turn before.  Every second call of a conversation is to stand after the one before it."""
    user, helper = F.col("role") == "user", F.col("role") == "assistant"
    ident = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    n = F.size(F.split(F.coalesce("text", F.lit("")), " ", -1))
    number = F.when(n % 7 == 0, F.concat(F.lit('"'), n.cast("string"), F.lit('"'))).otherwise(n.cast("string"))
    args = F.concat(F.lit('{ "words": '), number, F.lit(', "style": "'), F.when(n % 5 == 0, "odd").when(n < 20, "short").otherwise("long"),
                    F.lit('", "prompt": '), quoted(F.col("text")), F.lit("}"))
    return conv.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                       F.when(user, "call").when(helper, "result").otherwise("plain").alias("kind"),
                       F.when(user, "assistant").when(helper, "tool").otherwise(F.col("role")).alias("role"), "text",
                       F.when(user, ident(F.col("turn"))).when(helper, ident(F.col("turn") - 1)).alias("id"), F.when(user, "answer").alias("tool"),
                       F.when(user, args).alias("args"), F.when(user & (F.col("turn") % 4 == 2), ident(F.col("turn") - 2)).alias("after"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``: conv_id, turn, kind, anchor, depth, status, errors, json (canonical)."""
    return link(from_conversations(read(spark, sf_dir, "conversations")), SCHEMAS).withColumnRenamed("conv", "conv_id")


QUERIES = {"op9_chat_format": op9_chat_format}

ORACLE = {"op9_chat_format": """
WITH m AS (SELECT conv_id, turn, role, text, len(string_split(coalesce(text, ''), ' ')) AS n, CAST(to_json(coalesce(text, '')) AS VARCHAR) AS j FROM conversations),
p AS (
  SELECT m.*, prev.role = 'user' AS has_call, nxt.role = 'assistant' AS answered, ref.role = 'user' AS has_ref, refnext.role = 'assistant' AS ref_answered,
         callref.role = 'user' AS call_has_ref, callrefnext.role = 'assistant' AS call_ref_answered
  FROM m
  LEFT JOIN conversations prev ON prev.conv_id = m.conv_id AND prev.turn = m.turn - 1
  LEFT JOIN conversations nxt ON nxt.conv_id = m.conv_id AND nxt.turn = m.turn + 1
  LEFT JOIN conversations ref ON m.turn % 4 = 2 AND ref.conv_id = m.conv_id AND ref.turn = m.turn - 2
  LEFT JOIN conversations refnext ON m.turn % 4 = 2 AND refnext.conv_id = m.conv_id AND refnext.turn = m.turn - 1
  LEFT JOIN conversations callref ON m.turn % 4 = 3 AND callref.conv_id = m.conv_id AND callref.turn = m.turn - 3
  LEFT JOIN conversations callrefnext ON m.turn % 4 = 3 AND callrefnext.conv_id = m.conv_id AND callrefnext.turn = m.turn - 2),
e AS (
  SELECT *, CASE WHEN role = 'user' THEN concat_ws(',', CASE WHEN n % 5 = 0 THEN 'style:enum' END, CASE WHEN n % 7 = 0 THEN 'words:type' END,
    CASE WHEN n < 2 THEN 'words:minimum' END) ELSE '' END AS errors FROM p)
SELECT conv_id, turn, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'plain' END AS kind, turn AS anchor,
  CAST(CASE WHEN role = 'user' AND coalesce(has_ref, false) THEN CASE WHEN coalesce(ref_answered, false) THEN 2 ELSE 1 END
            WHEN role = 'assistant' AND coalesce(has_call, false)
              THEN 1 + CASE WHEN NOT coalesce(call_has_ref, false) THEN 0 WHEN coalesce(call_ref_answered, false) THEN 2 ELSE 1 END
            ELSE 0 END AS BIGINT) AS depth,
  CASE WHEN role = 'user' AND errors <> '' THEN 'invalid' WHEN role = 'user' AND turn % 4 = 2 AND NOT coalesce(has_ref, false) THEN 'missing'
       WHEN role = 'user' AND NOT coalesce(answered, false) THEN 'unanswered' WHEN role = 'assistant' AND NOT coalesce(has_call, false) THEN 'orphan' ELSE 'ok' END AS status,
  errors,
  CASE WHEN role = 'user' THEN '{"role":"assistant","tool_call":{"arguments":{"prompt":' || j || ',"style":"' || CASE WHEN n % 5 = 0 THEN 'odd' WHEN n < 20 THEN 'short' ELSE 'long' END
       || '","words":' || CASE WHEN n % 7 = 0 THEN '"' || n || '"' ELSE CAST(n AS VARCHAR) END || '},"id":"call-' || turn || '","name":"answer"}}'
       WHEN role = 'assistant' THEN '{"content":' || j || ',"role":"tool","tool_call_id":"call-' || (turn - 1) || '"}'
       ELSE '{"content":' || j || ',"role":"' || role || '"}' END AS json
FROM e
"""}
