"""Linking and ordering against plain Python, and the query against its SQL."""

import json

import duckdb
import pytest

from tabscore.llm import chat

COLUMNS = "conv long, turn long, kind string, role string, text string, id string, tool string, args string, after string, json string"


def call(conv, turn, id, args='{"b": 1, "a": "x"}', tool="f", after=None):
    return (conv, turn, "call", "assistant", None, id, tool, args, after, "z")


def result(conv, turn, id):
    return (conv, turn, "result", "tool", f"r{turn}", id, None, None, None, "z")


SCHEMAS = {"f": {"a": {"type": "string", "required": True}, "b": {"type": "number", "maximum": 5}}}


def test_statuses_order_and_json(spark):
    rows = [call(1, 5, "x"), result(1, 2, "x"),                      # result before its call: moved behind it
            call(1, 1, "y", after="x"), result(1, 9, "y"),           # y after x's result
            call(1, 6, "z", after="nowhere"), result(1, 7, "q"), call(1, 8, "u"),
            call(1, 10, "x", args='{"a": "later"}'), call(1, 11, "v", args="{no"), call(1, 12, "w", args='{"b": 9, "c": {"e": 1, "d": [2, 1]}}'), result(1, 13, "w"),
            call(1, 14, "g", tool="other"), call(2, 1, "m", after="n"), call(2, 2, "n", after="m"), result(2, 3, "m"), result(2, 4, "n"),
            (None, 1, "plain", "user", "no conversation", None, None, None, None, None), (3, None, "plain", "user", None, None, None, None, None, None),
            call(4, 1, None), (4, 2, "plain", "system", 'say "hi"\n\té', None, None, None, None, None)]
    frame = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 as state", "2 as anchor", "3 as first_turn", "4 as errors")  # clashing names
    out = {(r.conv, r.turn): r for r in chat.link(frame, SCHEMAS).collect()}
    assert len(out) == len(rows)
    status = {k: r.status for k, r in out.items()}
    assert status[1, 5] == status[1, 2] == status[1, 1] == status[1, 9] == status[1, 13] == "ok"
    assert (status[1, 6], status[1, 7], status[1, 8], status[1, 10], status[1, 11]) == ("missing", "orphan", "unanswered", "duplicate", "bad_json")
    assert status[1, 12] == "invalid" and out[1, 12].errors == "a:missing,b:maximum,unknown:parameter" and out[1, 14].errors == "tool:unknown"
    assert status[2, 1] == status[2, 2] == "cycle" and status[None, 1] == status[3, None] == "unplaced" and status[4, 1] == "unanswered"
    order = sorted((r for k, r in out.items() if k[0] == 1), key=lambda r: (r.anchor, r.depth, r.turn, r.kind))
    at = [r.turn for r in order]
    assert at.index(5) < at.index(2) < at.index(1) < at.index(9)
    assert json.loads(out[1, 12].json)["tool_call"]["arguments"] == {"b": 9, "c": {"e": 1, "d": [2, 1]}}
    assert '{"b":9,"c":{"d":[2,1],"e":1}}' in out[1, 12].json and '"arguments":{"a":"x","b":1}' in out[1, 5].json
    assert json.loads(out[4, 2].json) == {"content": 'say "hi"\n\té', "role": "system"}
    assert json.loads(out[1, 11].json)["tool_call"]["arguments"] == {"raw": "{no"}


def test_long_chain(spark):
    rows = [call(1, 1000 - i, f"c{i}", after=f"c{i - 1}" if i else None) for i in range(70)]
    out = chat.link(spark.createDataFrame(rows, COLUMNS), SCHEMAS).collect()
    assert {(r.turn, r.anchor, r.depth) for r in out} == {(1000 - i, 1000, i) for i in range(70)}


def test_empty(spark):
    assert chat.link(spark.createDataFrame([], COLUMNS), SCHEMAS).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('/root/testdata/{sf}/conversations.parquet')")
    want = sorted(con.execute(chat.ORACLE["op9_chat_format"]).fetchall())
    got = sorted(tuple(r) for r in chat.op9_chat_format(spark, f"/root/testdata/{sf}").collect())
    assert got == want and len({r[5] for r in got}) >= 2
