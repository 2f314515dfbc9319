import json

from catalogflow.llm import tool_links
from catalogflow.llm.queries import QUERIES, SQL
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SCHEMAS = {"find": {"type": "object", "required": ["q"], "properties": {"q": {"type": "string"}}}}


def calls(*found):
    return json.dumps({"tool_calls": [{"name": "find", "arguments": {"q": "x"}, **c} for c in found]})


def result(of, content="r"):
    return json.dumps({"tool_call_id": of, "content": content})


def run(spark, data):
    turns = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    found = tool_links.format_turns(turns.selectExpr("*", "1 conv", "2 message", "3 place"), SCHEMAS).collect()
    return sorted(found, key=lambda r: (r.conv_id or 0, r.order_turn or 0, r.order_level, r.turn or 0))


def test_results_follow_their_calls(spark):
    found = run(
        spark,
        [
            (1, 0, "tool", result("b")), (1, 1, "tool", result("a")), (1, 2, "assistant", calls({"id": "a"})),
            (1, 3, "assistant", calls({"id": "b", "depends_on": ["a"]}, {"id": "c"})), (1, 4, "user", "t"),
        ],
    )
    assert [r.turn for r in found] == [2, 1, 3, 0, 4]
    assert [r.status for r in found] == ["calls", "result", "calls", "result", "text"]
    assert [(r.n_calls, r.n_answered, r.n_invalid) for r in found if r.n_calls] == [(1, 1, 0), (2, 1, 0)]


def test_broken_links(spark):
    found = run(
        spark,
        [
            (1, 0, "assistant", calls({"id": "a", "depends_on": ["b"]})),
            (1, 1, "assistant", calls({"id": "b", "depends_on": "a"})),
            (2, 0, "assistant", calls({"id": 7, "arguments": '{"q": 1}'}, {"id": 8, "arguments": "{"})),
            (2, 1, "tool", result(7)), (2, 2, "tool", result(7)), (2, 3, "tool", result("zz")),
            (2, 4, "assistant", calls({"id": 7, "name": "other"})), (2, 5, "assistant", "{oops"),
            (None, None, None, None), (2, None, "tool", result(7)), (2, 6, "tool", "[" * 5000),
        ],
    )
    by = {(r.conv_id, r.turn): r for r in found}
    assert [by[1, t].status for t in (0, 1)] == ["cyclic", "cyclic"]
    assert [by[2, t].status for t in range(7)] == [
        "calls", "result", "repeated", "orphan", "repeated", "text", "text",
    ]
    assert by[2, 0].n_invalid == 2 and by[2, 4].n_invalid == 1
    assert by[None, None].message == '{"content":null,"role":null}'
    assert by[2, None].status == "orphan"


def test_canonical_json(spark):
    (row,) = run(spark, [(1, 0, "assistant", calls({"id": "é", "arguments": {"z": 1, "q": "\n"}}))])
    assert row.message == (
        '{"content":null,"role":"assistant","tool_calls":'
        '[{"arguments":{"q":"\\n","z":1},"id":"é","name":"find"}]}'
    )
    assert run(spark, [])  == []


def test_schemas():
    schema = {
        "type": "object", "additionalProperties": False,
        "properties": {"n": {"type": ["integer", "null"], "minimum": 1, "maximum": 3}, "k": {"enum": ["a"]},
                       "l": {"type": "array", "items": {"type": "number"}}},
    }
    good = [{}, {"n": 1}, {"n": None}, {"k": "a"}, {"l": [1, 2.5]}]
    bad = [1, {"n": 0}, {"n": 4}, {"n": True}, {"n": 1.5}, {"k": "b"}, {"l": ["x"]}, {"z": 1}]
    assert [tool_links.errors_of(v, schema) for v in good] == [[]] * 5
    assert all(tool_links.errors_of(v, schema) for v in bad)


def test_no_turn_ends_the_job(spark):
    deep = '{"tool_calls":' + "[" * 900 + "]" * 900 + "}"
    texts = [
        r'{"content":"\ud800","tool_calls":[]}',
        r'{"tool_calls":[{"id":"\udfff x","name":"find","arguments":{"q":"\ud83d\ude00 \ud83d"}}]}',
        '{"tool_calls":[{"id":1,"name":["find"],"arguments":{}}]}',
        '{"tool_calls":[{"id":2,"name":"find","arguments":{"q":NaN}}]}',
        '{"tool_calls":[{"id":3,"name":"find","arguments":{"q":1e400}}]}',
        '{"tool_calls":[{"id":4,"name":"find","arguments":"{\\"q\\": -Infinity}"}]}',
        '{"tool_calls":[{"id":5,"name":"find","arguments":' + "9" * 5000 + "}]}",
        '{"tool_calls":[5,null,"x",{"id":null},{"name":"find"}]}',
        deep, '{"tool_calls":{}}', "{" * 3000,
    ]
    found = run(spark, [(1, i, "assistant", t) for i, t in enumerate(texts)])
    assert [r.turn for r in found] == list(range(len(texts)))
    for r in found:
        # Every message is JSON, and its own canonical form.
        value = json.loads(r.message, parse_constant=lambda x: 1 / 0)
        assert tool_links.canonical(value) == r.message
    by = {r.turn: r for r in found}
    assert json.loads(by[0].message)["content"] == "\ud800"
    assert json.loads(by[1].message)["tool_calls"][0]["arguments"] == {"q": "\U0001f600 \ud83d"}
    assert [(by[t].n_calls, by[t].n_invalid) for t in (1, 2, 3, 4, 5, 6, 7)] == [
        (1, 0), (1, 1), (0, 0), (0, 0), (1, 1), (0, 0), (0, 0),
    ]


def test_json_schema_types():
    errors = tool_links.errors_of
    assert not errors(1.0, {"type": "integer"}) and errors(1.5, {"type": "integer"})
    assert errors(True, {"enum": [1]}) and errors(1, {"enum": [True]}) and not errors(1.0, {"enum": [1]})
    assert errors([True], {"enum": [[1]]}) and not errors({"a": [1, None]}, {"enum": [{"a": [1.0, None]}]})
    assert errors("x", {"type": "text"}) and not errors("x", {"type": ["text", "string"]})


def test_equals_sql(spark):
    name = "op6_tool_links"
    assert compare(spark, connect(SF), QUERIES[name], SQL[name], SF) is None
