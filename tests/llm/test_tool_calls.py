import json

from shelfwatch.llm.tool_calls import link_tool_calls, messages_from_turns

SCHEMA = "conv_id bigint, turn bigint, text string, id string, status string, record string"


def call(conv, turn, ident, name="translate", arguments=None, after=None):
    body = {"id": ident, "name": name, "arguments": {"text": "t", "to": "de"} if arguments is None else arguments}
    return (conv, turn, json.dumps({"tool_call": body | ({"after": after} if after else {})}), "x", "y", "z")


def result(conv, turn, ident, content="done"):
    return (conv, turn, json.dumps({"tool_result": {"id": ident, "content": content}}), "x", "y", "z")


def linked(rows, *data):
    return {(r.conv_id, r.id): r for r in link_tool_calls(rows(SCHEMA, *data)).collect()}


def test_links_and_statuses(rows):
    got = linked(
        rows, call(1, 0, "a"), result(1, 1, "a"), call(1, 2, "b", after="a"), result(1, 3, "b"), call(1, 4, "c", after="b"),
        result(1, 9, "lost"), call(2, 0, "a"), result(2, 0, "a"), call(2, 1, "r"), call(2, 2, "r"), result(2, 3, "r"), result(2, 4, "r", "later"),
        call(3, 0, "x", after="y"), call(3, 1, "y", after="x"), call(3, 2, "z", after="nowhere"), call(3, 3, "w", after="z"),
    )
    assert {k: r.status for k, r in got.items()} == {
        (1, "a"): "ok", (1, "b"): "ok", (1, "c"): "no result", (1, "lost"): "no call", (2, "a"): "early result", (2, "r"): "repeated call",
        (3, "x"): "cycle", (3, "y"): "cycle", (3, "z"): "missing dependency", (3, "w"): "missing dependency",
    }
    assert [got[1, i].step for i in "abc"] == [0, 1, 2]
    assert (got[2, "r"].n_calls, got[2, "r"].n_results) == (2, 2)
    assert json.loads(got[2, "r"].record)["result"] == "done"
    assert got[1, "b"].record == '{"after":"a","arguments":{"text":"t","to":"de"},"id":"b","name":"translate","result":"done","step":1}'


def test_arguments(rows):
    cases = {
        "fine": ("search", {"limit": 3, "query": "q"}, "no result"), "extra": ("search", {"limit": 3, "query": "q", "zzz": 1}, "unknown zzz"),
        "less": ("search", {"query": "q"}, "missing limit"), "null": ("search", {"query": None, "limit": 1}, "missing query"),
        "type": ("search", {"query": "q", "limit": "three"}, "type limit"), "part": ("search", {"query": "q", "limit": 1.5}, "type limit"),
        "flag": ("search", {"query": "q", "limit": 1, "exact": True}, "no result"), "list": ("search", [1], "no arguments"),
        "tool": ("fly", {}, "unknown tool"),
    }
    got = linked(rows, *[call(1, i, k, name, arguments) for i, (k, (name, arguments, _)) in enumerate(cases.items())])
    assert {i: r.status for (_, i), r in got.items()} == {k: status for k, (_, _, status) in cases.items()}


def test_long_chains_and_their_order(rows):
    data = [call(7, t, f"c{t}", after=f"c{t - 1}" if t % 50 else None) for t in range(150)]
    got = linked(rows, *data)
    assert [got[7, f"c{t}"].step for t in range(150)] == [t % 50 for t in range(150)]


def test_awkward_rows(rows, spark):
    odd = [(1, 0, t, None, None, None) for t in (None, "", "text", "[1]", "{}", '{"tool_call": 3}', '{"tool_call": {"name": "search"}}', "{" * 1000, "x" * 200_000)]
    got = linked(rows, *odd, call(None, 0, "a"), result(None, 1, "a"), call(None, None, "b"), *[call(5, 1, "same")] * 3, *[result(5, 2, "same")] * 3)
    assert {k: r.status for k, r in got.items()} == {(None, "a"): "ok", (None, "b"): "no result", (5, "same"): "repeated call"}
    assert link_tool_calls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_canonical_json(rows):
    got = linked(rows, (1, 0, '{"tool_call": {"name": "translate", "arguments": {"to" : "de", "text":"é\\n\\"q\\""}, "id": "k"}}', "", "", ""))
    assert got[1, "k"].record == '{"arguments":{"text":"é\\n\\"q\\"","to":"de"},"id":"k","name":"translate","step":0}'


def test_messages_of_conversations(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = link_tool_calls(messages_from_turns(turns))
    users = {(r.conv_id, f"c{r.turn}") for r in turns.where("role = 'user'").collect()}
    answers = {(r.conv_id, f"c{r.turn - 1}") for r in turns.where("role = 'assistant'").collect()}
    found = {(r.conv_id, r.id): r for r in got.collect()}
    assert set(found) == users | answers
    assert {k for k, r in found.items() if r.n_results} == answers
    assert {"ok", "missing to", "type max_words", "no result"} <= {r.status for r in found.values()}


def test_calls_of_turns_hold_the_whole_text(rows):
    texts = ["a" * 45 + end for end in ("one", "two")] + ["b" * 400 + "cd", "é\n\"" * 20]
    assert all(len(t) % 3 == 0 for t in texts)
    turns = rows("conv_id bigint, turn bigint, role string, text string", *[(i, 0, "user", t) for i, t in enumerate(texts)])
    got = link_tool_calls(messages_from_turns(turns)).collect()
    assert {r.conv_id: json.loads(r.record)["arguments"]["query"] for r in got} == dict(enumerate(texts))
    assert {r.name for r in got} == {"search"}


def test_several_dependencies(rows):
    after = {
        "a": None, "b": "a", "c": "b", "d": ["a", "c"], "e": ["d"], "f": ["b", "e", "d"], "g": [], "h": ["a", "gone"], "i": "h",
        "l": ["a", "m"], "m": "l", "n": ["m", "b"], "o": ["i", "a"], "p": ["b", None, "b"],
    }
    got = linked(rows, *[call(1, t, i, after=needs) for t, (i, needs) in enumerate(after.items())])
    assert {i: r.step for (_, i), r in got.items()} == {
        "a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5, "g": 0, "h": 1, "i": 2, "l": None, "m": None, "n": None, "o": 3, "p": 2,
    }
    assert {i: r.status for (_, i), r in got.items() if r.status != "no result"} == {
        **dict.fromkeys("hio", "missing dependency"), **dict.fromkeys("lmn", "cycle"),
    }
    assert json.loads(got[1, "d"].record)["after"] == ["a", "c"]


def test_turns_of_other_roles_stay_messages(rows):
    turns = rows("conv_id bigint, turn bigint, role string, text string", (1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, None, "n"))
    messages = messages_from_turns(turns)
    got = {r.turn: json.loads(r.text) for r in messages.collect()}
    assert got[0] == {"message": {"role": "system", "content": "s"}} and got[2] == {"message": {"content": "n"}}
    assert [r.id for r in link_tool_calls(messages).collect()] == ["c1"]


def test_repeated_keys_keep_their_row(rows):
    raw = [
        '{"tool_call": {"id": "a", "name": "translate", "arguments": {"text": "t", "text": "u", "to": "de"}}}',
        '{"tool_call": {"id": "b", "name": "search", "name": "translate", "arguments": {}}}',
        '{"tool_result": {"id": "a", "content": "one", "content": "two"}}',
        '{"tool_call": {"id": "open"', "[1, 2]", "{}", '{"tool_call": 1, "tool_call": 2}',
    ]
    got = linked(rows, *[(1, i, text, "x", "y", "z") for i, text in enumerate(raw)], call(1, 20, "c", after="a"))
    assert {i: r.status for (_, i), r in got.items()} == {"a": "repeated key", "b": "repeated key", "c": "no result"}
    assert json.loads(got[1, "a"].record)["result"] == "two" and "arguments" not in json.loads(got[1, "a"].record)
    assert got[1, "c"].step == 1


def test_turns_without_a_number_keep_their_row(rows):
    turns = rows(
        "conv_id bigint, turn bigint, role string, text string",
        (1, None, "user", "abc"), (1, None, "user", "abd"), (1, None, "assistant", "abc"), (1, None, "user", None), (1, 0, "user", "abc"), (1, 1, "assistant", "r"),
    )
    got = link_tool_calls(messages_from_turns(turns)).collect()
    assert sorted(r.status for r in got) == ["no call", "no result", "no result", "ok", "unknown tool"]
    assert {r.id for r in got if r.status == "ok"} == {"c0"}
    assert [r.n_results for r in got if r.id.startswith("result ")] == [1]
