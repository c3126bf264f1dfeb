"""The provider chain, its DataFrame form, settings and the registry."""

import json

from sluice.operators.providers import ChainConfig, RateLimited, ScriptedProvider, build_providers, chain_config, cut_text, extract, run_chain
from sluice.plans import config
from sluice.sources.http import Answer

GOOD = '{"a": "x"}'


def chain(*outcomes, chunks=("text",), keys=("a",)):
    providers = [ScriptedProvider(f"p{i}", list(o)) for i, o in enumerate(outcomes)]
    return run_chain(list(chunks), providers, "p", list(keys), limit_retries=0, sleep=lambda s: None), providers


def test_falls_through():
    out, ps = chain([429], [500], [GOOD])
    assert out["provider"] == "p2" and json.loads(out["data"]) == {"a": "x"} and [len(p.asked) for p in ps] == [1, 1, 1]
    assert chain([429], [RateLimited("x")])[0]["data"] is None
    assert chain(["[1]"], [GOOD])[0]["provider"] == "p1" and chain(["{}"], [GOOD])[0]["provider"] == "p1"


def test_partial_answers_go_to_the_next_chunk():
    out, (p,) = chain(['{"a": ""}', GOOD], chunks=("one", "two"))
    assert json.loads(out["data"]) == {"a": "x"} and p.asked == ["one", "two"]
    out, (p, q) = chain(['{"a": ""}', 500], ["never", 500], chunks=("one", "two"))
    assert out["data"] is None and q.asked == ["two"]


def test_too_large_is_cut():
    text = "lead\n\n" + "\n\n".join("word " * 200 for _ in range(20))
    out, (p,) = chain([413, GOOD], chunks=(text,))
    assert out["data"] and len(p.asked[1]) < len(text) and p.asked[1] == cut_text(text, 1750)
    assert cut_text("x" * 9000, 500) == "x" * 9000


def test_nothing_configured():
    assert run_chain(["x"], [ScriptedProvider("p", [GOOD], key=" ")], "p", ["a"])["error"] == "no_providers_configured"
    assert run_chain([], [ScriptedProvider("p", [GOOD])], "p", ["a"])["error"] == "empty_content"


def test_waits_over_the_limit():
    waits = []
    p = ScriptedProvider("p", [429, RateLimited("p", 7.0), TimeoutError(), GOOD])
    out = run_chain(["t"], [p], "p", ["a"], sleep=waits.append)
    assert json.loads(out["data"]) == {"a": "x"} and len(p.asked) == 4
    assert 1 <= waits[0] <= 1.5 and waits[1] == 7.0 and 4 <= waits[2] <= 4.5
    p, q, waits = ScriptedProvider("p", [429]), ScriptedProvider("q", [GOOD]), []
    assert run_chain(["t"], [p, q], "p", ["a"], limit_retries=5, sleep=waits.append)["provider"] == "q" and len(p.asked) == 6 and len(waits) == 5


def replies(*answers):
    sent = []

    def post(url, body, headers):
        sent.append((url, body, headers))
        return answers[min(len(sent), len(answers)) - 1]

    return post, sent


def test_adapters():
    """Each format's request and reply, and what its statuses mean."""
    env = {"GEMINI_API_KEY": "g", "GROQ_API_KEY": "q", "GROQ_MODEL": "m", "DEEPSEEK_API_KEY": " "}
    chat = Answer(200, json.dumps({"choices": [{"message": {"content": 'so: {"a": 1}'}}], "usage": {"prompt_tokens": 5, "completion_tokens": 2}}))
    made = Answer(200, json.dumps({"candidates": [{"content": {"parts": [{"text": '{"a": 2}'}]}}], "usageMetadata": {"promptTokenCount": 8, "candidatesTokenCount": 3}}))
    post, sent = replies(made, chat)
    config = ChainConfig()
    providers = build_providers(config, env, post)
    assert [p.name for p in providers] == ["gemini", "groq", "deepseek"] and [p.configured() for p in providers] == [True, True, False]
    one, two = (run_chain(["text"], [p], "prompt", ["a"]) for p in providers[:2])
    assert json.loads(one["data"]) == {"a": 2} and one["usage"] == {"gemini": [8, 3]} and json.loads(two["data"]) == {"a": 1} and two["usage"] == {"groq": [5, 2]}
    assert sent[0][0].endswith(":generateContent") and sent[0][1]["contents"][0]["parts"][0]["text"] == "prompt\n\ntext" and sent[0][2] == {"x-goog-api-key": "g"}
    assert sent[1][1]["model"] == "m" and [m["content"] for m in sent[1][1]["messages"]] == ["prompt", "text"] and sent[1][2] == {"Authorization": "Bearer q"}
    assert sent[0][1]["generationConfig"]["maxOutputTokens"] == sent[1][1]["max_tokens"] == 2000
    for answer, error in ((Answer(200, "{}"), "unexpected shape"), (Answer(200, "no"), "not JSON"), (Answer(500, "oops"), "status 500: oops"), (Answer(599), "status 599: ")):
        p = build_providers(config, env, replies(answer)[0])[1]
        assert run_chain(["t"], [p], "p", ["a"])["error"] == f"RuntimeError: {error}"
    p = build_providers(config, env, replies(Answer(429, None, {"Retry-After": "4"}), Answer(413), chat)[0])[1]
    waits = []
    assert run_chain(["t"], [p], "p", ["a"], sleep=waits.append)["data"] and waits == [4.0]


def test_chain_config():
    assert chain_config({}) == ChainConfig() == ChainConfig(("gemini", "groq", "deepseek"), 3500, 200, 2000, 5, 3)
    own = chain_config({"llm": {"provider_order": ["groq", "unknown"], "max_413_retries": 1}})
    assert own.order == ("groq", "unknown") and own.size_retries == 1 and own.limit_retries == 5 and [p.name for p in build_providers(own, {})] == ["groq"]


def test_extract(spark):
    df = spark.createDataFrame([(1, ["t"]), (2, []), (3, None)], "id int, chunks array<string>")
    got = {r["id"]: r for r in extract(df, "chunks", lambda: [ScriptedProvider("p", [GOOD])], "p", ["a"]).collect()}
    assert got[1]["data"] == '{"a":"x"}' and got[2]["error"] == got[3]["error"] == "empty_content"


def test_settings(tmp_path):
    (tmp_path / "s.yaml").write_text("target: 5\n")
    (tmp_path / "r.yaml").write_text("jobs:\n  - {name: a, adapter: x}\n  - {name: b, adapter: nope}\n  - {name: c, adapter: x, enabled: false}\n")
    s = config.load(str(tmp_path / "s.yaml"), str(tmp_path / "r.yaml"), {"SLUICE_MAX_RETRIES": "2", "OTHER": "1"})
    assert s["target"] == 5 and s["max_retries"] == 2 and s["fuzzy_threshold"] == 97
    assert [(a["name"], f) for a, f in config.pick({"x": 1}, s.source_group("jobs"))] == [("a", 1)] and s.source_group("none") == []
