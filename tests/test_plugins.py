from __future__ import annotations

import json
import re
from datetime import datetime, timedelta

from helpers import call, frame, say, user
from pyspark.sql import functions as F

from lodestone.functions import plugins
from lodestone.operators import generate, persona, redact, sft
from lodestone.streaming import frontend


def test_engines_judges_hooks_and_templates(spark):
    df = spark.createDataFrame([("call Asha at a@x.io",), ("none",)], "t string")
    ner = plugins.pii_engine(lambda: lambda t, g: [("ner", "PERSON", t.index("Asha"), t.index("Asha") + 4)] if "Asha" in t else [])
    gone = plugins.pii_engine(plugins.optional("no_such_module", lambda m: m))
    both = plugins.union_engines(redact.detect_all(F.col("t")), ner(F.col("t"), F.lit("en")), gone(F.col("t"), F.lit("en")))
    got = [[(s["category"], s["text"]) for s in r[0]] for r in df.select(redact.resolve(both)).collect()]
    assert got == [[("PERSON", "Asha"), ("EMAIL", "a@x.io")], []]
    rules = persona.parse_persona("## S\n- be kind [judge: kind?] [id: k]\n")
    t = frame(spark, [user(0, "q"), say(1, "bad")], [user(0, "q"), say(1, "boom")], [user(0, "q"), call(1, "t"), say(2, "good")])

    def make():
        def model(rule, criterion, text):
            if text == "boom":
                raise RuntimeError
            return plugins.parse_verdict("PASS\nyes" if text == "good" else "FAIL")

        return model

    assert [r["persona_score"] for r in persona.score(t, rules, judge=plugins.judge(make)).orderBy("session_id").collect()] == [0.0, 0.5, 1.0]
    calls = spark.createDataFrame([("f", '{"a":1}', 0)], "tool string, arguments string, call_index int")
    assert generate.call_tools(calls, hook=plugins.tool_hook(lambda: lambda t, a: t + a)).first()["content"] == 'f{"a":1}'
    ans = plugins.backend(df, "t", lambda: lambda ps: [p.upper() for p in ps]).collect()
    assert {r["answer"] for r in ans} == {"CALL ASHA AT A@X.IO", "NONE"}
    rows = t.select("session_id", F.transform(sft.to_messages(), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("m"))
    text = plugins.render_with(rows, "m", lambda ms: "/".join(m["role"] for m in ms)).orderBy("session_id").collect()
    assert text[2]["text"] == "user/assistant/assistant"


def test_rounds_end_when_all_are_finished(spark):
    state = spark.createDataFrame([(1, 0, False), (2, 3, False)], "k int, n int, finished boolean")

    def step(frames):
        for pdf in frames:
            pdf["n"] -= 1
            yield pdf.assign(finished=pdf["n"] <= 0)

    got = {r["k"]: (r["n"], r["finished"]) for r in generate.rounds(state, step, 5).collect()}
    assert got == {1: (-1, True), 2: (0, True)}


def test_sessions_assembled_from_a_stream(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    rows = [("a", t0 + timedelta(minutes=m), i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i, m in enumerate((0, 1, 90, 91))] + [("z", t0 + timedelta(days=2), 9, "user", "late")]
    src = spark.createDataFrame(rows, "session_id string, ts timestamp, turn int, role string, text string")
    src.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = frontend.assemble(stream).writeStream.format("memory").queryName("sess").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted([e["content"] for e in r["events"]] for r in spark.table("sess").where("session_id = 'a'").collect())
    assert got == [["t0", "t1"], ["t2", "t3"]]
    ev = spark.createDataFrame([(t0, "error"), (t0, "click")], "ts timestamp, event_type string")
    assert frontend.stream_counts(ev).agg(F.sum("n"), F.sum("n_errors")).first()[0:2] == (2, 1)


def test_multi_step_generation_sees_results_and_drops_bad_calls(spark):
    def make():
        def answer(prompts):
            out = []
            for p in prompts:
                chat = json.loads(p)
                q, seen = chat[0]["content"], [m for m in chat if m["role"] == "tool"]
                if q == "bad":
                    out.append('{"tool_call": {"name": "nope"}}')
                elif q == "list":
                    out.append('{"tool_call": {"name": "look", "arguments": [1]}}')
                elif q == "twice" and len(seen) < 2:
                    out.append(json.dumps({"tool_call": {"name": "look", "arguments": {"q": len(seen)}}}))
                else:
                    out.append(f"saw {[m['content'] for m in seen]}")
            return out

        return answer

    seeds = spark.createDataFrame([(q, q) for q in ("twice", "none", "bad", "list")], "seed_id string, query string")
    made, dropped = generate.generate_with(seeds, {"look": {"required": ["q"], "properties": {"q": "integer"}}}, F.lit("2024-01-01").cast("timestamp"), make)
    got = {r["lineage_id"]: r["events"] for r in made.collect()}
    assert [e["kind"] for e in got["twice"]] == ["user", "tool_call", "tool_result", "tool_call", "tool_result", "assistant"]
    assert [e["kind"] for e in got["none"]] == ["user", "assistant"] and got["none"][1]["content"] == "saw []"
    assert got["twice"][-1]["content"].count('"stub":true') == 2 and got["twice"][3]["tool_calls"][0]["arguments"] == '{"q":1}'
    assert sorted(r["seed_id"] for r in dropped.collect()) == ["bad", "list"]


def test_engines_in_the_orchestrator_and_tokenizer_in_the_dry_run(spark):
    find = lambda text, lang: [("x", "GOV_ID_IN", m.start(), m.end()) for m in re.finditer(r"[A-Z]{5}\d{4}[A-Z]", text)] + [("n", "PERSON", 0, 3)]
    df = spark.createDataFrame([("Bob ABCPE1234F and ABCXE1234F",)], "t string")
    spans = redact.orchestrated(F.col("t"), (plugins.pii_engine(lambda: find),))
    got = [(s["category"], s["text"]) for s in df.select(F.explode(spans).alias("s")).select("s.*").collect()]
    assert got == [("PERSON", "Bob"), ("GOV_ID_IN", "ABCPE1234F")]
    n = df.select(plugins.token_counter(lambda: list)(F.col("t")).alias("n"), plugins.token_counter(lambda: None)(F.col("t")).alias("w")).first()
    assert (n["n"], n["w"]) == (29, 5)
