from __future__ import annotations

import json

import pytest
from helpers import call, ev, frame, result, say, user
from pyspark.sql import functions as F

from lodestone.operators import evaluate, generate, manifest, pairs, persona, seeds, sft, splits, validate
from lodestone.sources import adapters, records

REG = {"t": {"required": ["a"], "properties": {"a": "integer", "b": {"type": "string"}}}}


def codes(df):
    return sorted((r["code"], r["event_pos"], r["detail"]) for r in df.collect())


def test_validation_codes(spark):
    t = frame(spark, [user(0, "q"), call(1, "t", b=1), result(2, "c1", "x"), say(3, "It failed, sorry"), call(4, "zz", a=1), result(5, "nope")])
    got = codes(validate.validate(t, validate.registry_frame(spark, REG)))
    assert got == sorted(
        [
            ("ARG_SCHEMA", 1, "missing a"),
            ("ARG_SCHEMA", 1, "b: expected string, got integer"),
            ("NAME_MISMATCH", 2, "t/x"),
            ("OBSERVATION_CONTRADICTION", 3, "claims failure"),
            ("UNKNOWN_TOOL", 4, "zz"),
            ("DANGLING_RESULT", 5, "nope"),
            ("UNRESOLVED_CALL", None, "c4"),
        ],
        key=repr,
    ) or set(got) == {
        ("ARG_SCHEMA", 1, "missing a"), ("ARG_SCHEMA", 1, "b: expected string, got integer"), ("NAME_MISMATCH", 2, "t/x"), ("OBSERVATION_CONTRADICTION", 3, "claims failure"),
        ("UNKNOWN_TOOL", 4, "zz"), ("DANGLING_RESULT", 5, "nope"), ("UNRESOLVED_CALL", None, "c4"),
    }
    assert validate.without_errors(t, validate.validate(t, validate.registry_frame(spark, REG))).count() == 0


def test_folding_and_loss_weights(spark):
    t = frame(
        spark,
        [user(0, "q"), say(1, "old"), say(2, "let me"), call(3, "t"), ev("error", 4, message="x"), result(5, "c3"), say(6, ""), say(7, "end")],
        [user(0, "only")],
    )
    m = t.select("session_id", sft.to_messages(system_prompt="sys").alias("m")).orderBy("session_id").collect()
    assert [(x["role"], x["content"]) for x in m[0]["m"]] == [("system", "sys"), ("user", "q"), ("assistant", "let me"), ("tool", "ok"), ("assistant", "end")]
    recs = sft.sft_records(t).collect()
    assert len(recs) == 1 and recs[0]["metadata"]["loss_weights"] == [0.0, 1.0, 0.0, 1.0]
    assert sft.sft_records(t, policy="assistant_text_only").first()["metadata"]["loss_weights"] == [0.0, 0.0, 0.0, 1.0]
    with pytest.raises(KeyError):
        sft.loss_weights(F.col("m"), "no such")


@pytest.mark.parametrize("name", sorted(sft.TEMPLATES))
def test_templates_hold_all_parts(spark, name):
    t = frame(spark, [user(0, "question"), say(1, "thinking"), call(2, "t", a=1), result(3, "c2", content="seen"), say(4, "answer")])
    text = t.select(sft.render(sft.to_messages(), name, True)).first()[0]
    assert all(x in text for x in ("question", "thinking", '"a": 1', "seen", "answer")) and text.endswith(sft.PROMPTS[name])


def test_chatml_exactly(spark):
    t = frame(spark, [user(0, "q"), call(1, "t", a=1), result(2, "c1", content="r")])
    assert t.select(sft.render(sft.to_messages(), "chatml")).first()[0] == (
        '<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\n<tool_call>{"name": "t", "arguments": {"a": 1}}</tool_call><|im_end|>\n<|im_start|>tool\nr<|im_end|>\n'
    )


def test_dry_run(spark):
    t = frame(spark, [user(0, "a b c"), say(1, "d")], []).select("session_id", sft.to_messages().alias("messages"))
    rows = {r["session_id"]: (r["code"], r["n_tokens"]) for r in sft.dry_run(t, "plain", 5, "session_id").collect()}
    assert rows["s0"] == ("CONTEXT_OVERFLOW", 7) and rows["s1"][0] == "EMPTY_MESSAGES"
    rep = sft.dry_run_report(sft.dry_run(t, "plain", 5)).first()
    assert (rep["n_records"], rep["n_failed"], rep["n_overflow"]) == (2, 2, 1)


def test_persona_parsing_and_scores(spark):
    p = persona.parse_persona("# Title\n## A b\n- Cite. [hard] [regex: http]\n- Cite. [contains: ok]\n- Kind [judge: is kind] [forbid: bad]\nnot a rule\n### C\n* plain\n")
    assert [r.id for r in p.rules] == ["a-b--cite", "a-b--cite-2", "a-b--kind", "a-b-c--plain"] and p.rules[2].criterion == "is kind" and p.sections == ["a-b", "a-b/c"]
    t = frame(spark, [say(0, "see http://x ok"), say(1, "<tool_call>{}</tool_call>")], [say(0, "none")])
    got = [(r["assistant_text"], r["hard_pass"], r["persona_score"]) for r in persona.score(t, p).orderBy("session_id").collect()]
    assert got == [("see http://x ok", True, 1.0), ("none", False, 0.0)]
    assert [r["persona_score"] for r in persona.score(t, persona.Persona("empty")).collect()] == [1.0, 1.0]


def test_pairs(spark):
    fine = [user(0, "Hi"), call(1, "t"), result(2, "c1", bad=True), call(3, "t"), result(4, "c3"), say(5, "First. See [x](y) now")]
    t = frame(spark, fine, [user(0, "hi"), say(1, "bad"), result(2, "z", bad=True)], tags={0: {"feedback_pairs": [{"prompt_event_id": "e0", "chosen": "c", "rejected": "r", "weight": 2.0}, {"prompt_event_id": "none"}]}})
    fb = pairs.from_feedback(t).collect()
    assert [(len(r["prompt"]), r["chosen"][0]["content"], r["detail"]) for r in fb] == [(1, "c", "e0|2.0")]
    rec = pairs.from_recovery(t).collect()
    assert [(r["detail"], len(r["prompt"]), r["rejected"][0]["content"]) for r in rec] == [("e2|e5", 3, pairs.APOLOGY)]
    real = pairs.real_pairs(t.withColumn("o", F.col("session_id")).where("true"), "o", "fingerprint").collect()
    assert real == []  # both fail: each holds an error
    scored = t.withColumn("persona_score", F.when(F.col("session_id") == "s0", 0.9).otherwise(0.1))
    real = pairs.real_pairs(scored, "session_id", "fingerprint").collect()
    assert len(real) == 1 and real[0]["session_id"] == "s0" and real[0]["rejected"][0]["content"] == "bad"
    p = persona.parse_persona("## S\n- rule [id: r1]\n")
    bad = pairs.persona_violation(t.where("session_id = 's0'"), p).collect()
    assert bad[0]["rejected"][0]["content"] == "See x now" + pairs.VIOLATION_NOTE and bad[0]["detail"] == "r1|soft"
    slow = pairs.tool_inefficiency(t).collect()
    assert [(r["detail"], len(r["rejected"])) for r in slow] == [("extra_tool_calls|2|4", 5)]
    assert pairs.synthesise(scored, p, "session_id", "fingerprint").count() == 4


def test_evaluation(spark):
    calls = "array<struct<name:string,arguments:string>>"
    suite = spark.createDataFrame(
        [("1", "x", [("f", '{"a":1,"b":2}')], "red fox", 1.0), ("2", None, [], "", 1.0), ("3", "x", [("f", "{}")], "t", 1.0)],
        f"prompt_id string, edge_case_category string, gold_tool_calls {calls}, gold_text string, gold_success double",
    )
    cols = f"prompt_id string, tool_calls {calls}, text string, persona_score double, latency_ms double, success double, n int"
    out = spark.createDataFrame([("1", [("f", '{"b": 2, "a": 1}')], "red dog", None, 10.0, None, 1), ("2", [], "", 1.0, 20.0, 0.0, 1), ("2", [], "", 1.0, 30.0, 1.0, 2)], cols)
    m = evaluate.tool_use(evaluate.scored(suite, out, "n")).first()
    assert (m["tool_name_accuracy"], m["arg_exact_match"], m["arg_field_recall"], m["n"]) == (1.0, 0.5, 1.0, 2) and m["text_f1"] == pytest.approx(0.25)
    cats = {r["category"]: r for r in evaluate.by_category(suite, out, out, "n").collect()}
    assert cats["x"]["n_prompts"] == 2 and cats["other"]["student_latency_p95_ms"] == 30.0
    v = evaluate.verdict(evaluate.by_category(suite, out, out, "n"), teacher_params=7, student_params=7, student_context=1000).first()
    assert not v["accepted"] and "params" in v["reasons"] and "context_window" in v["reasons"] and "other/latency_not_below_teacher" in v["reasons"]
    assert spark.createDataFrame([(1.0,), (2.0,)], "x double").select(evaluate.percentile(F.col("x"), 0.95)).first()[0] == pytest.approx(1.95)
    reg = {"f": {"required": ["a"], "properties": {"a": "number"}}}
    assert evaluate.scored(suite, out, "n", reg).groupBy().agg(F.sum("n_valid")).first()[0] == 1


def test_seeds(spark):
    t = frame(spark, *[[user(0, q)] for q in ("What is the price of rice?", "what is the price of rice", "Will it rain tomorrow?", "ab", "will it rain tomorrow")])
    s = seeds.extract(t.fillna("d", ["domain"]).withColumn("domain", F.lit("d")), threshold=0.55).orderBy("cluster_id").collect()
    assert [r["cluster_size"] for r in s] == [2, 2] and all(r["seed_id"].startswith("seed-") for r in s)
    v = spark.createDataFrame([("abcdef",), ("",)], "t string").select(seeds.hash_embed(F.col("t"))).collect()
    assert sum(x * x for x in v[0][0]) == pytest.approx(1.0) and sum(v[1][0]) == 0


def test_greedy_query_is_one_pass_over_all_rows(spark, tiny):
    import numpy as np
    from lodestone.plans import catalogue

    rows = seeds.collect_questions(catalogue.t1(spark, tiny)).withColumn("vector", seeds.hash_embed(F.col("query"))).orderBy("session_id").collect()
    # single pass as in the reference: the nearest running mean, or a new cluster
    means, sizes = [], []
    for r in rows:
        v = np.array(r["vector"])
        near = [float(m @ v) for m in means]
        j = int(np.argmax(near)) if near else -1
        if near and near[j] >= seeds.THRESHOLD:
            m = (means[j] * sizes[j] + v) / (sizes[j] + 1)
            means[j], sizes[j] = m / np.linalg.norm(m), sizes[j] + 1
        else:
            means.append(v)
            sizes.append(1)
    got = [r["cluster_size"] for r in catalogue.QUERIES["greedy_seeds"](spark, tiny).orderBy("cluster_id").collect()]
    assert got == sorted(sizes, reverse=True)


def test_greedy_in_blocks_equals_one_by_one():
    import numpy as np

    r = np.random.default_rng(4)
    base = r.random((400, 32)) * (r.random((400, 32)) < 0.4)
    v = base[r.integers(0, 400, 1500)] + r.random((1500, 32)) * r.choice([0, 0.05, 0.4], size=(1500, 1))
    v = np.concatenate([v, v[:100], np.zeros((3, 32))])
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    for limit in (0.6, 0.9):
        means, sizes, want = [], [], []
        for x in v:
            near = np.array(means) @ x if means else np.zeros(0)
            j = int(near.argmax()) if len(near) else -1
            if j >= 0 and near[j] >= limit:
                m = (means[j] * sizes[j] + x) / (sizes[j] + 1)
                means[j], sizes[j] = m / np.linalg.norm(m), sizes[j] + 1
            else:
                j = len(means)
                means.append(x)
                sizes.append(1)
            want.append(j)
        assert seeds.greedy_labels(v, limit).tolist() == want and len(means) > seeds.AT_ONCE / 4


@pytest.mark.parametrize("method", ["greedy", "kmeans"])
def test_seeds_read_their_clusters_from_a_copy(spark, method):
    t = frame(spark, *[[user(0, f"what is the price of {x}")] for x in ("rice", "tea", "soil", "rain")]).withColumn("domain", F.lit("d"))
    plan = seeds.extract(t, method, k=2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") >= 3 and "FlatMapGroupsInPandas" not in plan.split("InMemoryRelation")[0]


def test_only_the_clustering_is_one_task(spark):
    t = frame(spark, *[[user(0, f"what is the price of {x}")] for x in ("rice", "tea", "soil", "rain")])
    rows = seeds.collect_questions(t).withColumn("vector", seeds.hash_embed(F.col("query")))
    assert seeds.greedy_cluster(rows, None, "session_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_generation_deals_one_split_and_keeps_its_partitions(spark):
    rows = spark.range(40, numPartitions=1).select(F.col("id").cast("string").alias("seed_id"), F.lit("q").alias("query"))

    def make():
        return lambda prompts: ['{"tool_call": {"name": "t", "arguments": {}}}' if p.count('"tool"') < 2 else '{"final": "f"}' for p in prompts]

    made, lost = generate.generate_with(rows, {"t": {}}, F.lit("2024-01-01").cast("timestamp"), make)
    assert made.count() == 40 and lost.count() == 0 and {len(r["events"]) for r in made.collect()} == {6}
    assert spark.sparkContext.defaultParallelism == made.rdd.getNumPartitions()


def test_kmeans_query_follows_the_number_of_rows(spark, tiny, monkeypatch):
    from lodestone.plans import catalogue

    rows = [("s%03d" % i, None, None, f"question number {i} on {'rice rain soil tea pest'.split()[i % 5]} {i * i}") for i in range(150)]
    made = spark.createDataFrame(rows, "session_id string, lineage_id string, domain string, query string")
    monkeypatch.setattr(catalogue.seeds, "collect_questions", lambda t: made)
    n = catalogue.QUERIES["kmeans_seeds"](spark, tiny).count()
    assert 8 < n <= 12  # the root of 150; a cluster may be left empty


def test_contained_short_items_and_repeated_ids(spark):
    items = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "x y"), (3, " "), (4, "p q r s t u")], "item_id int, text string")
    rows = spark.createDataFrame([(10, "z a b c d e f"), (10, "z a b c d e f"), (11, "X  Y z"), (12, "y x"), (13, "p q r s t"), (13, "q r s t u"), (14, None)], "doc_id int, text string")
    got = sorted((r["doc"], r["item"]) for r in splits.contained(items, rows, "item_id", "text", "doc_id", "text").collect())
    assert got == sorted([(10, 1), (11, 2), *[(d, 3) for d in (10, 11, 12, 13, 14)]])


def test_generation(spark):
    reg = {"mandi_price": {"required": ["commodity"], "properties": {"commodity": "string"}}, "a_tool": {"required": ["must"]}}
    rows = spark.createDataFrame([("s1", "mandi price?"), ("s2", "hello")], "seed_id string, query string")
    made, dropped = generate.generate(rows, reg, F.lit("2024-01-01").cast("timestamp"))
    assert [r["seed_id"] for r in dropped.collect()] == ["s2"]  # first tool by name needs a field that has no default
    t = made.first()
    assert [e["kind"] for e in t["events"]] == ["user", "tool_call", "tool_result", "assistant"] and t["events"][3]["content"].startswith(generate.FINAL_PREFIX)
    c = spark.createDataFrame([("mandi_price", '{"commodity":"x"}', i) for i in range(200)] + [("none", "{}", 0)], "tool string, arguments string, call_index int")
    out = generate.call_tools(c, reg, {"mandi_price": {"TIMEOUT": 0.5}}, seed=2)
    n = {r["m"]: r["n"] for r in out.groupBy(F.col("failure_mode").alias("m")).agg(F.count("*").alias("n")).collect()}
    assert n["INVALID_ARGS"] == 1 and 70 < n["TIMEOUT"] < 130
    fix = spark.createDataFrame([("mandi_price", None, "F")], "f_tool string, f_arguments string, f_content string")
    assert {r["content"] for r in generate.call_tools(c.where("tool = 'mandi_price'"), reg, None, fix).collect()} == {"F"}
    assert generate.find_balanced('so {"tool_call": {"name": "a}"}} end') == '{"tool_call": {"name": "a}"}}'
    r = spark.createDataFrame([('{"final": "f"}',), ('x {"tool_call": {"name": "n", "arguments": {"k": 1}}} y',), ("just text",)], "t string").select(generate.parse_response(F.col("t")).alias("r")).collect()
    assert [(x["r"]["name"], x["r"]["final"]) for x in r] == [(None, "f"), ("n", None), (None, "just text")]


def test_ingest_and_records(spark, tmp_path):
    good = {"session_id": "g", "messages": [{"role": "system", "content": "x"}, {"role": "user", "content": "hi"}, {"role": "assistant", "content": None}]}
    late = {"session_id": "c", "events": [{"kind": "user", "event_id": "1", "timestamp": "2024-01-01T00:00:02Z", "content": "a"}, {"kind": "assistant", "event_id": "2", "timestamp": "2024-01-01T00:00:01Z"}]}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text(json.dumps(good) + "\n\nbroken\n" + json.dumps(late) + "\n")
    (tmp_path / "in/b.json").write_text(json.dumps([good, 7]))
    rows = records.read_records(spark, str(tmp_path / "in"))
    ok, bad = adapters.normalize(rows, F.lit("2024-01-01").cast("timestamp"))
    assert ok.count() == 2 and [r["error"] for r in bad.collect()] == ["timestamps out of order"]
    assert [e["content"] for e in ok.first()["events"]] == ["hi", ""]
    with pytest.raises(KeyError):
        adapters.get_source("nope")
    df = spark.range(10).withColumnRenamed("id", "k")
    assert records.write_jsonl(df, str(tmp_path / "out")) == 10
    assert records.write_shards(df, str(tmp_path / "shards"), ["k"], 4) == 3
    a, b = records.fingerprint(df).first(), records.fingerprint(df.repartition(3).orderBy(F.desc("k"))).first()
    assert a == b and a != records.fingerprint(df.union(df)).first()
    m = manifest.manifest({"x": 1}, {"s": manifest.file_entries(spark, str(tmp_path / "in"))}, "0")
    assert manifest.verify(manifest.recorded(spark, m), manifest.file_entries(spark, str(tmp_path / "in"))).count() == 0
    (tmp_path / "in/b.json").write_text("[]")
    assert [r["problem"] for r in manifest.verify(manifest.recorded(spark, m), manifest.file_entries(spark, str(tmp_path / "in"))).collect()] == ["hash mismatch"]
    assert records.dataset_card(df, "n")["record_count"] == 10


def test_streaming_front_end(spark, tmp_path):
    from lodestone.streaming import frontend

    rec = {"session_id": "g", "messages": [{"role": "user", "content": "mail a@x.io"}, {"role": "assistant", "content": "ok"}]}
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.jsonl").write_text(json.dumps(rec) + "\n")
    q = frontend.stream_tagged(frontend.stream_lines(spark, str(tmp_path / "s")), F.lit("2024-01-01").cast("timestamp"))
    run = q.writeStream.format("memory").queryName("tagged").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = spark.table("tagged").collect()
    assert len(got) == 1 and got[0]["events"][0]["content"] == "mail [EMAIL_1]" and got[0]["tier"] == "easy"
