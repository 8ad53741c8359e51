from __future__ import annotations

import json

import pytest

from lodestone import config
from lodestone.cli import main

LOG = [
    {"session_id": f"s{i}", "domain": "farm", "messages": [{"role": "user", "content": f"price of rice {i}? mail a{i}@x.io"}, {"role": "assistant", "content": "checking", "tool_calls": [{"id": "c", "function": {"name": "mandi_price", "arguments": '{"commodity": "rice"}'}}]}, {"role": "tool", "tool_call_id": "c", "name": "mandi_price", "content": "30"}, {"role": "assistant", "content": "It is 30."}]}
    for i in range(6)
]


def write(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/log.jsonl").write_text("\n".join(map(json.dumps, LOG)))
    (tmp_path / "tools.yaml").write_text("tools:\n- name: mandi_price\n  required: [commodity]\n  properties: {commodity: {type: string}}\n")
    (tmp_path / "persona.md").write_text("## Tone\n- Give a number [regex: \\d]\n")
    return tmp_path


def test_run_end_to_end(spark, tmp_path, capsys):
    d = write(tmp_path)
    (d / "c.yaml").write_text(
        f"name: t\nbuild_dir: {d}/build\ningest: {{input: {d}/in}}\nvalidate: {{tool_registry: {d}/tools.yaml}}\nsplit: {{enabled: true}}\n"
        f"seeds: {{enabled: true, threshold: 0.5}}\ngenerate: {{enabled: true, tool_registry: {d}/tools.yaml}}\nstratify: {{enabled: true, cap_per_bucket: 3}}\ndpo: {{strategy: all}}\n"
    )
    assert main(["run", "--config", str(d / "c.yaml")], spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["ingested"] == out["redacted"] == 6 and 1 <= out["seeds"] <= 6 and out["synthetic"] + out["dropped"] == out["seeds"] and out["issues"] == 0
    assert spark.read.parquet(f"{d}/build/redacted_all").where("pii_counts['EMAIL'] = 1").count() == 6
    assert main(["hash-config", "--config", str(d / "c.yaml")], spark) == 0


def test_commands_chain(spark, tmp_path, capsys):
    d = write(tmp_path)
    p = lambda n: str(d / n)
    assert main(["ingest", "--input", p("in"), "--output", p("a"), "--quarantine", p("q")], spark) == 0
    assert main(["redact", "--input", p("a"), "--output", p("b"), "--quarantine", p("l"), "--fail-on-leak"], spark) == 0
    assert main(["tag", "--input", p("b"), "--output", p("c")], spark) == 0
    assert main(["validate", "--input", p("c"), "--issues", p("i"), "--registry", p("tools.yaml"), "--output", p("v")], spark) == 0
    assert main(["split", "--input", p("v"), "--output", p("s")], spark) == 0
    assert main(["export-sft", "--input", p("v"), "--output", p("sft"), "--shard-size", "4"], spark) == 0
    assert main(["score", "--input", p("v"), "--output", p("sc"), "--persona", p("persona.md")], spark) == 0
    assert main(["dpo-synthesize", "--input", p("v"), "--output", p("d"), "--persona", p("persona.md")], spark) == 0
    assert spark.read.parquet(p("d")).groupBy("source").count().collect()[0]["count"] == 6
    assert main(["validate-template", "--input", p("v"), "--max-tokens", "3"], spark) == 2
    assert main(["generate-seeds", "--input", p("b"), "--output", p("seeds")], spark) == 0
    assert main(["version"], spark) == 0


def test_config_is_strict():
    with pytest.raises(ValueError):
        config.build(config.Run, {"nope": 1})
    with pytest.raises(ValueError):
        config.build(config.Run, {"dpo": {"strategy": "synthetic"}})
    assert config.build(config.Run, {"split": {"fractions": [0.5, 0.25, 0.25]}}).split.fractions == (0.5, 0.25, 0.25)


def test_catalogue_runs_without_the_optional_parts():
    import subprocess
    import sys
    from pathlib import Path

    code = "import sys; sys.modules['lodestone.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'band_counts' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True)
