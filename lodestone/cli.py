"""Command line: one command per stage, thin wrappers over the operators."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import __version__, config
from lodestone.operators import evaluate, generate, manifest, pairs, persona, redact, seeds, sft, splits, tagging, validate
from lodestone.plans import run as runs
from lodestone.plans.schema import texts
from lodestone.session import build_session
from lodestone.sources import adapters, records


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestone", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *options: str, **defaults) -> None:
        c = sub.add_parser(name)
        for o in options:
            flag, _, kind = o.partition(":")
            if kind == "flag":
                c.add_argument(f"--{flag}", action="store_true")
            else:
                c.add_argument(f"--{flag}", type={"int": int, "float": float}.get(kind, str), default=defaults.get(flag.replace("-", "_")), required=kind == "need")

    add("version")
    add("ingest", "input:need", "output:need", "source", "quarantine")
    add("redact", "input:need", "output:need", "rules", "quarantine", "audit", "audit-rate:float", "seed:int", "fail-on-leak:flag", audit_rate=0.05, seed=0)
    add("tag", "input:need", "output:need")
    add("validate", "input:need", "issues:need", "registry", "output")
    add("split", "input:need", "output:need", "seed:int", "threshold:float", seed=0, threshold=0.85)
    add("export-sft", "input:need", "output:need", "template", "system-prompt", "loss-policy", "shard-size:int", template="chatml", loss_policy="assistant_only", shard_size=5000)
    add("export-dpo", "input:need", "output:need", "strategy", "shard-size:int", strategy="feedback", shard_size=5000)
    add("run", "config:need")
    add("generate-seeds", "input:need", "output:need", "method", "threshold:float", method="greedy", threshold=seeds.THRESHOLD)
    add("generate-trajectories", "input:need", "output:need", "registry", "seed:int", seed=0)
    add("generate-stratify", "input:need", "output:need", "cap:int")
    add("score", "input:need", "output:need", "persona:need")
    add("dpo-synthesize", "input:need", "output:need", "persona:need", "by", by="lineage")
    add("manifest-verify", "manifest:need", "base:need")
    add("manifest-show", "manifest:need")
    add("hash-config", "config:need")
    add("validate-template", "input:need", "template", "max-tokens:int", template="chatml", max_tokens=8192)
    add("eval-outputs", "suite:need", "outputs:need")
    add("eval-compare", "suite:need", "student:need", "teacher:need", "teacher-params:int", "student-params:int", "student-context:int")
    return p


def _json(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


SUITE = "prompt_id string, edge_case_category string, gold_tool_calls array<struct<name:string,arguments:string>>, gold_text string, gold_success double"
OUTPUTS = "prompt_id string, tool_calls array<struct<name:string,arguments:string>>, text string, persona_score double, latency_ms double, success double"


def _show(df: DataFrame) -> None:
    for r in df.toJSON().toLocalIterator():
        print(r)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    if a.command == "version":
        print(__version__)
        return 0
    if a.command == "hash-config":
        from dataclasses import asdict

        print(manifest.hash_obj(asdict(config.load(a.config))))
        return 0
    spark = spark or build_session("lodestone-cli")
    read, save = spark.read.parquet, lambda df: df.write.mode("overwrite").parquet(a.output)
    if a.command == "ingest":
        good, bad = adapters.normalize(records.read_records(spark, a.input), F.lit(runs.RUN_TIME).cast("timestamp"), a.source)
        save(good)
        if a.quarantine:
            bad.write.mode("overwrite").json(a.quarantine)
    elif a.command == "redact":
        rows = redact.redact_trajectories(read(a.input), runs.rules_of(a.rules))
        clean, held = redact.route(rows)
        save(clean if a.quarantine else rows)
        if a.quarantine:
            held.write.mode("overwrite").parquet(a.quarantine)
        if a.audit:
            redact.audit_sample(rows.where("pii_redacted"), "session_id", a.audit_rate, a.seed).write.mode("overwrite").json(a.audit)
        _show(redact.category_totals(rows))
        return 2 if a.fail_on_leak and not held.isEmpty() else 0
    elif a.command == "tag":
        save(tagging.difficulty(read(a.input)))
        _show(tagging.band_counts(read(a.input)))
    elif a.command == "validate":
        rows = read(a.input)
        validate.validate(rows, validate.registry_frame(spark, config.load_registry(a.registry))).write.mode("overwrite").parquet(a.issues)
        issues = read(a.issues)
        _show(validate.histogram(issues))
        if a.output:
            save(validate.without_errors(rows, issues))
    elif a.command == "split":
        rows = read(a.input)
        save(splits.stratified_split(rows, splits.stratum_key(F.col("complexity_band"), F.col("domain")), F.col("session_id"), seed=a.seed))
        _show(splits.split_integrity(read(a.output).withColumn("_t", F.array_join(texts("user"), " ")), "session_id", "_t", threshold=a.threshold))
    elif a.command == "export-sft":
        recs = sft.sft_records(read(a.input), a.system_prompt, None if a.loss_policy == "none" else a.loss_policy).withColumn("_k", F.col("metadata.session_id"))
        records.write_shards(recs, f"{a.output}/shards", ["_k"], a.shard_size)
        records.write_card(spark, f"{a.output}/card", records.dataset_card(recs.drop("_k"), "sft", a.template))
    elif a.command == "export-dpo":
        rows = runs.pair_frame(read(a.input), a.strategy, None).withColumn("_k", F.concat_ws("|", "session_id", "detail"))
        records.write_shards(rows, a.output, ["_k"], a.shard_size)
        _show(rows.groupBy("source").count())
    elif a.command == "run":
        print(json.dumps(runs.run(spark, config.load(a.config))))
    elif a.command == "generate-seeds":
        save(seeds.extract(read(a.input), a.method, threshold=a.threshold))
    elif a.command == "generate-trajectories":
        made, dropped = generate.generate(read(a.input), config.load_registry(a.registry), F.lit(runs.RUN_TIME).cast("timestamp"), seed=a.seed)
        save(made)
        print(json.dumps({"written": read(a.output).count(), "dropped": dropped.count()}))
    elif a.command == "generate-stratify":
        save(tagging.cap_per_bucket(tagging.difficulty(read(a.input)), a.cap, ["session_id"]))
    elif a.command in ("score", "dpo-synthesize"):
        rules = persona.parse_persona(_json(spark, a.persona))
        rows = persona.score(read(a.input), rules)
        if a.command == "score":
            save(rows)
            _show(persona.pass_counts(rows))
        else:
            save(pairs.synthesise(rows, rules, "session_id", a.by))
            _show(read(a.output).groupBy("source").count())
    elif a.command in ("manifest-verify", "manifest-show"):
        m = json.loads(_json(spark, a.manifest))
        if a.command == "manifest-show":
            print(json.dumps(m, indent=2, sort_keys=True))
            return 0
        found = manifest.verify(manifest.recorded(spark, m), manifest.file_entries(spark, a.base))
        _show(found)
        return 0 if found.isEmpty() else 2
    elif a.command == "validate-template":
        report = sft.dry_run_report(sft.dry_run(sft.sft_records(read(a.input)).select("messages"), a.template, a.max_tokens))
        _show(report)
        return 2 if report.first()["n_failed"] else 0
    elif a.command == "eval-outputs":
        _show(evaluate.tool_use(evaluate.scored(spark.read.schema(SUITE).json(a.suite), spark.read.schema(OUTPUTS).json(a.outputs))))
    elif a.command == "eval-compare":
        suite = spark.read.schema(SUITE).json(a.suite)
        student, teacher = (spark.read.schema(OUTPUTS).json(x) for x in (a.student, a.teacher))
        _show(evaluate.compare_outputs(suite, student, teacher))
        v = evaluate.verdict(evaluate.by_category(suite, student, teacher), teacher_params=a.teacher_params, student_params=a.student_params, student_context=a.student_context)
        _show(v)
        return 0 if v.first()["accepted"] else 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
