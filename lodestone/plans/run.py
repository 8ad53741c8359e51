"""The whole run: ingest, redact, seeds, generate, tag, validate, stratify, split, export, manifest.

Each stage is a lazy frame; Parquet is written where several consumers branch
(canonical, redacted, tagged), JSON lines at the outer edge.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import __version__
from lodestone.config import Run, load_registry
from lodestone.functions.pii_rules import BUILTIN, load_rules
from lodestone.operators import generate, manifest, pairs, redact, seeds, sft, splits, tagging, validate
from lodestone.plans.schema import texts
from lodestone.sources import adapters, records

RUN_TIME = "1970-01-01 00:00:00"


def _keep(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def rules_of(path: str | None):
    if not path:
        return BUILTIN
    import yaml

    with open(path, encoding="utf-8") as f:
        return load_rules(yaml.safe_load(f) or {})


def pair_frame(tagged: DataFrame, strategy: str, system_prompt: str | None) -> DataFrame:
    made = {"feedback": pairs.from_feedback, "failure_recovery": pairs.from_recovery}
    if strategy in made:
        return made[strategy](tagged, system_prompt)
    return pairs.from_feedback(tagged, system_prompt).unionByName(pairs.from_recovery(tagged, system_prompt))


def run(spark: SparkSession, config: Run, base_time: str = RUN_TIME) -> dict:
    """Runs the configured stages; returns counters and the manifest's path."""
    out, counters, stages = config.build_dir.rstrip("/"), {}, {}
    good, bad = adapters.normalize(records.read_records(spark, config.ingest.input), F.lit(base_time).cast("timestamp"), config.ingest.source)
    canonical = _keep(good, f"{out}/canonical")
    bad.write.mode("overwrite").json(f"{out}/quarantine")
    counters["ingested"] = canonical.count()

    redacted = _keep(redact.redact_trajectories(canonical, rules_of(config.redact.rules_file)), f"{out}/redacted_all")
    audit = redact.audit_sample(redacted.where("pii_redacted"), "session_id", config.redact.audit_rate, config.redact.audit_seed, config.redact.audit_cap)
    audit.write.mode("overwrite").json(f"{out}/audit")
    clean, held = redact.route(redacted, config.redact.fail_on_leak)
    held.write.mode("overwrite").parquet(f"{out}/restricted_leaks")
    ready = clean if config.redact.quarantine else redacted
    counters["redacted"] = ready.count()

    rows = ready
    if config.seeds.enabled:
        found = _keep(seeds.extract(ready, config.seeds.method, threshold=config.seeds.threshold, k=config.seeds.n_clusters, seed=config.seeds.seed), f"{out}/seeds")
        counters["seeds"] = found.count()
        if config.generate.enabled:
            made, dropped = generate.generate(found, load_registry(config.generate.tool_registry), F.lit(base_time).cast("timestamp"), config.generate.failure_config, config.generate.drop_on_invalid_args, config.generate.seed)
            rows = _keep(made, f"{out}/synthetic")
            counters |= {"synthetic": rows.count(), "dropped": dropped.count()}

    tagged = tagging.difficulty(rows)
    registry = load_registry(config.validate.tool_registry)
    issues = _keep(validate.validate(rows, validate.registry_frame(spark, registry)), f"{out}/issues")
    counters["issues"] = issues.count()
    if config.validate.drop_on_error:
        tagged = validate.without_errors(tagged, issues)
    if config.stratify.enabled:
        tagged = tagging.cap_per_bucket(tagged, config.stratify.cap_per_bucket, ["session_id"])
    tagged = _keep(tagged, f"{out}/tagged")
    counters["tagged"] = tagged.count()

    if config.split.enabled:
        key = splits.stratum_key(*[F.col(k) for k in config.split.keys])
        cut = _keep(splits.stratified_split(tagged, key, F.col("session_id"), config.split.fractions, config.split.seed), f"{out}/splits")
        leak = splits.split_integrity(cut.withColumn("_text", F.array_join(texts("user"), " ")), "session_id", "_text", threshold=config.split.near_duplicate_threshold)
        counters["split_leaks"] = leak.count()

    policy = None if config.sft.loss_policy == "none" else config.sft.loss_policy
    recs = sft.sft_records(tagged, config.sft.system_prompt, policy).withColumn("_k", F.col("metadata.session_id"))
    counters["sft_shards"] = records.write_shards(recs, f"{out}/sft", ["_k"], config.sft.shard_size, config.sft.compress)
    strata = tagged.groupBy("complexity_band").count()
    records.write_card(spark, f"{out}/sft_card", records.dataset_card(recs.drop("_k"), config.name, config.sft.template, strata, redact.category_totals(redacted), __version__, config.extra))
    dpo = pair_frame(tagged, config.dpo.strategy, config.dpo.system_prompt)
    counters["dpo_pairs"] = dpo.count()
    if counters["dpo_pairs"]:
        records.write_shards(dpo.withColumn("_k", F.concat_ws("|", "session_id", "detail")), f"{out}/dpo", ["_k"], config.dpo.shard_size, config.dpo.compress)
    for name in ("canonical", "tagged", "sft"):
        stages[name] = manifest.file_entries(spark, f"{out}/{name}")
    m = manifest.manifest(asdict(config), stages, __version__)
    spark.createDataFrame([(json.dumps(m, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/manifest")
    return counters | {"manifest": f"{out}/manifest"}
