from __future__ import annotations

import random

import numpy as np
import pytest

from lodestone.operators import similar, splits


def grams(t, k=5):
    t = t.lower()
    return {t[i : i + k] for i in range(max(len(t) - k + 1, 1))} if t else set()


def jac(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def texts(r):
    """Short and long texts with edits, cuts, copies and few words in common."""
    words = ["".join(r.choice("aeinrst") for _ in range(r.randrange(2, 7))) for _ in range(60)]
    out = ["", None, "ab", "AB", "abcde", "é😀x", "ſtraße ab"]
    for size in (4, 12, 40, 200, 330):
        for _ in range(5):
            base = [r.choice(words) for _ in range(size)]
            out += [" ".join(base), " ".join(base).upper()]
            for share in (0.01, 0.03, 0.1, 0.4):
                out.append(" ".join(w if r.random() > share else r.choice(words) for w in base))
            out.append(" ".join(base[: int(size * r.uniform(0.6, 1))]))
    return out


@pytest.mark.parametrize("t", [0.2, 0.5, 0.8, 0.85, 1.0])
def test_classes_and_links_equal_brute_force_over_many_blocks(spark, monkeypatch, t):
    monkeypatch.setattr(similar, "LEAST_BLOCK", 1 << 10)
    rows = list(enumerate(texts(random.Random(5))))
    df = spark.createDataFrame(rows, "k bigint, t string").repartition(3)
    sets = {i: grams(x) for i, x in rows if x}
    members, links = splits.near_duplicate_classes(df, "k", "t", t)
    cls = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    want = {i: (cls[i], sum(jac(sets[i], sets[j]) >= t for j in sets if j != i)) for i in sets}
    assert {r["key"]: (r["class_key"], r["n_links"]) for r in members.collect()} == want
    reps = sorted(set(cls.values()))
    pairs = {(a, b): jac(sets[a], sets[b]) for a in reps for b in reps if a < b and jac(sets[a], sets[b]) >= t}
    assert {(r["class_a"], r["class_b"]): r["jaccard"] for r in links.collect()} == pytest.approx(pairs)


def test_a_task_in_small_steps_finds_every_pair(monkeypatch):
    monkeypatch.setattr(similar, "CELLS", 50)
    r = np.random.default_rng(3)
    rows = [np.sort(r.choice(90, r.integers(1, 60), replace=False)).astype(np.uint64) for _ in range(60)]
    rows += [np.delete(x, 0) for x in rows if len(x) > 1]
    pack = lambda l: (np.array([len(x) for x in l]), np.concatenate(l), np.array([len(x) for x in l]))
    for t in (0.2, 0.5, 0.8, 0.9):
        near = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) >= t  # noqa: B023, E731
        i, j = similar.meet(pack(rows), None, t)
        assert sorted(zip(i, j)) == [(a, b) for a in range(len(rows)) for b in range(a + 1, len(rows)) if near(rows[a], rows[b])]
        i, j = similar.meet(pack(rows[:50]), pack(rows[50:]), t)
        assert sorted(zip(i, j)) == [(a, b) for a in range(50) for b in range(len(rows) - 50) if near(rows[a], rows[50 + b])]


def test_pairs_do_not_pass_a_shuffle_before_they_are_near(spark):
    """Rows that all share common shingles: what is shuffled follows the rows, not their square."""
    rows = [(i, f"https://www.example.org/en/articles/{i * 7919 % 100003:06d}") for i in range(400)]
    made = splits.near_duplicate_classes(spark.createDataFrame(rows, "k bigint, t string"), "k", "t", 0.8)[1]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (h#" not in plan
    want = sum(jac(grams(a), grams(b)) >= 0.8 for n, (_, a) in enumerate(rows) for _, b in rows[:n])
    assert made.count() == want


def test_leaks_between_splits_are_counted_by_class(spark):
    r = random.Random(2)
    base = ["price of rice today", "will it rain tomorrow morning", "soil is dry"]
    rows = [(i, r.choice(base) + r.choice(["", "?", "!!"]), r.choice(["train", "val", "test", None])) for i in range(90)]
    df = spark.createDataFrame(rows, "k bigint, t string, split string")
    want = splits.split_summary(splits.split_integrity(df, "k", "t", threshold=0.7)).collect()
    assert len(want) == 3 and sorted(splits.split_leak_counts(df, "k", "t", threshold=0.7).collect()) == sorted(want)
