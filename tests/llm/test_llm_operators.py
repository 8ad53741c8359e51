from __future__ import annotations

import collections
import hashlib
import html
import io
import math
import os
import random
import re
import tempfile
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import benchmark_decontamination as deco
from lodestone.llm import boosting, components, hnsw, html_extraction, language_id, mixing, near_copies, pii, simhash_dedup, substring_dedup, token_store, url_filter
from lodestone.llm.queries import QUERIES, tokenizer_path

# columns that a table may have besides, with names that operators use inside
EXTRA = {"hits": 1, "fp": 2, "_row": 3, "size": 4, "h": 5, "words": 6}


def docs(spark, rows, schema="doc_id long, text string", extra=False):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({k: F.lit(v) for k, v in EXTRA.items()}) if extra else df


LONG = " ".join(f"w{i % 977}" for i in range(30_000))


# ---- op2 --------------------------------------------------------------------------
def repeats(rows, window):
    occ, toks, out = collections.Counter(), [], []
    for _, t in rows:
        w = (t or "").encode().split()
        toks.append(w)
        for j in range(len(w) - window + 1):
            occ[b" ".join(w[j : j + window])] += 1
    for (i, _), w in zip(rows, toks, strict=True):
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if occ[b" ".join(w[j : j + window])] > 1:
                gone[j : j + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,window,gram", [(0, 6, 3), (1, 5, 5)])
def test_substring_dedup_equals_brute_force(spark, seed, window, gram):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice("abc") if i % 3 else "z" for _ in range(r.choice([0, 3, 5, 8, 20, 90]))) if i % 11 else None) for i in range(60)]
    rows += [(100, None), (7, rows[7][1]), (None, "a b c a b c a b c"), (101, " é \x0b\x0c  ")]
    got = substring_dedup.substring_dedup(docs(spark, rows, extra=True), window, gram).collect()
    assert sorted(((x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in got), key=repr) == repeats(rows, window)


def test_substring_dedup_spans_and_text(spark):
    a = " ".join(f"x{i}" for i in range(50))
    got = {x["doc_id"]: x for x in substring_dedup.substring_dedup(docs(spark, [(1, "head " + a), (2, a + " tail"), (3, LONG), (4, "")]), keep_text=True).collect()}
    assert got[1]["text"] == "head" and got[2]["text"] == "tail" and got[2]["spans"][0].words == 50
    assert (got[2]["spans"][0].source_doc, got[2]["spans"][0].source_start) == (1, 1)
    assert got[3]["n_removed"] == 30_000  # the long text repeats itself
    assert substring_dedup.substring_dedup(docs(spark, [])).count() == 0


def test_substring_dedup_repeated_rows(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice("abcd") for _ in range(60)) for _ in range(3)]
    rows = [(9, texts[0])] * 30 + [(None, texts[1])] * 5 + [(9, texts[2]), (9, "q " + texts[0][20:80] + " r"), (None, None), (None, None)]
    got = substring_dedup.substring_dedup(docs(spark, rows), 8, 3).collect()
    assert sorted(((x["doc_id"], x["n_words"], x["n_removed"], x["kept_sha256"]) for x in got), key=repr) == repeats(rows, 8)


def test_substring_dedup_is_linear_in_repeated_rows(spark):
    text = " ".join(f"w{i * i % 389}" for i in range(400))
    spent = []
    for n in (50, 50, 5000):
        t = time.monotonic()
        got = substring_dedup.substring_dedup(docs(spark, [(1, text)] * n)).select("n_words", "n_removed").distinct().collect()
        spent.append(time.monotonic() - t)
        assert [tuple(x) for x in got] == [(400, 400)]
    assert spent[2] < 4 * spent[1] + 5


def test_factors_resume_at_the_boundary():
    pos, doc, src = np.array([0, 1, 2, 3, 9]), np.array([1, 1, 2, 2, 1]), np.array([5, 6, 0, 1, 9])
    assert substring_dedup.factors(pos, doc, src, 4) == [(0, 5, 1, 5), (2, 5, 2, 0), (9, 4, 1, 9)]


# ---- op5 --------------------------------------------------------------------------
def fingerprint(t):
    import xxhash

    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or "")).encode().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if h and sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark):
    r = random.Random(2)
    base = [" ".join(r.choice(["Alpha", "beta", "gamma", "ÉTÉ", "d"]) for _ in range(r.choice([1, 3, 4, 50, 300]))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t + " end") for i, t in enumerate(base)] + [(200, None), (201, " \t"), (202, LONG), (203, base[0])]
    got = {x["doc_id"]: (x["fingerprint"], x["component_id"]) for x in simhash_dedup.simhash_components(docs(spark, rows, extra=True)).collect()}
    prints = {i: fingerprint(t) for i, t in rows}
    want = groups(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    kept = simhash_dedup.keep_one(docs(spark, rows + [rows[0]], extra=True))
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(want.values())) and "_row" in kept.columns
    assert simhash_dedup.simhash_components(docs(spark, [])).count() == 0


def jaccard_groups(rows, k, least):
    """Smallest id of each component of word k-gram Jaccard similarity `least`."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, 1))}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both >= least * (len(sets[a]) + len(sets[b]) - both):
                a2, b2 = find(a), find(b)
                root[max(a2, b2)] = min(a2, b2)
    return sorted({find(i) for i in sets})


def test_near_copies_equal_brute_force(spark):
    import corpus_pipeline

    r = random.Random(8)
    vocab = [f"v{i}" for i in range(400)] + ["ÉTÉ", "Alpha"]
    rows = []
    for g in range(25):
        base = [r.choice(vocab) for _ in range(r.choice([2, 4, 5, 9, 60, 300]))]
        for _ in range(6):
            t = list(base)
            for _ in range(int(len(t) * r.choice([0, 0.005, 0.012, 0.02, 0.03, 0.05]))):
                t[r.randrange(len(t))] = r.choice(vocab)
            rows.append((len(rows), " ".join(t)))
    # a chain: ends are less alike than neighbours, and hold together through the middle
    chain = [f"c{i}" for i in range(200)]
    rows += [(500 + i, " ".join(chain[8 * i : 8 * i + 120])) for i in range(8)]
    rows += [(600, None), (601, " "), (602, LONG), (603, LONG.upper()), (604, rows[3][1])]
    want = jaccard_groups(rows, 5, 0.8)
    kept = corpus_pipeline.drop_near_copies(spark, docs(spark, rows + [rows[0]], extra=True), "")
    assert sorted(x["doc_id"] for x in kept.collect()) == want and "_row" in kept.columns
    assert corpus_pipeline.drop_near_copies(spark, docs(spark, []), "").count() == 0


def test_large_groups_of_edited_copies_equal_brute_force(spark):
    """Copies edited apart, cut short, extended alike and edited again: what the hub holds and what it lacks both link."""
    import corpus_pipeline

    r = random.Random(17)
    vocab = [f"v{i}" for i in range(3000)]
    rows = []
    for size in (80, 200):
        base = [r.choice(vocab) for _ in range(size)]
        tails = [[r.choice(vocab) for _ in range(size // 3)] for _ in range(2)]
        for _ in range(60):
            t = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 4, 6]) * size // 100):
                t[r.randrange(len(t))] = r.choice(vocab)
            kind = r.randrange(6)
            if kind == 0:
                t = t[: int(size * r.uniform(0.55, 1))]
            elif kind == 1:
                t = t[int(size * r.uniform(0, 0.45)) :]
            elif kind == 2:
                t += r.choice(tails)[: r.randrange(size // 3)]
            rows.append((len(rows), " ".join(t)))
            if r.random() < 0.4:
                t[r.randrange(len(t))] = r.choice(vocab)
                rows.append((len(rows), " ".join(t)))
    want = jaccard_groups(rows, 5, 0.8)
    kept = corpus_pipeline.drop_near_copies(spark, docs(spark, rows, extra=True), "")
    assert 10 < len(want) < len(rows) - 10 and sorted(x["doc_id"] for x in kept.collect()) == want


def edited(r, vocab, sizes, copies):
    """Texts and copies of each with a few words changed, cut or added."""
    rows = []
    for size in sizes:
        base = [r.choice(vocab) for _ in range(size)]
        for _ in range(copies):
            t = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 5]) * size // 100):
                t[r.randrange(len(t))] = r.choice(vocab)
            t = t[: int(size * r.uniform(0.8, 1))] if r.random() < 0.3 else t
            rows.append((len(rows), " ".join(t)))
    return rows


@pytest.mark.parametrize("limit", [2, 5, 1000])
def test_positional_index_of_near_copies_equals_brute_force(limit):
    """The pipeline's simhash_dedup: pairs come from the tally of shared positional SimHash bytes, each once, or share a dense list."""
    r = random.Random(6)
    texts = [t.encode() for _, t in edited(r, [f"v{i}" for i in range(2000)], [60, 100, 150, 200, 400, 8], 14)]
    value, bound = near_copies.shingle_sets(texts)
    fp, n = near_copies.fingerprints(value, bound), np.diff(bound)
    # plain majorities of the same hashes
    for i in range(0, len(texts), 9):
        for w in range(near_copies.WORDS):
            h = near_copies.mix(value[bound[i] : bound[i + 1]] ^ near_copies._SALT[w])
            ones = [sum(int(x) >> b & 1 for x in h) for b in range(64)]
            assert int(fp[i].view("<u8")[w]) == sum(1 << b for b in range(64) if ones[b] * 2 > len(h))
    want = set()
    for i in range(len(texts)):
        for j in range(i):
            bits = int(np.bitwise_count(fp[i] ^ fp[j]).sum())
            most = near_copies.MOST_FEW if min(n[i], n[j]) < near_copies.FEW else near_copies.MOST
            if (fp[i] == fp[j]).sum() >= 3 and bits <= most and min(n[i], n[j]) >= 0.8 * max(n[i], n[j]) - 1e-9:
                want.add((j, i))
    rows, place = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(near_copies.POSITIONS)))
    x, y, sid, at, low = near_copies.meet(place, fp[rows, place], rows, n[rows], fp[rows], 0.8, limit)
    pairs = [(min(p), max(p)) for p in zip(x.tolist(), y.tolist(), strict=True)]
    together = collections.defaultdict(set)
    for s, p, k in zip(sid.tolist(), at.tolist(), low.tolist(), strict=True):
        together[p, k].add(s)
    shared = {(i, j) for g in together.values() for i in g for j in g if i < j}
    assert len(want) > 200 and len(pairs) == len(set(pairs)) and set(pairs) <= want <= set(pairs) | shared
    assert (set(pairs) == want and not shared) if limit == 1000 else shared
    # the tally finds whatever is similar enough to link here
    sets = [set(value[a:b].tolist()) for a, b in zip(bound[:-1], bound[1:], strict=True)]
    alike = {(j, i) for i in range(len(sets)) for j in range(i) if sets[i] != sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(alike) > 50 and alike <= want


def test_dense_lists_of_near_copies_lose_no_link(spark):
    """Lists over the limit go through hubs; a row that is there many times is one text."""
    r = random.Random(12)
    rows = edited(r, [f"v{i}" for i in range(900)], [90, 140], 40)
    got = near_copies.keep_one(docs(spark, rows + [rows[5]] * 20, extra=True), list_limit=3)
    assert sorted(x["doc_id"] for x in got.collect()) == jaccard_groups(rows, 5, 0.8)


def join_rows(spark, since):
    """Rows made by each join of the executions after `since`, summed by the join's text without numbers."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30000)
    store = spark._jsparkSession.sharedState().statusStore()
    runs, made = store.executionsList(), collections.Counter()
    for i in range(runs.size()):
        run = runs.apply(i).executionId()
        if run <= since:
            continue
        values, nodes = store.executionMetrics(run), store.planGraph(run).allNodes()
        for k in range(nodes.size()):
            node = nodes.apply(k)
            for m in range(node.metrics().size() if "Join" in node.name() else 0):
                metric = node.metrics().apply(m)
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    made[re.sub(r"#\d+L?|\d+", "", node.desc())] += int(values.apply(metric.accumulatorId()).replace(",", ""))
    return made


def test_joins_of_a_large_group_grow_with_it(spark):
    """The pipeline's simhash_dedup: no join makes a row for each pair, or for each list, of a group of edited copies."""
    made = []
    for copies in (100, 300):
        r = random.Random(21)
        base, rows = [f"v{r.randrange(3000)}" for _ in range(150)], []
        for i in range(copies):
            t = list(base)
            for _ in range(4):
                at = r.randrange(len(t))
                t[at : at + 1] = r.choice([[], [f"v{r.randrange(3000)}"], ["new", t[at]]])
            rows.append((i, " ".join(t)))
        runs = spark._jsparkSession.sharedState().statusStore().executionsList()
        since = max((runs.apply(i).executionId() for i in range(runs.size())), default=-1)
        kept = near_copies.keep_one(docs(spark, rows), list_limit=12)
        assert sorted(x["doc_id"] for x in kept.collect()) == jaccard_groups(rows, 5, 0.8)
        made.append(join_rows(spark, since))
    # 150 pairs a set; prefixes of deltas are some 40 shingles a set and hub
    assert max(made[0].values()) >= 100 and max(made[1].values()) <= 80 * 300, made


def test_steps_of_dense_lists_lose_no_link(spark, monkeypatch):
    """Groups within groups that were edited alike take several steps, each with hubs of its own."""
    r = random.Random(23)
    base, rows = [f"v{i}" for i in range(120)], []
    kinds = [base, [w for i, w in enumerate(base) if i % 9], [w if i % 8 else f"w{i}" for i, w in enumerate(base)], base[:80] + [f"x{i}" for i in range(40)]]
    for kind in kinds:
        for _ in range(30):
            t = list(kind)
            for at in r.sample(range(0, 75, 5), r.choice([1, 2, 3, 4, 5])):
                t[at] = f"e{at}"
            t = t[r.choice([0, 0, 10, 25]) :]
            rows.append((len(rows), " ".join(t)))
    steps, deltas = [], near_copies._deltas
    monkeypatch.setattr(near_copies, "GROWTH", 2)
    monkeypatch.setattr(near_copies, "_deltas", lambda *a: steps.append(1) or deltas(*a))
    got = near_copies.keep_one(docs(spark, rows), list_limit=1)
    want = jaccard_groups(rows, 5, 0.8)
    assert len(steps) > 1 and 8 < len(want) < 100 and sorted(x["doc_id"] for x in got.collect()) == want


@pytest.mark.parametrize("limit", [4, 64])
def test_dense_lists_lose_no_link(spark, limit):
    r = random.Random(3)
    centre, pts = [r.getrandbits(64) for _ in range(3)], set()
    for _ in range(250):
        x = r.choice(centre)
        for _ in range(r.randint(0, 8)):
            x ^= 1 << r.randrange(64)
        pts.add(x)
    frame = spark.createDataFrame([(simhash_dedup._signed(x),) for x in pts], "fp long")
    found = {x["node"]: x["root"] for x in components.components(simhash_dedup.links(frame, limit)).collect()}
    want = groups({simhash_dedup._signed(x): x for x in pts})
    assert all(found.get(i, i) == want[i] for i in want)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {x["node"]: x["root"] for x in components.components(edges).collect()}
    assert {found[i] for i in range(61)} == {0} and found[101] == 100


# ---- op10 -------------------------------------------------------------------------
def water(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    t, full, total = {}, set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = {s: rest * w[s] / sum(w[x] for x in names if x not in full) for s in names if s not in full}
        over = {s for s, v in share.items() if v > 3 * sizes[s]}
        if not over:
            return share | {s: 3.0 * sizes[s] for s in full}
        full |= over


def test_mixing_targets_and_takes(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(r.choice([0, 1, 40, 300]))), r.choice(["a", "B", "é", None, "tiny"])) for i in range(500)]
    rows = [(i, t, s if s != "tiny" or i % 40 == 0 else "a") for i, t, s in rows] + [(900, None, "empty"), (3, rows[3][1], rows[3][2])]
    df = docs(spark, rows, "doc_id long, text string, source string", extra=True)
    got = mixing.mix(df, shard_words=20_000).collect()
    src = {i: s for i, _, s in rows}
    sizes = collections.Counter()
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
    want = water(dict(sizes))
    taken = collections.Counter()
    for x in got:
        assert x["target"] == pytest.approx(want[src[x["doc_id"]]]) and 0 <= x["taken"] <= 3 * x["size"]
        taken[src[x["doc_id"]]] += x["taken"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 0.01 * want[s] + 8 for s in want)
    again = mixing.mix(df.repartition(5), shard_words=20_000).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    out = mixing.take(df, shard_words=20_000)
    assert out.columns == df.columns
    assert out.select(F.sum(mixing.n_words(F.col("text")))).first()[0] == sum(taken.values())
    assert mixing.mix(df.limit(0)).count() == 0


def plain_mix(rows, shard_words, max_epochs=3):
    """{(doc_id, text, source): words taken by all its rows}, step by step: shards, seats, quotas, blocks."""
    import xxhash

    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    n = lambda t: len((t or "").split())
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += n(t)
    target = water(dict(sizes))
    streams = collections.defaultdict(list)
    for i, t, s in rows:
        order, tie = md5(f"17:{'' if i is None else i}"), md5(t or "")
        h = xxhash.xxh64_intdigest(tie.encode(), xxhash.xxh64_intdigest(order.encode(), 42))
        h -= 1 << 64 if h >= 1 << 63 else 0
        streams[s, h % max(1, -(-sizes[s] // shard_words))].append((order, tie, (i, t, s)))
    shape = {}
    for k, docs_ in streams.items():
        length = sum(n(x[2][1]) for x in docs_)
        per = max(1, -(-length // max(1, -(-length // mixing.BLOCK_WORDS))))
        shape[k] = (per, -(-length // per))
    blocks = collections.Counter()
    for (s, _), (_, m) in shape.items():
        blocks[s] += m
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)

    def seats(votes, count):
        won = [0] * len(votes)
        for _ in range(count if any(votes) else 0):
            won[max(range(len(votes)), key=lambda j: (votes[j] / (2 * won[j] + 1), -j))] += 1
        return won

    votes = [target[s] * blocks[s] / sizes[s] if sizes[s] else 0.0 for s in names]
    quota = {s: min(q, max_epochs * blocks[s]) for s, q in zip(names, seats(votes, math.floor(sum(votes) + 0.5)), strict=True)}
    out = collections.Counter()
    for s in names:
        mine = sorted(h for x, h in streams if x == s)
        for h, q in zip(mine, seats([float(shape[s, h][1]) for h in mine], quota[s]), strict=True):
            (per, m), at = shape[s, h], 0
            q = min(q, max_epochs * m)
            for _, _, doc in sorted(streams[s, h], key=lambda x: x[:2]):
                for w in range(at, at + n(doc[1])):
                    j = w // per
                    out[doc] += ((j + 1) * q + m // 2) // m - (j * q + m // 2) // m
                at += n(doc[1])
    return out


def test_mixing_shards_equal_plain_python(spark):
    r = random.Random(9)
    rows = [(r.choice([None, 1, i, i]), " ".join(r.choice("xyz") for _ in range(r.choice([0, 3, 50, 200]))), r.choice(["hot", "hot", "b", None])) for i in range(260)]
    rows += rows[:20] + [rows[4]] * 30
    got = collections.Counter()
    df = docs(spark, [(*x, k) for k, x in enumerate(rows)], "doc_id long, text string, source string, extra int")
    key = collections.defaultdict(int)
    for x in mixing.mix(df, shard_words=2_000).collect():
        key[x["doc_id"], x["size"]] += x["taken"]
    want = plain_mix(rows, 2_000)
    for (i, t, _), v in want.items():
        got[i, len((t or "").split())] += v
    assert {k: v for k, v in key.items() if v} == {k: v for k, v in got.items() if v}
    # the mix itself, twins told apart by the other column, the same on every run
    out = sorted((x["extra"], x["text"]) for x in mixing.take(df, shard_words=2_000).collect())
    assert out == sorted((x["extra"], x["text"]) for x in mixing.take(df.repartition(7), shard_words=2_000).collect())
    assert sum(len(t.split()) for _, t in out) == sum(want.values())


def test_apportion_is_sainte_lague(spark):
    r = random.Random(1)
    votes = [("p" + str(i), r.uniform(0, 100)) for i in range(9)] + [("z", 0.0)]
    for seats in (0, 1, 7, 40, 1000):
        df = spark.createDataFrame([(n, v, seats) for n, v in votes], "name string, v double, s long")
        got = {x["name"]: x["q"] for x in mixing.apportion(df, [], "v", "s", ["name"], "q").collect()}
        won = dict.fromkeys(got, 0)
        for _ in range(seats):
            best = max(votes, key=lambda nv: (nv[1] / (2 * won[nv[0]] + 1), [-ord(c) for c in nv[0]]))
            won[best[0]] += 1
        assert got == won


# ---- op4 --------------------------------------------------------------------------
def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    r = random.Random(1)
    odd = "abcDEFéÄßñ 0123 ²½ .,!'’“_- \t\n\x0b\x85\xa0 ΣΑσ İı ́ 漢字 😀 's 'll don't \x1c\x01 <|endoftext|>"
    plain = "abcDEFéÄßñ 0123 .,!'’“_- \t\n's 'll don't"
    rows = [(i * 3, "".join(r.choice(odd if i % 2 else plain) for _ in range(r.choice([0, 5, 50, 400])))) for i in range(200)]
    rows += [(1, None), (4, "it's I'll !!'s x<|endoftext|>y -_-"), (5, LONG)]
    want, start = {}, 0
    for i, t in sorted(rows):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = token_store.token_store(docs(spark, rows, extra=True), tokenizer_path()).collect()
    assert {x["doc_id"]: (x["start"], x["n_tokens"], x["ids_crc32"]) for x in got} == want
    assert token_store.token_store(docs(spark, []), tokenizer_path()).count() == 0
    twice = token_store.token_store(docs(spark, [(1, "a"), (1, "a"), (None, "b")]), tokenizer_path()).collect()
    assert sorted((x["doc_id"] is None, x["start"], x["n_tokens"]) for x in twice) == [(False, 2, 2), (False, 4, 2), (True, 0, 2)]


def test_token_store_splits_repeated_ids_over_shards(spark):
    rows = [(None, f"text number {i}") for i in range(300)] + [(5, f"more {i}") for i in range(300)]
    root = "file:" + tempfile.mkdtemp()
    manifest = token_store.write_tokens(docs(spark, rows), root, tokenizer_path(), shard_bytes=1_000)
    assert len(manifest) >= 6 and max(m["n_docs"] for m in manifest) < 250
    got = token_store.read_digest(spark, manifest).collect()
    assert len(got) == 600 and sorted(x["start"] for x in got)[0] == 0
    at = 0
    for x in sorted(got, key=lambda x: x["start"]):
        assert x["start"] == at
        at += x["n_tokens"]
    assert [x["doc_id"] for x in sorted(got, key=lambda x: x["start"])] == [None] * 300 + [5] * 300


def test_shard_reads_single_frames_and_checks_sums():
    import zstandard

    body = io.BytesIO()
    w = token_store.ShardWriter(body, frame_bytes=100)
    texts = [np.arange(n, dtype="<u2").tobytes() for n in (3, 60, 0, 10, 200)]
    for t in texts:
        w.add(t)
    w.close([1, 2, None, 4, 5], 2)
    raw = body.getvalue()
    r = token_store.ShardReader(io.BytesIO(raw), len(raw))
    assert [r.ids(k).tolist() for k in (4, 0, 2, 3, 1)] == [list(range(n)) for n in (200, 3, 0, 10, 60)] and r.null.tolist() == [0, 0, 1, 0, 0]
    # any zstandard reader skips the index and the table
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True) as z:
        assert z.read() == b"".join(texts)
    bad = bytearray(raw)
    bad[-10] ^= 1  # a checksum in the table
    last = token_store.ShardReader(io.BytesIO(bytes(bad)), len(bad))
    with pytest.raises(ValueError):
        last.ids(4)


# ---- op8 --------------------------------------------------------------------------
SAMPLE = {"en": "the house and the tree with water from this river that was there before winter came".split(), "de": "das haus und der baum mit wasser aus diesem fluss der vor dem winter schon da war".split(), "fr": "la maison et l’arbre avec de l’eau de cette rivière qui était là avant l’hiver".split()}


def labelled(n=90, seed=1):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(SAMPLE[lang]) for _ in range(r.choice([4, 30, 80]))), lang) for i, lang in ((i, list(SAMPLE)[i % 3]) for i in range(n))]


def test_language_id_accuracy_and_cases(spark):
    rows = labelled() + [(500, None, "en"), (501, "123 !! …", None), (502, "the house and the tree das haus und der baum mit wasser aus diesem fluss", None), (504, "ⱥ ⱥ", None), (503, LONG[:200] + " the water " * 20_000, "en")]
    df = docs(spark, rows, "doc_id long, text string, lang string", extra=True)
    model = language_id.fit(df)
    got = {x["doc_id"]: x for x in language_id.identify(df, model, shares=True).collect()}
    held = [i for i, _, _ in labelled() if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(got[i]["held_out"] for i in held)
    lang = {i: x for i, _, x in rows}
    assert np.mean([got[i]["lang_pred"] == lang[i] for i in held]) >= 0.95
    assert got[500]["lang_pred"] == got[501]["lang_pred"] == "und" and got[500]["score"] == 0
    assert got[502]["shares"]["de"] > 0.3 and got[502]["shares"]["en"] > 0.2 and all(0 <= x["score"] <= 1 for x in got.values())
    assert got[504]["lang_pred"] == "de" and got[504]["score"] == pytest.approx(1 / 3)
    kept = language_id.keep_known(df, model)
    assert kept.columns == df.columns and {500, 501}.isdisjoint(x["doc_id"] for x in kept.select("doc_id").collect())
    none = language_id.fit(df.withColumn("lang", F.lit(None).cast("string")))
    assert {x["lang_pred"] for x in language_id.identify(df.limit(3), none).collect()} == {"und"}
    # the sample leaves the held-out fold aside
    swapped = df.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert "xx" not in language_id.fit(swapped).labels


def test_language_id_sample_is_bounded_and_tables_may_be_empty(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "train", lambda rows: seen.extend(rows))
    texts = ["the house", "the tree"]
    same = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 2 + 1).cast("int")).alias("text"), F.lit("en").alias("lang"))
    language_id.fit(same)  # an id outside the held-out fold
    assert len(seen) == language_id.DOCS_PER_LANG
    monkeypatch.undo()
    none = docs(spark, [], "doc_id long, text string, lang string")
    assert language_id.fit(none) is None
    assert language_id.identify(none, None).count() == 0 and language_id.keep_known(none, None).count() == 0
    # repeated rows are documents of their own
    rows = [*labelled(30), (1, "the house and the tree", "en"), (1, "the house and the tree", "en")]
    df = docs(spark, rows, "doc_id long, text string, lang string")
    assert language_id.identify(df, language_id.fit(df)).count() == 32


def test_op8_held_out_accuracy_on_the_table(spark, tiny):
    lang = spark.read.parquet(f"{tiny}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang")
    got = QUERIES["op8_language_id"](spark, tiny).where("held_out AND lang_pred <> 'und'").join(lang, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert got[1] >= 20 and got[0] >= 0.97


def test_scripts_led_by_e2_are_learned_and_kept(spark):
    r = random.Random(4)
    scripts = {"zgh": (0x2D30, 40), "cop": (0x2C80, 60), "cu": (0x2C00, 40)}
    word = lambda lang: "".join(chr(scripts[lang][0] + r.randrange(scripts[lang][1])) for _ in range(r.randint(3, 7)))
    rows = labelled() + [(1000 + i, " ".join(word(lang) for _ in range(30)), lang) for i in range(90) for lang in [list(scripts)[i % 3]]]
    df = docs(spark, rows + [(2000, "“…” — ‘₂’ © °", None), (2001, "ⱥ ⱥ", "en")], "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert not language_id.letters("“…” — ‘’ © ° ⱥ".encode()).any() and language_id.letters("ⵣ".encode()).all()
    got = {x["doc_id"]: x["lang_pred"] for x in language_id.identify(df, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows if i >= 1000)
    kept = {x["doc_id"] for x in language_id.keep_known(df, model).collect()}
    assert {i for i, _, _ in rows if i >= 1000} <= kept and 2000 not in kept
    # the same scores as identify(), also where no feature covers the letters
    assert 2001 in {x["doc_id"] for x in language_id.keep_known(df, model, 1 / len(model.labels)).collect()}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    score, move, begin = rng.normal(size=(150, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.zeros(150, bool)
    first[[0, 1, 70, 100]] = True
    got, parts = language_id.forward_backward(score, first, move, begin)
    cuts = [*np.flatnonzero(first), 150]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        al = [np.exp(begin + score[a])]
        for t in range(a + 1, b):
            al.append((al[-1] @ np.exp(move)) * np.exp(score[t]))
        be = [np.ones(3)]
        for t in range(b - 1, a, -1):
            be.append(np.exp(move) @ (np.exp(score[t]) * be[-1]))
        g = np.array(al) * np.array(be[::-1])
        assert np.allclose(got[a:b], g / g.sum(axis=1, keepdims=True))
    assert language_id._pairs(parts, first).sum() == pytest.approx(150 - 4)


# ---- op6 --------------------------------------------------------------------------
ITEM = "Yesterday a farmer named John Miller sold 12 crates of apples for 30 dollars, then John Miller bought 5 kg of seed for the farm."


def test_decontamination(spark):
    items = docs(spark, [(1, ITEM), (2, "one two"), (3, None), (4, "Mary Ann Jane Doe Smith Lee 1 2 3")], "item_id long, text string", extra=True)
    rows = [
        (1, "Before. " + ITEM.replace("John Miller", "Mary Stone").replace("12", "7").replace("30", "99.5") + " After."),
        (2, ITEM.replace("John Miller bought", "Peter Wood bought").replace("12", "7").replace("John", "Jim")),
        (3, None),
        (4, "yesterday a farmer sold apples"),
        (5, ITEM.upper()),
        (6, LONG),
        (7, "xx " + ITEM.lower() + " yy"),
        (1, "clean words only"),
    ]
    d = docs(spark, rows, extra=True)
    got = {(x["doc_id"], x["item_id"]): x for x in deco.report(d, items).collect()}
    assert (1, 1) in got and got[(1, 1)]["share"] == 1.0 and got[(1, 1)]["slot_consistency"] == 1.0
    assert {k[1] for k in got} == {1} and not {3, 4, 6} & {k[0] for k in got}
    strict = {x["doc_id"] for x in deco.report(d, items, min_consistency=1.0).collect()}
    assert 1 in strict and 2 not in strict
    wide = {(x["doc_id"], x["item_id"]) for x in deco.report(d, items, broadcast_windows=0).collect()}
    assert wide == set(got)
    kept = deco.drop_contaminated(d, items)
    assert kept.columns == d.columns and (1, "clean words only") in {(x["doc_id"], x["text"]) for x in kept.collect()}
    assert deco.report(d.limit(0), items).count() == 0 and deco.report(d, items.limit(0)).count() == 0


def by_hand(rows, items):
    """Containment of word 5-grams; for texts without numbers, names and units."""
    words = lambda t: re.sub(r"[^\w]+", " ", (t or "").lower()).split()
    grams = lambda w, n: {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}
    found = set()
    for i, t in rows:
        for k, u in items:
            n = min(5, len(words(u)))
            if n > 1 and len(grams(words(u), n) & grams(words(t), n)) >= 0.8 * len(grams(words(u), n)):
                found.add((i, k))
    return found


def test_decontamination_equals_brute_force_on_plain_words(spark):
    r = random.Random(6)
    vocab = [f"word{chr(97 + i)}" for i in range(12)]
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.choice([3, 9, 20])))) for k in range(15)]
    rows = []
    for i in range(80):
        base = [r.choice(vocab) for _ in range(30)]
        take = items[i % 15][1].split()
        if i % 2:
            base[5:5] = take[: max(1, int(len(take) * r.choice([0.5, 0.85, 1])))]
        rows.append((i, " ".join(base)))
    got = {(x["doc_id"], x["item_id"]) for x in deco.report(docs(spark, rows), docs(spark, items, "item_id long, text string")).collect()}
    assert got == by_hand(rows, items)


def test_decontamination_finds_names_at_sentence_starts_and_short_items(spark):
    items = [
        (1, "Alice has 5 apples. Bob gives Alice 7 more apples. How many apples does Alice have?"),
        (2, "Solve for x."),
        (3, "12 + 30 = 42"),
        (4, "Yes"),
        (5, ""),
    ]
    rows = [
        (10, "Carol has 9 apples. Dan gives Carol 4 more apples. How many apples does Carol have?"),
        (11, "So: Eve has 1 apples. Tom gives Eve 4,000 more apples. How many apples does Eve have? The end."),
        (12, "Carol has 9 pears. Dan gives Carol 4 more pears. How much does it cost?"),
        (13, "Now solve for x, please"),
        (14, "12+30 = 42"),
        (15, "12 + 31 = 43"),
        (16, "yes, yes"),
        (17, "YES"),
        (18, items[0][1].lower()),
        (19, "Alice has 5 apples. Bob gives Fred 7 more apples. How many apples does Gus have?"),
    ]
    got = {(x["doc_id"], x["item_id"]) for x in deco.report(docs(spark, rows), docs(spark, items, "item_id long, text string")).collect()}
    assert got == {(10, 1), (11, 1), (13, 2), (14, 3), (17, 4), (18, 1)} | ({(19, 1)} & got)
    strict = {(x["doc_id"], x["item_id"]) for x in deco.report(docs(spark, rows), docs(spark, items, "item_id long, text string"), min_consistency=1.0).collect()}
    assert (19, 1) not in strict and (10, 1) in strict


NAMES = ("Ada Ben Cleo Dov Eli Fay Gil Hana Ivo Jana Kai Lea".split(), "3 4 17 250 9.5 1,200".split(), "kg km miles hours".split())


def filled(template, rng):
    """A template with slots {n0} (names), {v0} (numbers) and {u0} (units) filled, one value per slot."""
    slots = {}

    def pick(m):
        kind = {"n": 0, "v": 1, "u": 2}[m[1]]
        taken = {v for k, v in slots.items() if k[0] == m[1]}
        return slots.setdefault(m[1] + m[2], rng.choice([v for v in NAMES[kind] if v not in taken]))

    return re.sub(r"\{([nvu])(\d)\}", pick, template)


def test_decontamination_equals_brute_force_on_templates(spark):
    r = random.Random(12)
    vocab = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(4)]

    def template():
        out = []
        for k in range(r.choice([8, 14, 20])):
            out.append(r.choice(["{n0}", "{n1}", "{v0} {u0}", "{v1}"]) if k % 4 == r.randrange(4) else r.choice(vocab))
        return " ".join(out)

    shapes = [template() for _ in range(12)]
    items = [(k, filled(t, r)) for k, t in enumerate(shapes)]
    rows = []
    for i in range(72):
        noise = lambda: " ".join(r.choice(vocab) for _ in range(12))
        body = filled(shapes[i % 12], r)
        if i % 3 == 2:  # only half of it
            body = " ".join(body.split()[: len(body.split()) // 2])
        rows.append((i, f"{noise()} {body} {noise()}"))

    def words(t):
        out = []
        for w in t.split():
            out.append(("N", w) if w in NAMES[0] else ("V", w) if w in NAMES[1] else ("U", w) if w in NAMES[2] else ("", w))
        return out

    want = set()
    for i, t in rows:
        d = words(t)
        for k, u in items:
            it = words(u)
            kind = lambda x: tuple(x[0] or x[1] for x in x)
            wins = {p: kind(it[p : p + 5]) for p in range(len(it) - 4) if sum(not x[0] for x in it[p : p + 5]) >= 2}
            ok = set()
            for shift in range(-len(it), len(d)):
                at = [p for p in wins if 0 <= p + shift and p + shift + 5 <= len(d) and kind(d[p + shift : p + shift + 5]) == wins[p]]
                spots = {q for p in at for q in range(p, p + 5) if it[q][0]}
                maps = {(it[q], d[q + shift]) for q in spots}
                if at and (not maps or len({m[0] for m in maps}) / len(maps) >= 0.75):
                    ok |= {wins[p] for p in at}
            if ok and len(ok) >= 0.8 * len(set(wins.values())):
                want.add((i, k))
    got = {(x["doc_id"], x["item_id"]) for x in deco.report(docs(spark, rows), docs(spark, items, "item_id long, text string")).collect()}
    assert got == want and len(want) >= 40


# ---- op1 --------------------------------------------------------------------------
def test_hnsw_recall_ties_and_cases(spark):
    r = random.Random(2)
    hot = [r.gauss(0, 1) for _ in range(8)]
    rows = [(i, hot if i % 3 == 0 else [r.gauss(0, 1) * r.choice([0.5, 3]) for _ in range(8)]) for i in range(600)]
    rows += [(1000, None), (1020, [0.0] * 8), (1040, [1.0, None] * 4), (1060, [float("nan")] * 8), (1080, [1.0, 2.0]), (1100, [2.0, 1.0]), (1101, [2.0, 2.0]), (20, rows[20][1]), (1120, []), (1140, [float("inf")] * 8)]
    d = docs(spark, rows, "vec_id long, embedding array<double>", extra=True)
    got = collections.defaultdict(dict)
    for x in hnsw.neighbours(d, F.col("vec_id") % 20 == 0, shard_rows=150).collect():
        got[x["query_id"]][x["rank"]] = (x["vec_id"], x["score"])
    ok = sorted({(i, tuple(v)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    for q, v in ok:
        if q % 20 == 0:
            want = sorted((-float(np.dot(v, w)), j) for j, w in ok if j != q and len(w) == len(v))[:20]
            mine = [got[q][k] for k in sorted(got[q])]
            assert [j for j, _ in mine] == [j for _, j in want] and np.allclose([s for _, s in mine], [-s for s, _ in want])
    assert set(got) == {i for i, _ in ok if i % 20 == 0}
    assert hnsw.neighbours(d.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_hnsw_graph_recall_and_files():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, size=(3000, 1))
    g = hnsw.Graph.build(x)
    q = rng.normal(size=(60, 24))
    true = np.argsort(-(q @ x.T), axis=1)[:, :20]
    body = io.BytesIO()
    g.save(body, extra=np.arange(3))
    g2, more = hnsw.Graph.load(io.BytesIO(body.getvalue()))
    found = g2.search(q, 20)
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found, true, strict=True)]) >= 0.95 and more["extra"].tolist() == [0, 1, 2]
    assert len(hnsw.Graph.build(x[:1]).search(q[:2], 5)[0]) == 1


def clusters(k, per, spread, dim, unit, seed=0):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(k, dim))
    x = (c / np.linalg.norm(c, axis=1, keepdims=True) if unit else c)[:, None] + spread * rng.normal(size=(k, per, dim))
    x = x.reshape(-1, dim)
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if unit else x
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize("k,per,spread,dim,unit", [(10, 500, 0.05, 64, True), (40, 200, 0.05, 64, True), (40, 200, 0.001, 64, True), (40, 200, 0.05, 32, False), (1, 8000, 1.0, 48, False)])
def test_hnsw_recall_on_clusters(k, per, spread, dim, unit):
    x = clusters(k, per, spread, dim, unit)
    g = hnsw.Graph.build(x)
    q = x[::40]
    found = g.search(q, 20)
    least = np.sort(q @ x.T, axis=1)[:, -20]
    assert np.mean([np.mean((n >= 0) & (x[n] @ v >= low - 1e-12)) for n, v, low in zip(found, q, least, strict=True)]) >= 0.9
    start = g.members[1] if len(g.members) > 1 else np.zeros(1, int)
    assert hnsw._reach(g.links[0], start).all()


def test_hnsw_merges_shards_above_ef(spark):
    x = clusters(10, 500, 0.05, 32, True)
    d = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = collections.defaultdict(dict)
    for r in hnsw.neighbours(d, F.col("vec_id") % 20 == 0, shard_rows=1500).collect():
        got[r["query_id"]][r["rank"]] = r["vec_id"]
    recall = []
    for i in range(0, len(x), 20):
        s = x @ x[i]
        s[i] = -np.inf
        recall.append(len(set(got[i].values()) & set(np.argsort(-s)[:20].tolist())) / 20)
        assert sorted(got[i]) == list(range(1, 21))
    assert np.mean(recall) >= 0.9


def test_hnsw_tiles_cover_all_once():
    built, blocks = [{"dim": 3, "path": f"g{i}"} for i in range(37)], [{"dim": 3, "path": f"b{i}"} for i in range(50)] + [{"dim": 4, "path": "x"}]
    for tasks in (1, 12, 10_000):
        pairs = [(g, b) for gs, bs in hnsw._tiles(built, blocks, tasks) for g in gs for b in bs]
        assert len(pairs) == len(set(pairs)) == 37 * 50


def test_op1_recall_on_the_table(spark):
    tiny = "/root/testdata/sf0.1"
    if not os.path.exists(tiny):
        pytest.skip("no test tables here")
    got = collections.defaultdict(set)
    for x in QUERIES["op1_hnsw_search"](spark, tiny).collect():
        got[x["query_id"]].add(x["vec_id"])
    rows = spark.read.parquet(f"{tiny}/embeddings.parquet").orderBy("vec_id").collect()
    e, ids = np.array([x["embedding"] for x in rows], dtype=float), np.array([x["vec_id"] for x in rows])
    recall = []
    for i in np.flatnonzero(ids % 20 == 0):
        s = e @ e[i]
        s[i] = -np.inf
        recall.append(len(got[ids[i]] & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.9


# ---- op3 --------------------------------------------------------------------------
PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_by_hand(t):
    out, n = [], []
    for k, p in PII.items():
        mine = []
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[k]:
                mine.append(f"{k}:{m.start()}:{m.end()}")
        out += mine
        n.append(len(mine))
    return (*n, hashlib.sha256(",".join(out).encode()).hexdigest()), out


def test_pii_base_equals_the_patterns_and_method_adds(spark):
    r = random.Random(5)
    rows = [(i, "".join(r.choice("ab1@.. +-()0123456789é😀%_ \n4") for _ in range(r.choice([0, 10, 60, 300])))) for i in range(400)]
    rows += [(5000 + i, "".join(r.choice("0123456789 - .") for _ in range(200))) for i in range(200)]
    some = ["4111 1111 1111 1111", "+1 (988) 555-2485", "42.144.35.254", "256.1.1.1", "a.b@c.d", "x@y", "001.2.3.0004", "4111-1111-1111-1111-", "0000000000000000000"]
    rows += [(7000 + i, " ".join(r.choice(some) for _ in range(6))) for i in range(150)]
    rows += [(9000, None), (9001, "a" * 50_000), (9002, "1" * 50_000), (9003, "1 " * 20_000), (9004, "+" * 20_000)]
    extra = [(9100, "call me at tel 415-555-1234 or mail joe [at] example [dot] com please"), (9101, "order 415 555 1234 was late"), (9102, "nothing here")]
    got = {x["doc_id"]: x for x in pii.digest(docs(spark, rows + extra, extra=True)).collect()}
    for i, t in rows:
        want, spans = base_by_hand(t)
        x = got[i]
        assert (x["n_email"], x["n_ip"], x["n_card"], x["n_phone"], x["base_sha256"]) == want, t
        assert set(spans) <= set(x["spans"].split(",")) | {""}
    assert got[9100]["n_method"] == 2 and got[9101]["n_method"] == 0 and got[9102]["spans"] == ""
    assert pii.digest(docs(spark, [])).count() == 0


# other sentences than those that the model is fitted on
UNSEEN = (
    ("email", "email", "Applications go to {} by noon"),
    ("email", "email", "signed, {}"),
    ("email", "aside", "He stood {} for hours"),
    ("ip", "ip6", "route via {} instead"),
    ("ip", "ip6", "blocked {} for abuse"),
    ("ip", "hex", "key bytes {} were wiped"),
    ("ip", "quad", "section {} explains it"),
    ("card", "card", "refund it onto {} today"),
    ("card", "card", "took {} as a deposit"),
    ("card", "number", "tracking code {} is unknown"),
    ("card", "number", "serial {} was recalled"),
    ("card", "stamp", "backup {} failed"),
    ("phone", "phone", "text Mia on {} first"),
    ("phone", "phone", "our hotline {} is free"),
    ("phone", "part", "article {} is sold out"),
    ("phone", "part", "build {} crashed"),
    ("phone", "date", "due {} at the latest"),
)


def test_pii_method_on_unseen_sentences(spark):
    """Precision and recall per kind on sentences and values of another generator run; README has the figures."""
    model, limits = pii.fit(spark)
    assert len(set(limits.values())) > 1
    rows = pii.labelled(spark, pii.examples(UNSEEN, 40, 99))
    kinds, x = pii._matrix(rows)
    p = model.probability(x)
    for k in pii.KINDS:
        mine = [i for i, a in enumerate(kinds) if a == k]
        said = [i for i in mine if p[i] >= limits[k]]
        good = sum(rows[i]["label"] for i in said)
        precision, recall = good / max(1, len(said)), good / sum(rows[i]["label"] for i in mine)
        print(f"{k}: limit {limits[k]:.3f}, precision {precision:.3f}, recall {recall:.3f}, rows {len(mine)}")
        # a national phone number and a part number look alike; only the sentence tells
        assert precision >= (0.75 if k == "phone" else 0.8) and recall >= (0.3 if k == "phone" else 0.7), k


def test_pii_repeated_rows_and_cards_side_by_side(spark):
    two = "paid with 4111 1111 1111 1111 5500005555555559 today"
    rows = [(1, two)] * 3 + [(None, two), (2, "")]
    got = pii.digest(docs(spark, rows)).collect()
    assert len(got) == 5 and len({(x["n_card"], x["spans"]) for x in got if x["doc_id"] != 2}) == 1
    one = next(x for x in got if x["doc_id"] == 1)
    assert one["n_card"] == 0 and one["spans"] == "card:10:29,card:30:46"


def test_redaction_and_trees(spark):
    df = docs(spark, [(1, "mail a@b.co now, 😀 +1 (988) 555-2485.")])
    spans = pii.find_pii(df).select("doc_id", F.concat("base", "method").alias("s"))
    out = df.join(spans, "doc_id").select(pii.redact(F.col("text"), F.col("s"))).first()[0]
    assert out == "mail [EMAIL] now, 😀 [PHONE]."
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 2))
    m = boosting.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(int), ["a", "b"])
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in x[:50]], "a double, b double")
    p = [r[0] for r in frame.select(m.expression({"a": F.col("a"), "b": F.col("b")})).collect()]
    assert np.allclose(p, m.probability(x[:50])) and (((x[:, 0] > 0) ^ (x[:, 1] > 0)) == (m.probability(x) > 0.5)).mean() > 0.9


# ---- op7 and op9 --------------------------------------------------------------------
PAGE = """<!doctype html><html><head><title>T</title></head><body class="x1"><header>Top menu</header><nav><ul><li><a href="/">Home</a></ul></nav>
<div id="cookie-notice">We use cookies</div><div class="content"><div class="post-12"><h2>Ti&eacute;tle &amp; more</h2><p>Hello   <i>big</i>&nbsp;world, with enough text to win the vote of this page.<br>next
<p class="advert">Buy now<p>Second<script>var a="<p>no</p>";</script><div class="share">share me</div><ul><li>one</li><li>two</ul><form>go<input></form></div>
<div class="comments"><p>Nice! I like it very much, and I write a really long comment here because I can do it very well, yes, very well.</p></div></div><aside>Side</aside><footer>foot</footer>"""
TEXT = "Tiétle & more\nHello big world, with enough text to win the vote of this page. next\nSecond\none\ntwo"


def test_html_extraction(spark):
    odd = PAGE.replace("post-12", "post-7").replace("Second", "Other")
    short = '<html><body><div class="content"><div class="post-9"><p>Hi</p></div></div><div class="big"><p>' + "unrelated long words " * 30 + "</p></div></body></html>"
    rows = [(i, f"http://h.org/{i}", PAGE) for i in range(6)] + [(10, "http://h.org/x", odd), (11, "http://h.org/y", short), (12, None, None), (13, "http://n.org/", ""), (14, "http://t.org/", "<p>cut <b>off"), (15, "bad", "<a title=\"x>y</a><div><p>t" + "<div>" * 3000)]
    d = docs(spark, rows, "page_id long, url string, html string", extra=True)
    got = {x["page_id"]: x for x in html_extraction.extract_main_text(d).collect()}
    assert got[0]["text"] == TEXT and got[10]["text"] == TEXT.replace("Second", "Other") and got[0]["n_chars"] == len(TEXT)
    assert got[11]["text"] == "Hi"  # the host's path wins over the page's own best
    assert (got[12]["text"], got[13]["text"], got[14]["text"]) == ("", "", "cut off")
    wide = {x["page_id"]: x["text"] for x in html_extraction.extract_main_text(d, broadcast_hosts=0).collect()}
    assert wide == {k: x["text"] for k, x in got.items()}
    assert html_extraction.extract_main_text(d.limit(0)).count() == 0


def test_html_main_heading_and_boilerplate():
    body = "<p>" + "long text of the post " * 40 + "</p>"
    text = "long text of the post " * 40
    find = html_extraction.extract
    assert find(f'<body><div class="logo"><h1>Site</h1></div><div class="post"><h1>Title</h1><div class="entry">{body}</div></div>', []) == "Title\n" + text.strip()
    assert find(f'<body><div class="logo"><h1>Site</h1></div><div class="content">{body}</div><div class="sidebar">x</div>', []) == text.strip()
    assert find(f'<main><h1>T</h1><article>{body}<section id="comments"><p>{"nice " * 300}</p></section></article><div role="complementary">y</div></main>', []) == "T\n" + text.strip()


def test_html_keeps_text_inside_the_article_and_stays_linear():
    page = '<article><p>one two three</p><section class="related-work"><p>kept text here</p></section><p class="menu-prices">and prices</p><div class="comment-list"><p>gone</p></div></article>'
    assert html_extraction.extract(page, []) == "one two three\nkept text here\nand prices"
    assert html_extraction.extract('<body><div class="side-by-side"><p>all the text</p></div></body>', []) == "all the text"
    links = '<div id="x"><p>kept kept kept</p><div class="related-things"><a href=x>link one</a> <a href=y>two</a></div></div>'
    assert html_extraction.extract('<div class="sidebar-left"><p>gone</p></div>' + links, []) == "kept kept kept"
    for name, want in {"ad": 2, "share-buttons": 2, "top-header": 2, "SiteHeader": 2, "widget3": 2, "shade": 0, "adapter": 0, "header": 0, "ad-hoc": 1, "navigation-theory": 1}.items():
        assert html_extraction.named(name) == want, name
    for page in ("<p>a</p>" + "<button>x" * 200_000, "<div>" * 50_000 + "x", "<section><p>x</p>" * 20_000 + "</nav>" * 20_000, "<a '" * 50_000, "<!-- " * 50_000):
        began = time.monotonic()
        html_extraction.extract(page, [])
        assert time.monotonic() - began < 8
    assert html_extraction.parse("<svg><p>in</p></svg><p>out</p><svg><p>open</p>")[1][0][1] == "out"


def test_html_repeated_rows_and_nulls(spark):
    rows = [(1, "http://a/x", PAGE)] * 3 + [(None, "http://a/y", None), (2, None, PAGE)]
    got = html_extraction.extract_main_text(docs(spark, rows, "page_id long, url string, html string")).collect()
    assert sorted((x["page_id"] or 0, x["n_chars"]) for x in got) == [(0, 0), (1, len(TEXT)), (1, len(TEXT)), (1, len(TEXT)), (2, len(TEXT))]


def test_html_on_the_table(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    got = {x["page_id"]: x["text"] for x in QUERIES["op7_html_extraction"](spark, tiny).collect()}
    for x in pages.collect():
        body = re.search(r"<article>(.*?)</article>", x["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", s)).split()) for s in re.split(r"</?(?:p|h1)>", body)]
        assert got[x["page_id"]] == "\n".join(p for p in parts if p)


def test_url_filter(spark):
    urls = [
        "https://www.Casino-WIN.example.net/en/14?x", "http://a.org/es/", "http://example.org/es/1", "http://x.example.org/en/12", "http://x.example.org/en/2", "http://b.com/fr/", "http://b.com/de/1", "http://org",
        None, "no scheme", "http://freecasinobonus.net/a", "http://gardenclub.net/news", "http://notorg/", "ftp://ÄB.net#frag", "http://u.net?q=://x.org/",
    ]
    rows = list(enumerate(urls)) + [(100 + i, f"http://site{i % 7}garden.net/en/{i}") for i in range(60)] + [(200 + i, f"http://m.casino-win.net/en/{i}") for i in range(10)] + [(300, "http://x.net/" + "a" * 100_000)]
    got = {x["page_id"]: x for x in url_filter.judge(docs(spark, rows, "page_id long, url string", extra=True)).collect()}
    rule = {i: (got[i]["rule"], got[i]["verdict"]) for i in range(len(urls))}
    assert (got[0]["host"], got[0]["path"]) == ("www.casino-win.example.net", "/en/14") and rule[0] == (None, "block")
    assert rule[1] == ("org/", "allow") and rule[2] == ("example.org/es/", "block") and rule[3] == ("example.org/en/1", "block") and rule[4] == ("org/", "allow")
    assert rule[5] == ("com/fr/", "allow") and rule[6] == ("com/de/", "block") and rule[7] == (None, "allow") and rule[12] == (None, "allow")
    assert (got[8]["host"], got[8]["path"], rule[8]) == ("", "", (None, "allow")) and got[9]["host"] == ""
    assert got[10]["host_words"].startswith("free casino") and rule[10] == (None, "block") and rule[11] == (None, "allow")
    assert got[13]["host"] == "Äb.net" and got[14]["host"] == "u.net"
    assert url_filter.judge(docs(spark, [], "page_id long, url string")).count() == 0


def every_cut(run):
    for cuts in range(1 << (len(run) - 1)):
        out, at = [], 0
        for i in range(1, len(run) + 1):
            if i == len(run) or cuts >> (i - 1) & 1:
                out.append(run[at:i])
                at = i
        yield tuple(out)


def test_segmentation_equals_enumeration_at_every_corpus_size():
    counts = {"in": 40, "cas": 3, "s": 25, "a": 30, "news": 50, "bonus": 2, "gar": 1, "den": 4, "obonu": 1}
    seg = url_filter.Segmenter(url_filter.unigrams(counts))
    big = url_filter.Segmenter(url_filter.unigrams({w: c * 100_000 for w, c in counts.items()}))
    price = lambda ws: sum(seg.cost.get(w, seg.base + seg.step * len(w)) for w in ws)
    for run in ("freebonus", "gardenclub", "newscasino", "xqzzy", "casinobonus", "aaaa", "é"):
        got = seg.words(run)
        assert "".join(got) == run and math.isclose(price(got), min(map(price, every_cut(run)))) and big.words(run) == got
    assert big.words("freecasinobonus") == ("free", "casino", "bonus")


def test_url_filter_equals_plain_python(spark):
    r = random.Random(5)
    hosts = ["a.org", "x.example.org", "shop.com", "best-casino.net", "my.gardennews.net", "example.org", "freeloans.info"]
    rows = [(i % 40, r.choice([f"http://{r.choice(hosts)}/{r.choice(['en/1', 'es', 'de/w', 'fr/wein', 'news', 'bonus/x'])}/{r.choice('abc')}{i % 9}", None, "x", "http://A.com/de/1"])) for i in range(300)]
    rows += rows[:5]
    got = url_filter.judge(docs(spark, rows, "page_id long, url string")).collect()

    def parse(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]

    def rule(host, path):
        fit = [(h + p, say) for say, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fit, key=lambda x: len(x[0])) if fit else None

    words = collections.Counter(w for _, u in rows for w in re.findall(r"[^\W\d_]+", parse(u)[1].lower()))
    seg = url_filter.Segmenter(url_filter.unigrams(dict(words)))
    tally = collections.defaultdict(lambda: [0.0, 0.0])
    for _, u in rows:
        if rule(*parse(u)):
            h, p = url_filter.words_of(seg, *parse(u))
            for w in [("h", w) for w in h] + [("p", w) for w in p]:
                tally[w][rule(*parse(u))[1] == "block"] += 1
    for i, lexicon in enumerate((url_filter.HOST_WORDS.split(), url_filter.BLOCK_WORDS.split())):
        weight = max(sum(v[i] for v in tally.values()) / len(lexicon), 1.0)
        for w in lexicon:
            tally[("h", w)][i] += weight
    whole = [sum(v[i] for v in tally.values()) + len(tally) for i in (0, 1)]
    want = []
    for i, u in rows:
        h, p = url_filter.words_of(seg, *parse(u))
        score = sum(math.log((tally[w][1] + 1) / whole[1]) - math.log((tally[w][0] + 1) / whole[0]) for w in [("h", w) for w in h] + [("p", w) for w in p] if w in tally)
        found = rule(*parse(u))
        want.append((i, *parse(u), found[0] if found else None, found[1] if found else "block" if score > 0 else "allow", round(score, 6)))
    # the words here share no place, so the table of places is exact
    assert len({url_filter.place(*w) for w in tally}) == len(tally)
    assert sorted(((x["page_id"], x["host"], x["path"], x["rule"], x["verdict"], round(x["score"], 6)) for x in got), key=repr) == sorted(want, key=repr)
    assert {x["verdict"] for x in got if x["host"] == "best-casino.net"} >= {"block"}


# ---- pipeline -------------------------------------------------------------------------
def test_pipeline_stages(spark, tiny):
    import corpus_pipeline
    from lodestone.llm.scratch import materialise

    df = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, n = df.columns, df.count()
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "benchmark_decontamination", "source_mixing", "token_store"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = materialise(stage(spark, df, tiny), name)
        assert df.columns == columns
        assert name == "source_mixing" or 0.8 * n <= df.count() <= n
    out = corpus_pipeline.STAGES[-1][1](spark, df, tiny)
    assert out.count() == df.count()
    assert corpus_pipeline.run(spark, tiny).count() == df.count()
