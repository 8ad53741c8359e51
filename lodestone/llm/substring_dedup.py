"""Substring dedup by relative Lempel-Ziv parsing (operator 2).

Every word run of ``window`` words that also starts elsewhere in the corpus
is a duplicate.  The reference is the corpus itself, cut into blocks:

1. *Cut.* Each text is cut into phrases: maximal runs of consecutive windows
   with the same anchor (the smallest hash of a ``gram``-word run inside the
   window).  A window's anchor depends on its words alone, so equal windows
   always meet under the same anchor: an anchor's phrases form one reference
   block, and no block other than its own can hold a window's match.
2. *Index.* Anchors met only once hold nothing that repeats and leave.  For
   the others, equal phrases are collapsed (pre-aggregated before the
   shuffle) to their first occurrence; only blocks in which different phrases
   meet are opened down to single windows.  This keeps very frequent passages
   to one row per map task.
3. *Factor.* Each document is read from left to right against the blocks:
   the longest run of windows whose sources are consecutive in the reference
   is one factor.  After each factor the windows that straddle its end are
   checked before the parse goes on, so that a repeat that crosses two factors
   is not missed.  Factors are never shorter than ``window`` words; the words
   they cover are removed.

The work is linear in the text, repeated rows included: what a text's phrases
meet is gathered once per distinct (doc_id, text) and phrase start, as a set
that is built up on the map side.  Phrases and windows are compared by 128
bits of hash, from two independent families.  All joins are equi-joins with
one unique side; a hot anchor only makes that side's partner long, which
adaptive execution splits.

Cases: null text is empty (0 words, nothing removed, hash of the empty
string).  Texts under ``window`` words never lose words.  Overlapping repeats
inside one text count.  Repeated rows are documents of their own.  An empty
table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import wordhash as wh
from lodestone.llm.scratch import discard, materialise, release, text_batches

WINDOW = 35
GRAM = 8
#: windows in one phrase at most; longer runs (periodic text) are several phrases
PHRASE = 64


def _phrases(w: wh.Words, window: int, gram: int):
    """Phrases of a block: anchor, first window, number of windows, owner, n-gram hashes, anchors by window."""
    h = w.hashes()
    n_win = len(h) - window + 1
    empty = np.zeros(0, np.int64)
    if n_win <= 0:
        return np.zeros(0, np.uint64), empty, empty, empty, h, empty
    g = wh.grams(h, gram)
    span = window - gram + 1
    anchor = wh.sliding_min(g, span)
    ok = w.owner[:n_win] == w.owner[window - 1 :]
    at = np.flatnonzero(ok)
    if not len(at):
        return np.zeros(0, np.uint64), empty, empty, empty, h, empty
    new = np.ones(len(at), bool)
    new[1:] = (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(at)))
    pieces = -(-count // PHRASE)
    if pieces.max() > 1:
        base = np.repeat(starts, pieces)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        end = np.repeat(starts + count, pieces)
        starts = base + step * PHRASE
        count = np.minimum(PHRASE, end - starts)
    first = at[starts]
    fp = anchor[first]
    # a window can recur inside its own phrase only if the anchor does
    own = count > span
    short = np.flatnonzero(~own)
    for lo in range(0, len(short), 1 << 15):
        s = short[lo : lo + (1 << 15)]
        cols = np.arange(2 * span - 1)
        idx = first[s][:, None] + cols
        inside = cols < (count[s] + span - 1)[:, None]
        own[s] = ((g[np.minimum(idx, len(g) - 1)] == fp[s][:, None]) & inside).sum(axis=1) > 1
    return fp, first, count, w.owner[first], h, own


PHRASES = "fp long, phrase long, doc_id long, tkey long, first int, n int, own boolean"


def _cut(window: int, gram: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            ids, keys = pdf["doc_id"], pdf["tkey"].to_numpy()
            for at, texts in wh.blocks(pdf["text"]):
                w = wh.Words(texts)
                fp, first, count, owner, h, own = _phrases(w, window, gram)
                if not len(fp):
                    continue
                # the anchor is of the first family of hashes, the body of the second
                body = wh.spans_hash(w.hashes(1), first, first + count + window - 1, 1)
                yield pd.DataFrame(
                    {
                        "fp": fp.view(np.int64),
                        "phrase": body.view(np.int64),
                        "doc_id": ids.iloc[at + owner].array,
                        "tkey": keys[at + owner],
                        "first": (first - w.first[owner]).astype(np.int32),
                        "n": count.astype(np.int32),
                        "own": own,
                    }
                )

    return run


OPENED = "h1 long, h2 long, fp long, phrase long, off int, doc_id long, pos int"


def _open(window: int):
    """Single windows of the phrases asked for in each text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            wanted = pdf["wanted"].tolist()
            ids = pdf["doc_id"]
            for at, texts in wh.blocks(pdf["text"]):
                w = wh.Words(texts)
                a, b = w.hashes(0), w.hashes(1)
                rows = [(k, int(r["fp"]), int(r["phrase"]), int(r["first"]), int(r["n"])) for k in range(len(texts)) for r in wanted[at + k]]
                if not rows:
                    continue
                owner, fp, phrase, first, n = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
                off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                pos = np.repeat(first, n) + off
                start = np.repeat(w.first[owner], n) + pos
                yield pd.DataFrame(
                    {
                        "h1": wh.spans_hash(a, start, start + window, 0).view(np.int64),
                        "h2": wh.spans_hash(b, start, start + window, 1).view(np.int64),
                        "fp": np.repeat(fp, n),
                        "phrase": np.repeat(phrase, n),
                        "off": off.astype(np.int32),
                        "doc_id": ids.iloc[at + np.repeat(owner, n)].array,
                        "pos": pos.astype(np.int32),
                    }
                )

    return run


def factors(pos: np.ndarray, src_doc: np.ndarray, src_pos: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy parse: (start, words, source document, source start) of each factor.

    pos: the starts of indexed windows in ascending order, with their sources.
    Each factor follows one source as far as it goes; the parse resumes at the
    first window that reaches past the factor's end, which is the check at the
    boundary.
    """
    out = []
    if not len(pos):
        return out
    breaks = np.flatnonzero((np.diff(pos) != 1) | (np.diff(src_pos) != 1) | (np.diff(src_doc) != 0)) + 1
    ends = np.append(breaks, len(pos))
    i = 0
    while i < len(pos):
        last = ends[np.searchsorted(ends, i, side="right")] - 1
        out.append((int(pos[i]), int(pos[last] - pos[i]) + window, int(src_doc[i]), int(src_pos[i])))
        i = last + 1
    return out


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_factors long, spans array<struct<start:int,words:int,source_doc:long,source_start:int>>"


def _factor(window: int, keep_text: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for doc_id, text, hits in zip(pdf["doc_id"].array, pdf["text"], pdf["hits"], strict=True):
                words = text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []
                found = []
                if hits is not None and len(hits):
                    pos, src_doc, src_pos = [], [], []
                    for r in hits:
                        if r["sources"] is None:
                            n = r["n"]
                            pos.append(np.arange(r["first"], r["first"] + n))
                            src_doc.append(np.full(n, r["home_doc"] if r["home_doc"] is not None else -1))
                            src_pos.append(np.arange(r["home_first"], r["home_first"] + n))
                        else:
                            s = r["sources"]
                            pos.append(np.array([r["first"] + x["off"] for x in s]))
                            src_doc.append(np.array([-1 if x["doc_id"] is None else x["doc_id"] for x in s]))
                            src_pos.append(np.array([x["pos"] for x in s]))
                    pos, src_doc, src_pos = map(np.concatenate, (pos, src_doc, src_pos))
                    order = np.unique(pos, return_index=True)[1]
                    found = factors(pos[order], src_doc[order], src_pos[order], window)
                kept = words
                if found:
                    edge = np.zeros(len(words) + 1, np.int32)
                    for s, n, _, _ in found:
                        edge[s] += 1
                        edge[s + n] -= 1
                    inside = np.cumsum(edge[:-1]) > 0
                    kept = [x for x, gone in zip(words, inside.tolist(), strict=True) if not gone]
                body = b" ".join(kept)
                row = {
                    "doc_id": doc_id,
                    "n_words": len(words),
                    "n_removed": len(words) - len(kept),
                    "kept_sha256": hashlib.sha256(body).hexdigest(),
                    "n_factors": len(found),
                    "spans": [{"start": s, "words": n, "source_doc": d, "source_start": p} for s, n, d, p in found],
                }
                if keep_text:
                    row["text"] = body.decode("utf-8", "replace")
                rows.append(row)
            out = pd.DataFrame(rows, columns=[x.split(" ")[0] for x in ("doc_id", "n_words", "n_removed", "kept_sha256", "n_factors", "spans")] + ["text"] * keep_text)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, keep_text: bool = False) -> DataFrame:
    """One row per document: words, removed words, hash of what is kept, the factors.

    With ``keep_text`` the kept words, joined by one space, come as ``text``.
    See the module's docstring for method and edge cases.
    """
    if not 1 <= gram <= window:
        raise ValueError("gram must lie between 1 and window")
    text_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    base = base.withColumn("tkey", F.xxhash64(F.coalesce("text", F.lit(""))))
    cut = materialise(base.mapInPandas(_cut(window, gram), PHRASES), "phrases")

    repeated = cut.groupBy("fp").agg(F.count("*").alias("c"), F.max("own").alias("o")).where("c > 1 OR o").select("fp")
    kept = materialise(cut.join(repeated, "fp"), "repeated")
    discard(cut)
    # the index: each different phrase once, with its first occurrence
    index = kept.groupBy("fp", "phrase").agg(
        F.count("*").alias("copies"),
        F.max("own").alias("own"),
        F.min(F.struct("doc_id", "first", "tkey", "n")).alias("home"),
    )
    index = materialise(index, "index")
    # where different phrases meet, or a phrase repeats in itself, look at windows
    mixed = index.groupBy("fp").agg(F.count("*").alias("c")).where("c > 1").select("fp", F.lit(True).alias("mixed"))
    asked = (
        index.join(mixed, "fp", "left")
        .where("mixed OR (own AND copies = 1)")
        .groupBy(F.col("home.doc_id").alias("doc_id"), F.col("home.tkey").alias("tkey"))
        .agg(F.collect_set(F.struct("fp", "phrase", F.col("home.first").alias("first"), F.col("home.n").alias("n"))).alias("wanted"))
    )
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tkey"] == b["tkey"])
    opened = base.join(asked, same(base, asked)).select(base["doc_id"], base["text"], "wanted").mapInPandas(_open(window), OPENED)
    seen = materialise(opened, "windows")
    # a repeated row asks twice for the same phrase, so count places, not rows
    place = F.struct("fp", "phrase", "off")
    source = seen.groupBy("h1", "h2").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.min(F.struct("doc_id", "pos")).alias("src")).where("a <> b")
    sources = materialise(
        seen.join(source, ["h1", "h2"])
        .groupBy("fp", "phrase")
        .agg(F.array_sort(F.collect_set(F.struct("off", F.col("src.doc_id").alias("doc_id"), F.col("src.pos").alias("pos")))).alias("sources")),
        "sources",
    )
    discard(seen)
    del opened, asked, source, seen
    release(docs.sparkSession)
    verdict = index.join(sources, ["fp", "phrase"], "left").where("copies > 1 OR sources IS NOT NULL")
    verdict = verdict.select(
        "fp",
        "phrase",
        F.when(F.col("copies") > 1, F.lit(None)).otherwise(F.col("sources")).alias("sources"),
        F.col("home.doc_id").alias("home_doc"),
        F.col("home.first").alias("home_first"),
    )
    # a set: n equal rows bring every hit n times
    hits = (
        kept.join(verdict, ["fp", "phrase"])
        .groupBy("doc_id", "tkey")
        .agg(F.collect_set(F.struct("first", "n", "sources", "home_doc", "home_first")).alias("hits"))
    )
    joined = base.join(hits, same(base, hits), "left").select(base["doc_id"], base["text"], "hits")
    return joined.mapInPandas(_factor(window, keep_text), RESULT + (", text string" if keep_text else ""))
