"""Language ID with a linear-chain conditional random field (operator 8).

Words are runs of letters.  A word's features are its byte bigrams and
trigrams with word boundaries, its prefix and suffix of three bytes and, if it
is frequent in the training sample, the word itself (lexicon).  Learned
transitions tie neighbouring words, so code-switched text is labelled word by
word; forward-backward gives each word's marginals.  A document's language is
the label with the largest mean marginal over all its words, and that mean is
the score.

The model is fitted on the driver on a bounded sample: per language, up to
``docs_per_lang`` labelled rows (those with the smallest hash), one window
of ``words_per_doc`` words of each, spliced into monolingual and code-switched
sequences.  Prediction reads every whole text.  Feature tables have fixed
sizes, so the broadcast model is a few MB per language.

Forward-backward runs over all words of a block of texts at once: products of
transition matrices within chunks, a scan over the chunks, then both passes in
lockstep; texts are cut apart by their start flags.

Cases: null texts and texts without letters are ``und`` with score 0; with no
labelled rows every text is ``und``.  Ties go to the first label in order.
Repeated rows are documents of their own; an empty table gives an empty
result.  The prediction looks at the text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.scratch import text_batches
from lodestone.llm.wordhash import blocks, mix

UND = "und"
DOCS_PER_LANG = 300
WORDS_PER_DOC = 200
#: below this score keep_known() rejects a text
MIN_SCORE = 0.3
TRI = 1 << 17
AFFIX = 1 << 15
LEXICON = 1 << 15
CHUNK = 64
ASCII_LETTER = re.compile(rb"[A-Za-z]")

# byte classes after lower-casing: letters keep their byte, all else is 0
_LOWER = np.zeros(256, np.uint8)
for _c in range(256):
    if 0x41 <= _c <= 0x5A:
        _LOWER[_c] = _c + 32
    elif 0x61 <= _c <= 0x7A or _c >= 0x80:
        _LOWER[_c] = _c


def letters(data: bytes) -> np.ndarray:
    """UTF-8 -> bytes of lower-cased letters, 0 elsewhere (same length)."""
    raw = np.frombuffer(data, np.uint8)
    b = _LOWER[raw]
    if (raw >= 0x80).any():
        # Latin-1 capitals follow 0xC3; 0xC2 and 0xE2 lead symbols and punctuation, and
        # 0xE2 the scripts of U+2C00-2DFF (Latin Extended-C, part of Latin words, left out)
        after = np.flatnonzero(raw[:-1] == 0xC3) + 1
        x = raw[after]
        b[after] = np.where((x <= 0x9E) & (x != 0x97), x + 0x20, x)
        for lead, n in ((0xC2, 2), (0xE2, 3)):
            at = np.flatnonzero(raw == lead)
            if lead == 0xE2:
                x = raw[np.minimum(at + 1, len(raw) - 1)]
                at = at[(x < 0xB0) | (x > 0xB7) | ((x == 0xB1) & (raw[np.minimum(at + 2, len(raw) - 1)] >= 0xA0))]
            for k in range(n):
                b[np.minimum(at + k, len(b) - 1)] = 0
    return b


@dataclass
class Features:
    """Feature ids of the words of a block."""

    start: np.ndarray  # first byte of each word
    size: np.ndarray  # number of n-gram places of each word (bytes + 1)
    bi: np.ndarray
    tri: np.ndarray
    prefix: np.ndarray
    suffix: np.ndarray
    word: np.ndarray  # 64-bit hash of each word


def featurise(b: np.ndarray) -> Features:
    """b starts and ends with 0."""
    on = b != 0
    edge = np.flatnonzero(on[1:] != on[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    n = end - start
    # places: each byte of a word with its predecessor, then the closing boundary
    size = n + 1
    place = np.repeat(start - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    x = b.astype(np.int64)
    bi = (x[place - 1] << 8) | x[place]
    tri = ((x[np.maximum(place - 2, 0)] * 0x3D4D51CB + x[place - 1]) * 0x2545F491 + x[place]) * 0x9E3779B1 >> 12 & (TRI - 1)
    at = lambda i: np.where((i >= start) & (i < end), x[np.clip(i, 0, len(x) - 1)], 0)
    fold = lambda p, q, r: ((p * 0x3D4D51CB + q) * 0x2545F491 + r) * 0x9E3779B1 >> 12 & (AFFIX - 1)
    prefix = fold(at(start), at(start + 1), at(start + 2))
    suffix = fold(at(end - 1), at(end - 2), at(end - 3))
    code = mix((b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    origin = np.zeros(len(b), np.int64)
    origin[start] = start
    inside = np.arange(len(b)) - np.maximum.accumulate(origin)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(code * (inside.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * on, out=total[1:])
    return Features(start, size, bi, tri, prefix, suffix, mix(total[end] - total[start]))


@dataclass
class Model:
    labels: list[str]
    bi: np.ndarray
    tri: np.ndarray
    prefix: np.ndarray
    suffix: np.ndarray
    lexicon: np.ndarray  # sorted hashes of frequent words
    word: np.ndarray  # weights, row 0 for words outside the lexicon
    move: np.ndarray  # transition scores
    begin: np.ndarray

    def rows(self, f: Features) -> np.ndarray:
        k = np.searchsorted(self.lexicon, f.word)
        k = np.minimum(k, len(self.lexicon) - 1) if len(self.lexicon) else k * 0
        hit = self.lexicon[k] == f.word if len(self.lexicon) else np.zeros(len(k), bool)
        return np.where(hit, k + 1, 0)

    def emissions(self, f: Features) -> np.ndarray:
        grams = self.bi[f.bi] + self.tri[f.tri]
        cut = np.concatenate(([0], np.cumsum(f.size)[:-1]))
        return np.add.reduceat(grams, cut, axis=0) + self.prefix[f.prefix] + self.suffix[f.suffix] + self.word[self.rows(f)]


def forward_backward(score: np.ndarray, first: np.ndarray, move: np.ndarray, begin: np.ndarray):
    """Word marginals (n x labels), and the summed pair marginals (labels x labels).

    score: emission scores; first: True where a sequence begins.
    """
    n, k = score.shape
    rows = -(-n // CHUNK)
    e = np.ones((rows * CHUNK, k))
    e[:n] = np.exp(score - score.max(axis=1, keepdims=True))
    cut = np.zeros(rows * CHUNK, bool)
    cut[:n] = first
    cut[n:] = True  # padding must not reach back
    e, cut = e.reshape(rows, CHUNK, k), cut.reshape(rows, CHUNK)
    a, pi = np.exp(move - move.max()), np.exp(begin - begin.max())
    step = lambda c: np.where(cut[:, c, None, None], pi, a) * e[:, c, None, :]
    prod = np.broadcast_to(np.eye(k), (rows, k, k))
    for c in range(CHUNK):
        prod = prod @ step(c)
        prod = prod / prod.sum(axis=(1, 2), keepdims=True)
    into, out = np.empty((rows, k)), np.empty((rows, k))
    v = np.ones(k) / k
    for r in range(rows):
        into[r] = v
        v = v @ prod[r]
        v = v / v.sum()
    v = np.ones(k) / k
    for r in range(rows - 1, -1, -1):
        out[r] = v
        v = prod[r] @ v
        v = v / v.sum()
    alpha, beta = np.empty_like(e), np.empty_like(e)
    v = into
    for c in range(CHUNK):
        v = np.where(cut[:, c, None], v.sum(axis=1, keepdims=True) * pi, v @ a) * e[:, c]
        v = v / v.sum(axis=1, keepdims=True)
        alpha[:, c] = v
    v = out
    for c in range(CHUNK - 1, -1, -1):
        beta[:, c] = v
        w = e[:, c] * v
        v = np.where(cut[:, c, None], (w @ pi)[:, None], w @ a.T)
        v = v / v.sum(axis=1, keepdims=True)
    alpha, beta, e = (x.reshape(-1, k)[:n] for x in (alpha, beta, e))
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    return gamma, (alpha, beta, e, a)


def _pairs(parts, first: np.ndarray) -> np.ndarray:
    alpha, beta, e, a = parts
    t = np.flatnonzero(~first[1:]) + 1
    left, right = alpha[t - 1], e[t] * beta[t]
    norm = np.einsum("ti,ij,tj->t", left, a, right)
    return a * ((left / norm[:, None]).T @ right)


def train(samples: list[tuple[str, str]], epochs: int = 4, seed: int = 5, rate: float = 0.3, decay: float = 1e-6) -> Model | None:
    """Fit on (text, language) pairs by AdaGrad on the conditional likelihood."""
    samples = sorted(s for s in samples if s[0] and s[1])
    labels = sorted({lang for _, lang in samples})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    words = [(text.encode("utf-8", "surrogatepass").split(), labels.index(lang)) for text, lang in samples]
    # sequences: half of one text each, half spliced from pieces of several
    runs: list[list[tuple[bytes, int]]] = []
    order = rng.permutation(len(words))
    for i in order:
        w, y = words[i]
        for a in range(0, len(w), 40):
            runs.append([(b" ".join(w[a : a + 40]), y)])
    for i in rng.permutation(len(words)):
        w, y = words[i]
        if not w:
            continue
        pieces = []
        for _ in range(int(rng.integers(2, 5))):
            j = int(rng.integers(len(words)))
            v, z = words[j]
            if v:
                a = int(rng.integers(len(v)))
                pieces.append((b" ".join(v[a : a + int(rng.integers(2, 25))]), z))
        a = int(rng.integers(len(w)))
        runs.append([(b" ".join(w[a : a + 25]), y), *pieces])
    count: dict[int, int] = {}
    batches = []
    runs = [runs[i] for i in rng.permutation(len(runs))]
    for lo in range(0, len(runs), 160):
        data, gold, first = [b""], [], []
        for run in runs[lo : lo + 160]:
            fresh = True
            for piece, y in run:
                f = featurise(np.concatenate(([0], letters(piece + b" "), [0])).astype(np.uint8))
                m = len(f.start)
                gold += [y] * m
                first += [fresh] + [False] * (m - 1) if m else []
                fresh = fresh and not m
                data.append(piece)
        f = featurise(np.concatenate(([0], letters(b" ".join(data) + b" "), [0])).astype(np.uint8))
        if not len(f.start):
            continue
        for h in f.word.tolist():
            count[h] = count.get(h, 0) + 1
        batches.append((f, np.array(gold), np.array(first, bool)))
    frequent = sorted(sorted(count, key=lambda h: (-count[h], h))[:LEXICON])
    lexicon = np.array([h for h in frequent if count[h] >= 5], np.uint64)
    k = len(labels)
    zero = lambda n: np.zeros((n, k), np.float32)
    model = Model(labels, zero(1 << 16), zero(TRI), zero(AFFIX), zero(AFFIX), lexicon, zero(len(lexicon) + 1), np.zeros((k, k)), np.zeros(k))
    names = ("bi", "tri", "prefix", "suffix", "word")
    square = {n: np.full_like(getattr(model, n), 1e-2) for n in names} | {"move": np.full((k, k), 1e-2), "begin": np.full(k, 1e-2)}
    for epoch in range(epochs):
        for i in rng.permutation(len(batches)):
            f, gold, first = batches[i]
            gamma, parts = forward_backward(model.emissions(f), first, model.move, model.begin)
            n = len(gold)
            diff = (gamma - np.eye(k)[gold]) / n * 100
            wide = np.repeat(diff, f.size, axis=0)
            ids = {"bi": (f.bi, wide), "tri": (f.tri, wide), "prefix": (f.prefix, diff), "suffix": (f.suffix, diff), "word": (model.rows(f), diff)}
            for name in names:
                key, d = ids[name]
                used, back = np.unique(key, return_inverse=True)
                g = np.stack([np.bincount(back, d[:, c], len(used)) for c in range(k)], axis=1)
                table, sq = getattr(model, name), square[name]
                g += decay * table[used]
                sq[used] += g * g
                table[used] -= rate * g / np.sqrt(sq[used])
            t = np.flatnonzero(~first[1:]) + 1
            seen = np.zeros((k, k))
            np.add.at(seen, (gold[t - 1], gold[t]), 1)
            for name, g in (("move", (_pairs(parts, first) - seen) / n * 100), ("begin", diff[first].sum(axis=0))):
                square[name] += g * g
                setattr(model, name, getattr(model, name) - rate * g / np.sqrt(square[name]))
    model.word[0] = 0
    return model


def predict(model: Model, texts: list[bytes]) -> np.ndarray:
    """Mean word marginals of each text (rows of 0 where it has no words)."""
    out = np.zeros((len(texts), len(model.labels)))
    data = np.concatenate(([0], letters(b" ".join(texts) + b" "), [0])).astype(np.uint8)
    f = featurise(data)
    if not len(f.start):
        return out
    begin = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])[:-1])) + 1
    owner = np.searchsorted(begin, f.start, side="right") - 1
    first = np.concatenate(([True], owner[1:] != owner[:-1]))
    gamma, _ = forward_backward(model.emissions(f).astype(np.float64), first, model.move, model.begin)
    cut = np.flatnonzero(first)
    out[owner[cut]] = np.add.reduceat(gamma, cut, axis=0) / np.diff(np.append(cut, len(owner)))[:, None]
    return out


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, words_per_doc: int = WORDS_PER_DOC) -> Model | None:
    """Fit on a bounded sample of the labelled documents outside the held-out fold."""
    open_ = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    order = F.md5(F.col("doc_id").cast("string"))
    open_ = open_.select("doc_id", "lang", "text", order.alias("_o"), F.xxhash64("text").alias("_t"))
    first = W.partitionBy("lang").orderBy("_o", "doc_id", "_t")
    ids = open_.select("doc_id", "lang", "_o", "_t").withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= docs_per_lang)
    ids = ids.select("doc_id", "lang", "_t").distinct()  # at most docs_per_lang rows a language
    words = F.split(F.trim(F.col("text")), r"[\x20\x09-\x0D]+")
    picked = open_.join(F.broadcast(ids), ["doc_id", "lang", "_t"]).select("lang", "doc_id", "_o", "_t", words.alias("w"), F.conv(F.substring("_o", 1, 7), 16, 10).cast("int").alias("h"))
    span = F.greatest(F.size("w") - words_per_doc + 1, F.lit(1))
    picked = picked.select("lang", "doc_id", "_o", "_t", F.array_join(F.slice("w", (F.col("h") % span) + 1, words_per_doc), " ").alias("t"))
    # rows repeat: the bound holds for rows, not ids
    rows = picked.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= docs_per_lang).select("lang", "t").collect()
    return train([(r["t"], r["lang"]) for r in rows])


def has_letter(text: bytes) -> bool:
    """Whether a text holds a letter of any script."""
    return bool(ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def scores(model: Model | None, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Mean marginals of each text, and whether it can be labelled at all."""
    if not model:
        return np.zeros((len(texts), 1)), np.zeros(len(texts), bool)
    mean = predict(model, texts)
    # letters that no feature covers leave every label equal
    mean[mean.max(axis=1) == 0] = 1 / len(model.labels)
    return mean, np.array([has_letter(t) for t in texts], bool)


def _predict(handle, full: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = handle.value
        for pdf in frames:
            for at, texts in blocks(pdf["text"], 1 << 18):
                rest = pdf.drop(columns="text").iloc[at : at + len(texts)]
                mean, known = scores(model, texts)
                best, top = mean.argmax(axis=1), mean.max(axis=1)
                names = np.array(model.labels if model else [UND], dtype=object)
                out = rest.assign(lang_pred=np.where(known, names[best], UND), score=np.where(known, np.minimum(top, 1.0), 0.0))
                if full:
                    out["shares"] = [dict(zip(names.tolist(), m.tolist(), strict=True)) if k else {} for k, m in zip(known, mean, strict=True)]
                yield out

    return run


def identify(docs: DataFrame, model: Model | None, shares: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; with `shares` the mean marginals of all labels."""
    text_batches(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double" + (", shares map<string,double>" if shares else "")
    return base.mapInPandas(_predict(handle, shares), schema)


def keep_known(docs: DataFrame, model: Model | None, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of `docs` whose language is known with `min_score` at least."""
    text_batches(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def run(frames):
        for pdf in frames:
            keep = np.zeros(len(pdf), bool)
            text = pdf.iloc[:, schema.names.index("text")]
            for at, texts in blocks(text, 1 << 18):
                mean, known = scores(model, texts)
                keep[at : at + len(texts)] = known & (mean.max(axis=1) >= min_score)
            yield pdf[keep]

    return docs.mapInPandas(run, schema)
