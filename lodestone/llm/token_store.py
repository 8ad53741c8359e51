"""Token-ID binary output with random access (operator 4).

Documents are range-partitioned by doc_id, repeated and null ones further by a
hash of their text, into shards of about SHARD_BYTES of text (more of them
where the session has more partitions), and each becomes one file: independent zstandard frames holding whole documents' ids (little
endian, 2 bytes where the vocabulary allows, else 4), then a skippable frame
with the document index, then a seek table in the layout of the public
zstandard seekable format: per frame its compressed size, its content size
and a checksum (low 32 bits of XXH64 of the content).  A reader fetches the
tail, then only the frames that hold the documents asked for.

Files are written under a private name and moved into place, under a name
that depends on the partition alone, so that a retried or speculative task
leaves the same file.  The manifest is one row per shard.

Cases: null text is the empty text (the end id alone).  Repeated rows are
documents of their own, in the order of their texts' hashes within a doc_id;
null doc_ids come first.  An empty table gives no shards and an empty result.  Other columns
are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import new_path, parallelism, text_batches

#: content bytes after which a frame is closed; a longer document is a frame of its own
FRAME_BYTES = 1 << 16
LEVEL = 3
#: bytes of text in a shard, about: bounds a writer's index and a file whatever the corpus
SHARD_BYTES = 256 << 20
#: documents in one batch that a reader hands on
READ_ROWS = 20_000
END_ID = 1
#: words that a worker remembers; beyond, it forgets all but the first quarter
CACHE_WORDS = 1_000_000
SEEK_MAGIC = 0x8F92EAB1
SKIP_SEEK = 0x184D2A5E
SKIP_INDEX = 0x184D2A50


class Encoder:
    """Ids of whole texts, remembering the ids of words.

    The tokenizer lower-cases and splits before byte-pair merging and never
    merges over white space, so a text's ids are its words' ids in turn.
    Texts of plain Latin letters are split here by the tokenizer's own pattern
    and only pieces not met before reach it; any other text goes to it whole.
    """

    #: the file's pattern, and what it means for the characters let through below
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]+|_+)+")
    ODD = re.compile("[^\t-\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.fast = self._plain(spec)
        self.known: dict[str, bytes] = {}
        if self.fast:
            self.special = [t["content"] for t in spec["added_tokens"]]
            level = spec["pre_tokenizer"]["pretokenizers"][1]
            spec |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, level]}, "added_tokens": []}
            self.pieces = Tokenizer.from_str(json.dumps(spec))
            # every piece ends in a token that carries the end-of-word suffix
            suffix = spec["model"]["end_of_word_suffix"]
            self.last = np.zeros(self.whole.get_vocab_size(), bool)
            self.last[[i for w, i in spec["model"]["vocab"].items() if w.endswith(suffix)]] = True

    @classmethod
    def _plain(cls, spec: dict) -> bool:
        """Whether the split here means what the file says."""
        norm = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if norm != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in pre] != ["Split", "ByteLevel"]:
            return False
        if spec["model"]["type"] != "BPE" or not spec["model"].get("end_of_word_suffix"):
            return False
        return pre[0]["pattern"] == {"Regex": cls.PATTERN} and pre[0]["behavior"] == "Removed" and pre[0]["invert"] and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of white-space separated, lower-cased words."""
        find, known = self.PIECE.findall, self.known
        split = [find(w) for w in words]
        new = list(set().union(*split).difference(known))
        for lo in range(0, len(new), 2_000):
            part = new[lo : lo + 2_000]
            e = self.pieces.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(e.ids, dtype=self.kind)
            edge = np.concatenate(([0], np.flatnonzero(self.last[ids]) + 1))
            if len(edge) != len(part) + 1:
                raise ValueError("a piece without an end-of-word token")
            edge = (edge * self.kind.itemsize).tolist()
            raw = ids.tobytes()
            known.update(zip(part, [raw[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)], strict=True))
        known.update((w, b"".join(map(known.__getitem__, p))) for w, p in zip(words, split, strict=True) if len(p) != 1)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes, without the end id."""
        out: list = [None] * len(texts)
        split: dict[int, list[str]] = {}
        for i, t in enumerate(texts):
            if not self.fast or self.ODD.search(t) or any(s in t for s in self.special):
                ids = self.whole.encode(t, add_special_tokens=False).ids
                out[i] = np.array(ids, dtype=self.kind).tobytes()
            else:
                split[i] = t.lower().split()
        words = set().union(*split.values())
        new = words.difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            # the words learned first are the frequent ones
            self.known = dict(islice(self.known.items(), CACHE_WORDS // 4))
            new = words.difference(self.known)
        if new:
            self._learn(list(new))
        get = self.known.__getitem__
        for i, w in split.items():
            out[i] = b"".join(map(get, w))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def filesystem(uri: str):
    """(pyarrow file system, path) for a URI or a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class ShardWriter:
    """Writes one shard file; use as: add() per document, then close()."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import xxhash
        import zstandard

        self.stream, self.frame_bytes = stream, frame_bytes
        self.zstd, self.sum = zstandard.ZstdCompressor(level=level, write_checksum=False), xxhash.xxh64_intdigest
        self.held: list[bytes] = []
        self.size = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int]] = []

    def add(self, ids: bytes) -> None:
        if self.held and self.size + len(ids) > self.frame_bytes:
            self._flush()
        self.docs.append((len(self.frames), len(ids)))
        self.held.append(ids)
        self.size += len(ids)

    def _flush(self) -> None:
        body = b"".join(self.held)
        packed = self.zstd.compress(body)
        self.stream.write(packed)
        self.frames.append((len(packed), len(body), self.sum(body) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def close(self, doc_ids: list[int | None], width: int) -> None:
        if self.held:
            self._flush()
        n = len(self.docs)
        ids = np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes()
        null = np.array([d is None for d in doc_ids], dtype="u1").tobytes()
        frame = np.array([f for f, _ in self.docs], dtype="<u4").tobytes()
        size = np.array([s for _, s in self.docs], dtype="<u4").tobytes()
        index = self.zstd.compress(struct.pack("<IB", n, width) + ids + null + frame + size)
        self.stream.write(struct.pack("<II", SKIP_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0x80, SEEK_MAGIC)
        self.stream.write(struct.pack("<II", SKIP_SEEK, len(table) + len(foot)) + table + foot)


class ShardReader:
    """Reads documents of one shard file; decompresses only the frames asked for."""

    def __init__(self, stream, size: int):
        import xxhash
        import zstandard

        self.stream, self.zstd, self.sum = stream, zstandard.ZstdDecompressor(), xxhash.xxh64_intdigest
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or flags != 0x80:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.size, self.check = table.T if frames else np.zeros((3, 0), np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.packed)))
        end = int(self.start[-1])
        magic, length = struct.unpack("<II", self._at(end, 8))
        if magic != SKIP_INDEX:
            raise ValueError("no document index after the frames")
        index = self.zstd.decompress(self._at(end + 8, length))
        n, self.width = struct.unpack_from("<IB", index)
        self.doc_ids = np.frombuffer(index, "<i8", n, 5)
        self.null = np.frombuffer(index, "u1", n, 5 + 8 * n)
        self.frame = np.frombuffer(index, "<u4", n, 5 + 9 * n)
        self.bytes = np.frombuffer(index, "<u4", n, 5 + 13 * n).astype(np.int64)
        total = np.concatenate(([0], np.cumsum(self.bytes)))[:-1] if n else np.zeros(0, np.int64)
        self.offset = total - np.concatenate(([0], np.cumsum(self.size)))[:-1][self.frame] if n else total
        self.at, self.body = -1, b""

    def _at(self, offset: int, n: int) -> bytes:
        self.stream.seek(offset)
        return self.stream.read(n)

    def ids(self, k: int) -> np.ndarray:
        """Token ids of the k-th document, as unsigned 32-bit integers."""
        f = int(self.frame[k])
        if f != self.at:
            body = self.zstd.decompress(self._at(int(self.start[f]), int(self.packed[f])), max_output_size=max(1, int(self.size[f])))
            if self.sum(body) & 0xFFFFFFFF != self.check[f]:
                raise ValueError(f"frame {f}: checksum mismatch")
            self.at, self.body = f, body
        a = int(self.offset[k])
        return np.frombuffer(self.body, f"<u{self.width}", int(self.bytes[k]) // self.width, a).astype("<u4")


MANIFEST = "shard int, path string, n_docs long, n_tokens long"


def _write(root: str, tokenizer: str, end_id: int, frame_bytes: int, level: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        gc.disable()  # millions of remembered strings and no cycles
        enc = encoder(tokenizer)
        tail = np.array([end_id], dtype=enc.kind).tobytes()
        fs = stream = writer = None
        doc_ids: list[int | None] = []
        total = 0
        name, mine = f"shard-{shard:06d}.tok", f".{uuid.uuid4().hex}"
        for pdf in frames:
            for d, t in _blocks(pdf):
                if writer is None:
                    fs, base = filesystem(root)
                    fs.create_dir(base, recursive=True)
                    stream = fs.open_output_stream(f"{base}/{mine}")
                    writer = ShardWriter(stream, frame_bytes, level)
                for ids in enc(t):
                    writer.add(ids + tail)
                    total += len(ids) // enc.kind.itemsize + 1
                doc_ids += d
        if writer is not None:
            writer.close(doc_ids, enc.kind.itemsize)
            stream.close()
            fs.move(f"{base}/{mine}", f"{base}/{name}")
            yield pd.DataFrame({"shard": [shard], "path": [f"{root}/{name}"], "n_docs": [len(doc_ids)], "n_tokens": [total]})

    return run


def _blocks(pdf: pd.DataFrame, limit: int = 1 << 19) -> Iterator[tuple[list, list[str]]]:
    ids, texts, size = [], [], 0
    for d, t in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
        ids.append(None if d is None or d is pd.NA or d != d else int(d))
        texts.append(t if isinstance(t, str) else "")
        size += len(texts[-1])
        if size > limit:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write_tokens(docs: DataFrame, root: str, tokenizer: str, end_id: int = END_ID, frame_bytes: int = FRAME_BYTES, level: int = LEVEL, shard_bytes: int = SHARD_BYTES) -> list[dict]:
    """Write the shards below `root`; returns the manifest, in doc_id order, one entry per shard.

    Each entry has the number of ids before the shard as `start`.
    """
    spark = docs.sparkSession
    text_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(parallelism(spark), -(-size // shard_bytes))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = base.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    found = sorted(dealt.mapInPandas(_write(root, tokenizer, end_id, frame_bytes, level), MANIFEST).collect(), key=lambda r: r["shard"])
    out, start = [], 0
    for r in found:
        out.append(r.asDict() | {"start": start})
        start += r["n_tokens"]
    return out


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for path, start in zip(pdf["path"], pdf["start"], strict=True):
            fs, name = filesystem(path)
            with fs.open_input_file(name) as f:
                r = ShardReader(f, f.size())
                for lo in range(0, len(r.doc_ids), READ_ROWS):
                    every = range(lo, min(lo + READ_ROWS, len(r.doc_ids)))
                    ids = map(r.ids, every)
                    n, crc = (np.array(x, np.int64) for x in zip(*[(len(i), zlib.crc32(i.tobytes())) for i in ids], strict=True))
                    doc = pd.array(r.doc_ids[lo : lo + len(n)], dtype="Int64")
                    doc[r.null[lo : lo + len(n)].astype(bool)] = pd.NA
                    yield pd.DataFrame({"doc_id": doc, "start": start + np.cumsum(n) - n, "n_tokens": n, "ids_crc32": crc})
                    start += int(n.sum())


def read_digest(spark, manifest: list[dict]) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    if not manifest:
        return spark.createDataFrame([], READ)
    rows = [(m["shard"], m["path"], m["start"]) for m in manifest]
    shards = spark.createDataFrame(rows, "shard int, path string, start long").repartition(len(rows))
    return shards.mapInPandas(_read, READ)


def token_store(docs: DataFrame, tokenizer: str, root: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write all documents' ids, read the files back, one row per document."""
    spark = docs.sparkSession
    root = root or new_path(spark, "tokens")
    return read_digest(spark, write_tokens(docs, root, tokenizer, end_id))
