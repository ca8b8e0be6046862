"""Token ids in binary shards with a minimal perfect hash index.

A shard holds the ids of consecutive documents as one raw little-endian payload
(two bytes an id if the vocabulary allows, else four), then a footer: the token
offset of every document, the document keys, and an index. The index is a minimal
perfect hash over the shard's distinct keys: a cascade of bit arrays in which a key
owns the first slot that it alone hashes to, with running popcounts for the rank.
For each rank the index stores a 32-bit fingerprint of the key and the number of
its first document, so a key is found, or refused, in constant time without a
search and without reading the payload.

Scale. Texts are range-partitioned by key and sorted once; every task encodes and
streams one shard to shared storage, under a name of its own until it is whole.
Global starts are prefix sums over the manifest, which has a row for each shard.
Words repeat, so each worker keeps a bounded cache from words to ids. Latin texts are
cut into words as the pre-tokenizer cuts them; all other texts, and those with an added
token in them, go to the library whole.
"""

from __future__ import annotations

import json
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineloom.storage import cut, new_path

MAGIC, LEVELS, LOAD, CACHE, END, LONG = b"LLTOK01\n", 24, 2, 700_000, 2, 1 << 20
_tokenizers: dict[tuple[str, bool], Encoder] = {}


def _range(category: str) -> str:
    """The Latin characters of a Unicode category, as the inside of a regex class; all libraries agree on them."""
    return "".join(f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == category)


_LATIN = re.compile("[\x00-\u024f]*")
_L, _N, _S = _range("L"), _range("N"), r"\t-\r \x85\xa0"
#: Fixed value: how the pre-tokenizer cuts texts, written for Latin ones.
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
#: A place that every cut passes: a single space before a letter.
_SAFE = re.compile(rf"(?<=[{_L}])(?= [{_L}])")


class Encoder:
    """Byte-level BPE of the tokenizers library with a bounded cache from the words of texts to ids.

    With ``plain`` a special token that stands in a text is plain text; else it gets
    its own id, as in the library's default call.
    """

    def __init__(self, path: str, plain: bool = True):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        added = [t.content for t in self.library.get_added_tokens_decoder().values() if not (plain and t.special)]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None  # texts with one are not cut
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        spec = json.loads(self.library.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.known: dict[str, bytes] = {}
        line = self.library.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None

    def _raw(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 1024):
            out += [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.library.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False)]
        return out

    def _learn(self, new: list[str]) -> None:
        """Adds the ids of words. Line feeds between words are words of their own, so many words are one call."""
        rest = new
        if self.line is not None:
            rest = [w for w in new if w.isspace()]
            words = [w for w in new if not w.isspace()]
            for at in range(0, len(words), 1024):
                part = words[at : at + 1024]
                ids = np.array(self.library.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, f"<u{self.width}")
                raw, ends = ids.tobytes(), (np.flatnonzero(ids == self.line) * self.width).tolist()
                if len(ends) != len(part) - 1:
                    raise ValueError("the tokenizer merges words over line feeds")
                self.known.update(zip(part, [raw[a:b] for a, b in zip([0, *[e + self.width for e in ends]], [*ends, len(raw)], strict=True)], strict=True))
        self.known.update(zip(rest, self._raw(rest), strict=True))

    def _parts(self, text: str) -> Iterator[str]:
        """The text in parts of about ``LONG`` characters, cut where the pre-tokenizer cuts too."""
        at = 0
        while len(text) - at > 2 * LONG and (safe := _SAFE.search(text, at + LONG)):
            yield text[at : safe.start()]
            at = safe.start()
        yield text[at:] if at else text

    def _trim(self) -> None:
        """Makes room: long words go first, as they are the rare ones."""
        for most in (9, 6, 0):
            if len(self.known) > CACHE // 2:
                for w in [w for w in self.known if len(w) > most]:
                    del self.known[w]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as raw bytes of this encoder's width."""
        cut = [self.cuts and not (self.added and self.added.search(t)) and _LATIN.fullmatch(t) is not None for t in texts]
        whole = iter(self._raw([t for t, c in zip(texts, cut, strict=True) if not c]))
        out: list[list[bytes]] = [[] if c else [next(whole)] for c in cut]
        known, pending, size = self.known, [], 0

        def flush() -> None:
            words = list(chain.from_iterable(w for _, w in pending))
            ids = list(map(known.get, words))
            if unknown := [at for at, x in enumerate(ids) if x is None]:
                self._learn(list({words[at] for at in unknown}))
                for at in unknown:
                    ids[at] = known[words[at]]
            at = 0
            for k, w in pending:
                out[k].append(b"".join(ids[at : at + len(w)]))
                at += len(w)
            pending.clear()
            if len(known) > CACHE:
                self._trim()

        for k, text in enumerate(texts):
            for part in self._parts(text) if cut[k] else ():
                pending.append((k, _WORDS.findall(part)))
                size += len(part)
                if size > LONG:
                    flush()
                    size = 0
        flush()
        return [parts[0] if len(parts) == 1 else b"".join(parts) for parts in out]


def encoder(path: str, plain: bool = True) -> Encoder:
    if (path, plain) not in _tokenizers:
        _tokenizers[path, plain] = Encoder(path, plain)
    return _tokenizers[path, plain]


def _mix(keys: np.ndarray, salt: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Ranks 0..n-1 of n distinct 64-bit keys; unknown keys are told by their fingerprints."""

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        keys, sizes, parts = keys.astype(np.uint64), [], []
        for level in range(LEVELS):
            if not len(keys):
                break
            size = -(-max(64, LOAD * len(keys)) // 64) * 64
            at = (_mix(keys, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, "<u8"), np.sort(keys))

    def rank(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = (_mix(keys[open_], level) % np.uint64(size)).astype(np.int64) + self.base[level]
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = (self.ranks[at >> 6] + below)[hit]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.searchsorted(self.rest, keys[open_])
            out[open_] = np.where(at < len(self.rest), self.ranks[-1] + at, -1)
        return out


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 1000) >> np.uint64(32)).astype("<u4")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_shard(batches: Iterator[pa.RecordBatch], folder: str, number: int, tokenizer: str, end_id: int, plain: bool = True) -> pa.RecordBatch | None:
    """Streams one shard; rows (id, text) come in ascending order of id, nulls first."""
    enc = encoder(tokenizer, plain)
    store, home = _open(folder)
    lengths, keys, nulls, out = [], [], 0, None
    final, own = f"{home}/shard-{number:06d}.tok", f"{home}/.{uuid.uuid4().hex}.part"
    stop = np.array([end_id], f"<u{enc.width}").tobytes()
    for batch in batches:
        if not batch.num_rows:
            continue
        if out is None:
            store.create_dir(home, recursive=True)
            out = store.open_output_stream(own)
        nulls += batch.column(0).null_count
        keys.append(batch.column(0).fill_null(0).to_numpy())
        for at in range(0, batch.num_rows, 128):
            raw = enc.encode([t or "" for t in batch.column(1).slice(at, 128).to_pylist()])
            lengths.append(np.fromiter((len(r) // enc.width + 1 for r in raw), np.int64, len(raw)))
            out.write(b"".join([x for r in raw for x in (r, stop)]))
    if out is None:
        return None
    key, length = np.concatenate(keys), np.concatenate(lengths)
    distinct, first = np.unique(key[nulls:], return_index=True)
    mph = PerfectHash.build(distinct.view(np.uint64))
    rank = mph.rank(distinct.view(np.uint64))
    prints, docs = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    prints[rank], docs[rank] = _fingerprints(distinct.view(np.uint64)), first + nulls
    parts = {"offsets": np.concatenate([[0], np.cumsum(length)]).astype("<i8"), "keys": key.astype("<i8"), "bits": mph.bits, "rest": mph.rest.astype("<u8"), "prints": prints, "docs": docs}
    at, where = int(length.sum()) * enc.width, {}
    for name, part in parts.items():
        where[name] = [at, part.dtype.str, len(part)]
        out.write(part.tobytes())
        at += part.nbytes
    head = json.dumps({"width": enc.width, "nulls": nulls, "levels": mph.sizes, "parts": where}).encode()
    out.write(head + np.array([len(head)], "<i8").tobytes() + MAGIC)
    out.close()
    store.move(own, final)
    row = {"shard": number, "file": f"{folder}/shard-{number:06d}.tok", "n_docs": len(key), "n_tokens": int(length.sum()), "first_id": int(key[nulls]) if nulls < len(key) else None, "last_id": int(key[-1]) if nulls < len(key) else None}
    return pa.RecordBatch.from_pylist([row], schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64())]))


class Shard:
    """Reads one shard: ids by key or by document number."""

    def __init__(self, path: str):
        store, at = _open(path)
        self.file = store.open_input_file(at)
        size = self.file.size()
        if self.file.read_at(8, size - 8) != MAGIC:
            raise ValueError(f"{path} is not a whole shard")
        n = int(np.frombuffer(self.file.read_at(8, size - 16), "<i8")[0])
        head = json.loads(self.file.read_at(n, size - 16 - n))
        part = {k: np.frombuffer(self.file.read_at(np.dtype(kind).itemsize * m, a), kind) for k, (a, kind, m) in head["parts"].items()}
        self.width, self.nulls = head["width"], head["nulls"]
        self.offsets, self.keys, self.prints, self.docs = part["offsets"], part["keys"], part["prints"], part["docs"]
        self.mph = PerfectHash(head["levels"], part["bits"], part["rest"])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of the first document of each key, -1 for unknown keys."""
        k = np.asarray(keys, np.int64).view(np.uint64)
        rank = self.mph.rank(k)
        known = (rank >= 0) & (rank < len(self.docs))
        known[known] = self.prints[rank[known]] == _fingerprints(k[known])
        out = np.full(len(k), -1, np.int64)
        out[known] = self.docs[rank[known]]
        return out

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of documents ``first`` up to ``last``, not included."""
        a, b = int(self.offsets[first]), int(self.offsets[last])
        return np.frombuffer(self.file.read_at((b - a) * self.width, a * self.width), f"<u{self.width}")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END, id_col: str = "doc_id", text_col: str = "text", plain: bool = True) -> DataFrame:
    """Writes shards in ascending order of id and returns the manifest, with each shard's ``start``.

    Null ids come first and have no index entry; a null text is empty; repeated ids
    stand next to each other, ordered by text. An empty table writes no shard.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = narrow.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = write_shard(batches, folder, TaskContext.get().partitionId(), tokenizer, end_id, plain)
        if row is not None:
            yield row

    shards = cut(ordered.mapInArrow(run, "shard int, file string, n_docs long, n_tokens long, first_id long, last_id long"), "manifest")
    start, rows = 0, []
    for r in sorted(shards.collect(), key=lambda r: r.shard):  # a row for each shard
        rows.append((*r, start))
        start += r.n_tokens
    return docs.sparkSession.createDataFrame(rows, "shard int, file string, n_docs long, n_tokens long, first_id long, last_id long, start long")


def read_tokens(spark: SparkSession, manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document, read back through the shards' indexes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(file)
                n, offsets = len(shard.keys), shard.offsets
                same = np.concatenate([np.zeros(shard.nulls, bool), [False] * (n > shard.nulls), shard.keys[shard.nulls + 1 :] == shard.keys[shard.nulls : -1] if n > shard.nulls else []]).astype(bool)
                group = np.maximum.accumulate(np.where(same, 0, np.arange(n)))  # repeated keys follow their first document
                at = shard.find(shard.keys)
                at[: shard.nulls] = np.arange(shard.nulls)
                if (at != group).any():
                    raise ValueError(f"{file}: the index misses a key")
                at += np.arange(n) - group
                for a in range(0, n, 2048):
                    b = min(n, a + 2048)
                    ids = shard.ids(a, b).astype("<u4")
                    lo, hi = offsets[at[a:b]], offsets[at[a:b] + 1]
                    sums = [zlib.crc32(ids[x:y]) for x, y in zip((lo - offsets[a]).tolist(), (hi - offsets[a]).tolist(), strict=True)]
                    key = pa.array(shard.keys[a:b], mask=np.arange(a, b) < shard.nulls)
                    yield pa.RecordBatch.from_arrays([key, pa.array(start + lo), pa.array(hi - lo), pa.array(sums, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    n = max(1, min(manifest.count(), 4096))
    rows = manifest.select("file", "start").repartition(n).mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")
    return rows.select(F.col("id").alias(id_col), "start", "n_tokens", "ids_crc32")


def tokens_round_trip(docs: DataFrame, tokenizer: str, end_id: int = END, id_col: str = "doc_id", text_col: str = "text", plain: bool = True) -> DataFrame:
    """Writes the shards of ``docs`` to shared storage and reads them back."""
    spark = docs.sparkSession
    return read_tokens(spark, write_tokens(docs, new_path(spark, "tokens"), tokenizer, end_id, id_col, text_col, plain), id_col)
