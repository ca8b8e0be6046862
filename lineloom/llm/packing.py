"""Packing documents into windows by non-negative least squares.

Documents become token ids. Whole windows of long documents are sequences of their
own; what remains of each document is shorter than a window. Shallow combinations of
lengths that fill a window exactly (pairs, triples, one length several times with
another) are the columns of a matrix, the histogram of lengths is its right side. Non-
negative least squares says how often each combination is used; the counts are rounded
within what there is, and the residuals are packed greedily, largest first, with one
document cut where nothing fits. The last tokens of all go to sequences whose sizes are
powers of two, which need no padding, so none is left.

Scale. The plan sees the histogram alone, one number for each length below the window,
and its size is bounded by the window, not by the table: equal lengths are interchange-
able, so a line of the plan says which ranks of a length go where. Ids are written once.
Ranks are prefix sums over blocks of rows, so a length that a third of all documents
share is ranked by many tasks; documents look up their lines, and only they move again.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right, insort
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.storage import cut

WINDOW, END, ROWS, LANES = 2048, 1, 8192, 64
#: Triples of lengths that are tried, sweeps of the solver, cached parts of words, bytes encoded at once.
TRIPLES, SWEEPS, CACHE, BLOCK = 8192, 40, 600_000, 4 << 20

_encoders: dict[str, Encoder] = {}
#: Letters after lower-casing, words that can be cut here, and what the file cuts from the letters around it. NFC leaves
#: all these characters alone; ``<`` is left out, as added tokens begin with it.
_LETTERS = "a-zß-öø-ÿœ"
_PLAIN = "^[!-;=-~À-ÖØ-öø-ÿŒœ¡«»¿–—‘’“”…]*$"
_CUT = f"'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^{_LETTERS}0-9]+"


def _joined(raw: pa.Array, ends: np.ndarray) -> pa.Array:
    """The entries of ``raw`` in runs, joined; a run is from one of ``ends`` up to the next."""
    _, offsets, data = raw.buffers()
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(np.frombuffer(offsets, np.int64)[ends]), data])


class Encoder:
    """Ids of a tokenizers file as raw unsigned integers, with a bounded cache from words and parts of words to ids.

    Texts are cut at ASCII white space where the file's own rules drop white space and
    never look across it, and each distinct word of a call is looked at once. Words of
    Latin letters are lower-cased and cut into parts as the file cuts them; only parts
    that are new go to the library's model, many in a call. Other new words go to the
    library as they are, and texts of any other file go whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        spec = json.loads(self.library.to_str())
        normal = [(s["type"], s.get("pattern"), s.get("content")) for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = [(s["type"], s.get("behavior"), s.get("invert"), s.get("use_regex"), s.get("add_prefix_space")) for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        patterns = [s.get("pattern", {}).get("Regex", "") for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        #: The rules under which white space separates and is dropped.
        known = [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)]
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        added = spec.get("added_tokens", [])
        self.cuts = normal == known and pre == [("Split", "Removed", True, None, None), ("ByteLevel", None, None, False, False)] and patterns[0] == pattern
        self.cuts = self.cuts and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in added)
        self.cuts = self.cuts and all(t["content"].startswith("<") for t in added)
        #: A part's last id is known by its suffix, so every byte must have ids with and without one.
        suffix, vocab = spec["model"].get("end_of_word_suffix"), spec["model"].get("vocab")
        self.cuts = self.cuts and bool(suffix) and all(c in vocab and c + suffix in vocab for c in pre_tokenizers.ByteLevel.alphabet())
        if self.cuts:
            self.last = np.zeros(self.library.get_vocab_size(), bool)
            self.last[[k for t, k in vocab.items() if t.endswith(suffix)]] = True
            self.model = Tokenizer(self.library.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {"": b""}  # a word that isn't plain is no plain word's part

    def _raw(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 1024):
            out += [np.array(e.ids, f"<u{self.width}").tobytes() for e in self.library.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False)]
        return out

    def _parts(self, parts: list[str]) -> list[bytes]:
        """The ids of parts of words, many in a call."""
        out = []
        for at in range(0, len(parts), 1024):
            some = parts[at : at + 1024]
            ids = np.array(self.model.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, f"<u{self.width}")
            raw, ends = ids.tobytes(), ((np.flatnonzero(self.last[ids]) + 1) * self.width).tolist()
            if len(ends) != len(some):
                raise ValueError("the tokenizer ends a part of a word without its suffix")
            out += [raw[a:b] for a, b in pairwise([0, *ends])]
        return out

    def _trim(self) -> None:
        """Makes room: long keys go first, as they are the rare ones."""
        for most in (9, 6, 0):
            if len(self.known) > CACHE // 2:
                for w in [w for w in self.known if len(w) > most]:
                    del self.known[w]

    def _look_up(self, keys: list[str], ask: Callable[[list[str]], list[bytes]]) -> pa.Array:
        """The ids of distinct words or parts; those of new ones are asked for."""
        ids = list(map(self.known.get, keys))
        if None in ids:
            new = [w for w, x in zip(keys, ids, strict=True) if x is None]
            self.known.update(zip(new, ask(new), strict=True))
            ids = list(map(self.known.__getitem__, keys))
            for w in new:
                if len(w) > 64:
                    self.known.pop(w)
        return pa.array(ids, pa.large_binary())

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words."""
        plain = pc.match_substring_regex(words, _PLAIN)
        parts = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(words.filter(plain)), _CUT, r" \0 "))
        coded = parts.flatten().dictionary_encode()
        ids = self._look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist(), self._parts)
        ids = _joined(ids.take(coded.indices), parts.offsets.to_numpy())
        plain = plain.to_numpy(zero_copy_only=False)
        if plain.all():
            return ids
        rest = self._look_up(words.filter(pa.array(~plain)).to_pylist(), self._raw)
        place = np.where(plain, np.cumsum(plain), len(ids) + np.cumsum(~plain)) - 1
        return pa.concat_arrays([ids, rest]).take(pa.array(place))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text as bytes of this encoder's width."""
        if not self.cuts or not texts:
            return self._raw([t.decode() for t in texts])
        if len(self.known) > CACHE:
            self._trim()
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        return _joined(self._words(coded.dictionary).take(coded.indices), words.offsets.to_numpy()).to_pylist()


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def combinations(hist: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """``(lengths, times)``, three columns each, of shallow combinations that fill a window; unused places have length 0."""
    there = np.flatnonzero(hist[:window])
    has = np.zeros(window + 1, bool)
    has[there] = True
    rows: list[tuple[int, int, int, int, int, int]] = []
    for a in there.tolist():
        for m in range(1, window // a + 1):
            b = window - m * a
            if b == 0 or (has[b] and not (m == 1 and b > a) and b != a):
                rows.append((a, b, 0, m, int(b > 0), 0))
    a, b = (x.ravel() for x in np.meshgrid(there, there, indexing="ij"))
    c = window - a - b
    fits = (a > b) & (b > c) & (c > 0)
    a, b, c = a[fits], b[fits], c[fits]
    some = has[c]
    a, b, c = a[some], b[some], c[some]
    if len(a) > TRIPLES:  # those of the most frequent lengths
        best = np.argsort(-np.minimum(np.minimum(hist[a], hist[b]), hist[c]), kind="stable")[:TRIPLES]
        a, b, c = a[best], b[best], c[best]
    rows += [(x, y, z, 1, 1, 1) for x, y, z in zip(a.tolist(), b.tolist(), c.tolist(), strict=True)]
    table = np.array(rows, np.int64).reshape(-1, 6)
    return table[:, :3], table[:, 3:]


def solve(lengths: np.ndarray, times: np.ndarray, hist: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Non-negative least squares by coordinate descent: how often each combination is used."""
    rest, x = hist.astype(float).tolist(), [0.0] * len(lengths)
    columns = [([(n, m) for n, m in zip(ls, ms, strict=True) if m], 1.0 / sum(m * m for m in ms)) for ls, ms in zip(lengths.tolist(), times.tolist(), strict=True)]
    for _ in range(sweeps):
        moved = 0.0
        for j, (column, scale) in enumerate(columns):
            step = max(-x[j], sum(rest[n] * m for n, m in column) * scale)
            if step:
                x[j] += step
                moved += abs(step)
                for n, m in column:
                    rest[n] -= m * step
        if moved < 1e-3:
            break
    return np.array(x)


@dataclass
class Plan:
    """Lines (length, start, lo, hi, size, sequence, offset).

    Of the remainders with this length, those with ranks lo to hi - 1 have ``size``
    tokens from ``start`` on in sequences counted up from ``sequence``, at ``offset``.
    """

    window: int
    lines: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    solved: int = 0

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and the lines."""
        table = np.array(self.lines, np.int64).reshape(-1, 7)
        keys = self.keys(table[:, 0], table[:, 1], table[:, 2])
        order = np.argsort(keys, kind="stable")
        return keys[order], table[order]

    def keys(self, length: np.ndarray, start: np.ndarray, rank: np.ndarray) -> np.ndarray:
        return ((length * self.window + start) << 40) | rank


def make_plan(hist: np.ndarray, window: int = WINDOW) -> Plan:
    """Where all remainders go; ``hist[n]`` of them have length ``n``."""
    plan, left = Plan(window), hist.astype(np.int64).tolist()
    queue = {n: deque([(n, 0, 0, c)]) for n, c in enumerate(left) if c}  # (length, start, lo, hi)

    def take(n: int, count: int, size: int, sequence: int, offset: int) -> None:
        """The next ``count`` pieces of length ``n`` give ``size`` tokens each to that many sequences."""
        left[n] -= count
        while count:
            length, start, lo, hi = queue[n].popleft()
            got = min(count, hi - lo)
            plan.lines.append((length, start, lo, lo + got, size, sequence, offset))
            if lo + got < hi:
                queue[n].appendleft((length, start, lo + got, hi))
            if size < n:
                queue.setdefault(n - size, deque()).append((length, start + size, lo, lo + got))
                left[n - size] += got
            sequence, count = sequence + got, count - got

    def fill(parts: list[tuple[int, int]], repeats: int) -> int:
        """Uses a combination of (length, times) so often; returns how much of a window is full."""
        offset = 0
        for n, times in parts:
            for _ in range(times):
                take(n, repeats, n, plan.sequences, offset)
                offset += n
        return offset

    lengths, times = combinations(hist, window)
    x = solve(lengths, times, hist)
    for j in np.argsort(-x, kind="stable"):
        parts = [(n, m) for n, m in zip(lengths[j].tolist(), times[j].tolist(), strict=True) if m]
        if repeats := min([round(x[j]), *[left[n] // m for n, m in parts]]):
            fill(parts, repeats)
            plan.sequences += repeats
    plan.solved, tokens = plan.sequences, sum(n * c for n, c in enumerate(left))
    there = [n for n, c in enumerate(left) if c]
    while tokens:
        size = window if tokens >= window else 1 << (tokens.bit_length() - 1)
        room, parts, used = size, [], {}
        while room:
            at = bisect_right(there, room)
            while at and used.get(there[at - 1], 0) >= left[there[at - 1]]:
                at -= 1
            if not at:
                break
            n = there[at - 1]
            times_ = min(left[n] - used.get(n, 0), room // n)
            parts.append((n, times_))
            used[n] = times_
            room -= n * times_
        cut_at = next((n for n in there if n > room and used.get(n, 0) < left[n]), 0) if room else 0
        if cut_at:
            used[cut_at] = used.get(cut_at, 0) + 1
        repeats = min([tokens // window if size == window else 1, *[left[n] // m for n, m in used.items()]])
        offset = fill(parts, repeats)
        if cut_at:
            take(cut_at, repeats, room, plan.sequences, offset)
        plan.sequences += repeats
        tokens -= size * repeats
        for n in {*used, cut_at - room} if cut_at else set(used):
            at = bisect_right(there, n)
            if left[n] and not (at and there[at - 1] == n):
                insort(there, n)
            elif not left[n] and at and there[at - 1] == n:
                there.pop(at - 1)
    return plan


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, n, ids)`` of every document, written once: the number of ids with the end id, and the ids, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        end = np.array([end_id], f"<u{own.width}").tobytes()
        for b in batches:
            texts, at = b.column(1).cast(pa.binary()).to_pylist(), 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size < BLOCK):
                    size += len(texts[upto])
                    upto += 1
                raw = [x + end for x in own.encode(texts[at:upto])]
                n = pa.array([len(x) // own.width for x in raw], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, upto - at), n, pa.array([pa.compress(x, "zstd", asbytes=True) for x in raw], pa.binary())], names=["id", "n", "ids"])
                at = upto

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return cut(narrow.mapInArrow(run, f"id {kind}, n long, ids binary"), "token-ids")


def ranked_remainders(rows: DataFrame, window: int) -> DataFrame:
    """``rows`` (file, row, n) with ``rest``, its rank among equal ones from 0, and ``windows``, a number that tells whole windows of all documents apart."""
    sized = rows.select("*", F.expr(f"n % {window}").alias("rest"), F.expr(f"n div {window}").alias("full"), F.expr(f"row div {ROWS}").alias("part"))
    by = Window.partitionBy("rest").orderBy("file", "part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = sized.groupBy("rest", "file", "part").agg(F.count(F.lit(1)).alias("c")).select("rest", "file", "part", F.coalesce(F.sum("c").over(by), F.lit(0)).alias("before"))
    lane = F.pmod(F.xxhash64("file", "part"), F.lit(LANES)).alias("lane")
    by = Window.partitionBy("lane").orderBy("file", "part").rowsBetween(Window.unboundedPreceding, -1)
    fulls = sized.groupBy("file", "part").agg(F.sum("full").alias("c")).select("file", "part", lane, "c").select("file", "part", "lane", F.coalesce(F.sum("c").over(by), F.lit(0)).alias("windows_before"))
    inside = Window.partitionBy("file", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumns({"rank": F.row_number().over(Window.partitionBy("file", "part", "rest").orderBy("row")) - 1, "windows": F.sum("full").over(inside) - F.col("full")})
    placed = placed.join(fulls, ["file", "part"]).join(ranks, ["rest", "file", "part"])
    return placed.select("file", "row", "n", "rest", (F.col("before") + F.col("rank")).alias("rank"), (F.col("windows_before") + F.col("windows")).alias("windows"), "lane")


_PLACES = "file string, row long, starts array<long>, sizes array<long>, sequences array<long>, offsets array<long>"


def _placer(plan, window: int):
    """Documents (file, row, n, rest, rank, windows, lane) as rows of their pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: Plan = plan.value
        keys, lines = made.arrays()
        for b in batches:
            n, rest, rank, windows, lane = (b.column(k).to_numpy().astype(np.int64) for k in range(2, 7))
            full = n // window
            doc = np.repeat(np.arange(len(n)), full)
            at = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
            pieces = [(doc, at * window, np.full(len(doc), window), made.sequences + (windows[doc] + at) * LANES + lane[doc], np.zeros(len(doc), np.int64))]
            open_, start = np.flatnonzero(rest), np.zeros(len(n), np.int64)
            while len(open_):
                line = lines[np.searchsorted(keys, made.keys(rest[open_], start[open_], rank[open_]), side="right") - 1]
                if (line[:, 0] != rest[open_]).any() or (line[:, 1] != start[open_]).any() or (rank[open_] >= line[:, 3]).any():
                    raise ValueError("the plan misses a document")
                pieces.append((open_, full[open_] * window + start[open_], line[:, 4], line[:, 5] + rank[open_] - line[:, 2], line[:, 6]))
                start[open_] += line[:, 4]
                open_ = open_[start[open_] < rest[open_]]
            doc, *columns = (np.concatenate(c) for c in zip(*pieces, strict=True))
            order = np.lexsort((columns[0], doc))
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(n)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in columns]], names=["file", "row", "starts", "sizes", "sequences", "offsets"])

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int = END, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, start, length, ids, doc_tokens, sequence_id, offset)``: the pieces of all documents.

    A document is its text's ids and ``end_id``; ``ids`` are a piece's, as little-endian
    unsigned 32-bit integers. A null text is empty and so one id long; texts may be of
    any length. Null and repeated ids are documents of their own, and so are repeated
    rows. Pieces of a sequence are gapless from offset 0; a sequence is full or, a few
    at the end, as long as a power of two. Ties of equal lengths go by place in the
    written ids. Other columns are not read, whatever their names. An empty table has
    no rows.
    """
    spark = docs.sparkSession
    written = encoded(docs, tokenizer, end_id, id_col, text_col)
    kind, width = written.schema["id"].dataType.simpleString(), encoder(tokenizer).width
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    hist = np.zeros(window, np.int64)
    for r in written.groupBy(F.expr(f"n % {window}").cast("int").alias("rest")).agg(F.count(F.lit(1)).alias("c")).collect():  # ``window`` rows at most
        hist[r.rest] = r.c * (r.rest > 0)
    plan = spark.sparkContext.broadcast(make_plan(hist, window))  # its size is bounded by the window
    ranked = ranked_remainders(written.select(*place, "n"), window)
    places = ranked.mapInArrow(_placer(plan, window), _PLACES)
    joined = written.select(*place, "id", "n", "ids").join(places, ["file", "row"]).select("id", "n", "ids", "starts", "sizes", "sequences", "offsets")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                one = b.slice(at, 256)
                n, raw = one.column(1).to_pylist(), []
                starts, sizes = one.column(3).to_pylist(), one.column(4).to_pylist()
                doc = np.repeat(np.arange(one.num_rows), [len(s) for s in starts])
                for size, packed, first, length in zip(n, one.column(2).to_pylist(), starts, sizes, strict=True):
                    ids = np.frombuffer(pa.decompress(packed, size * width, "zstd", asbytes=True), f"<u{width}").astype("<u4")
                    raw += [ids[s : s + c].tobytes() for s, c in zip(first, length, strict=True)]
                take = pa.array(doc)
                flat = [one.column(k).flatten() for k in (3, 4, 5, 6)]
                yield pa.RecordBatch.from_arrays([one.column(0).take(take), flat[0], flat[1], pa.array(raw, pa.binary()), one.column(1).take(take), flat[2], flat[3]], names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return joined.mapInArrow(pieces, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long").withColumnRenamed("id", id_col)
