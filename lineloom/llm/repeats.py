"""Exact removal of long repeated strings by prefix-free parsing.

Texts are parsed at triggers: positions whose rolling hash is smallest among its
neighbours on both sides. A trigger depends on the bytes around it alone, so equal
strings are parsed alike wherever they stand. Every window of ``WIDTH`` bytes belongs
to the first trigger that it determines: it holds some bytes of the phrase left of
the trigger, a suffix of that phrase, and goes on right of it, with a prefix of what
the parse has there. All windows of one trigger are a block.

1. A block's *core*, the bytes that all its windows share, is counted. A core that
   occurs once ends it: none of the block's windows repeats, and no suffix order is
   needed there.
2. Blocks with a repeated core go by their *span*, the bytes that any window of them
   has, as the dictionary's entries: equal spans are one entry. An entry that occurs
   again is repeated as a whole.
3. The entries are put in corpus order twice: by what follows the trigger (the order
   of the parse's suffixes) and by the phrase before it, read backwards (the order of
   the dictionary's phrase suffixes). Neighbours in either order are compared byte by
   byte. Neighbours by what follows give the longest common prefix ``b`` of an entry
   with any other one, neighbours by what precedes the longest common suffix ``a``:
   windows with fewer than ``WIDTH - b`` or more than ``a`` bytes before the trigger
   repeat nowhere, and the windows that a neighbour shares are repeated.
4. The few windows between these bounds that no neighbour shares may still be those of
   an entry further off. They are dealt to cells of ``CELL`` windows that follow each
   other. The bytes that all windows of a cell share are named for every entry of the
   core; only where an entry with open windows has its name in common with another one
   are windows told one by one, by names of 128 bits.

Windows too far from any trigger (long runs without one) are blocks of one window.
Repeated windows are then marked, and their bytes removed. The bytes that neighbours
have in common also tell passages of over ``PASSAGE`` words that two documents share,
whether or not they have ``WIDTH`` bytes.

Two spans count as equal if their 64-bit cores and 64-bit names are (128 bits in all);
all other comparisons are of the bytes themselves.

Scale. Rows are blocks (one in about 65 bytes), not positions, and are parsed once.
Counts have partial sums, and whatever is joined by core stands in a table of its own
first, so that adaptive execution can split a core that a third of all documents
share. Orders are sorts over ranges of the whole key, which cut such a core too; the
ends of neighbouring ranges are compared afterwards, two rows for each range. Lists
are per document and bounded by its length. Only texts with a repeated core are read
again; their keys prune the scan by broadcast if there are at most ``KEYS`` of them,
and by a join otherwise. Long texts are parsed in pieces with overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.storage import Cut, cut

WIDTH, NEAR, ROLL, REACH, PASSAGE, PIECE, MARGIN, KEYS, CELL = 400, 32, 16, 239, 50, 1 << 20, 1024, 1_000_000, 16
TAIL, AHEAD = WIDTH - REACH, WIDTH - NEAR  # bytes right of a trigger: in its core, and in its span
CORE, NONE = NEAR + TAIL, 255
_rng = np.random.default_rng(400)
_BYTE = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + _rng.integers(0, 2, (2, 256), dtype=np.uint64)
_BASE = [0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for b in (_BASE[which], pow(_BASE[which], -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _powers[which] = (both[0], both[1])
    return have


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Rolling hashes of any substrings of some bytes."""

    def __init__(self, raw: np.ndarray):
        self.prefix, self.inverse = [], []
        for k in (0, 1):
            up, down = _power(k, len(raw) + 1)
            p = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_BYTE[k][raw] * up[: len(raw)], out=p[1:])
            self.prefix.append(p)
            self.inverse.append(down)

    def of(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[k][end] - self.prefix[k][start]) * self.inverse[k][start]

    def windows(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two names of the windows that start there."""
        return _mix(self.of(0, start, start + WIDTH)), _mix(self.of(1, start, start + WIDTH))


def _triggers(h: Hashes, n: int) -> np.ndarray:
    m = n - ROLL + 1
    roll = (_mix((h.prefix[0][ROLL:] - h.prefix[0][:-ROLL]) * h.inverse[0][:m]) >> np.uint64(32)).astype(np.uint32)
    low, width = roll, 1
    while width < NEAR:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if m < 2 * NEAR + 1:
        return np.zeros(0, np.int64)
    here = roll[NEAR : m - NEAR]  # ties count, so that text of a short period has a trigger in each
    return np.flatnonzero((here <= low[: len(here)]) & (here <= low[NEAR + 1 : NEAR + 1 + len(here)])) + NEAR


def _piece(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """Core and span names, trigger (or window start), and most and least bytes of a window before it, of the blocks of some bytes."""
    n, h = len(raw), Hashes(raw)
    t = _triggers(h, n)
    before = np.concatenate([[-(1 << 40)], t[:-1]]) if len(t) else t
    some = (t >= NEAR) & (t + TAIL <= n)
    t, before = t[some], before[some]
    most = np.minimum(t - np.maximum(before - NEAR + 1, 0), REACH)
    least = np.maximum(NEAR, t - (n - WIDTH))
    least[least > most] = NONE
    start, end = t - most, np.minimum(t + AHEAD, n)
    core = _mix(h.of(0, t - NEAR, t + TAIL)) & ~np.uint64(1)
    span = _mix(h.of(0, start, end)) ^ _mix(_mix(h.of(1, start, end)) + (most * 512 + end - t).astype(np.uint64))
    if n < WIDTH:
        return core, span, t, most, least
    covered = np.zeros(n - WIDTH + 2, np.int32)
    full = least < NONE
    np.add.at(covered, start[full], 1)
    np.add.at(covered, (t - least)[full] + 1, -1)
    rest = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
    one, two = h.windows(rest)
    zero = np.zeros(len(rest), np.int64)
    return np.concatenate([core, one | np.uint64(1)]), np.concatenate([span, two]), np.concatenate([t, rest]), np.concatenate([most, zero]), np.concatenate([least, zero])


def blocks(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Core names, span names and places of all blocks of a text; a place packs the trigger and the most and least bytes of a window before it."""
    data, out = np.frombuffer(raw, np.uint8), []
    for at in range(0, max(1, len(data)), PIECE):
        a, b = max(0, at - MARGIN), min(len(data), at + PIECE + MARGIN)
        if b - a < CORE:
            continue
        core, span, t, most, least = _piece(data[a:b])
        own = (t + a >= at) & (t + a < at + PIECE)
        out.append((core[own], span[own], (((t + a) << 16) | (most << 8) | least)[own]))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def _starts(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block number and start of every window of some blocks."""
    most, least = place >> 8 & 255, place & 255
    first, count = (place >> 16) - most, np.maximum(most - least + 1, 0)
    block = np.repeat(np.arange(len(place)), count)
    return block, first[block] + np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)


def _pieces(raw: bytes, at: np.ndarray) -> Iterator[tuple[np.ndarray, Hashes, int]]:
    """Which of some places in a text lie in each piece of it, the piece's hashes, and where it begins."""
    data = np.frombuffer(raw, np.uint8)
    for begin in range(0, len(data), PIECE):
        here = np.flatnonzero((at >= begin) & (at < begin + PIECE))
        if len(here):
            a = max(0, begin - MARGIN)
            yield here, Hashes(data[a : begin + PIECE + MARGIN]), a


def window_names(raw: bytes, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Block number, start and both names of every window of some blocks."""
    block, start = _starts(place)
    one, two = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    for here, h, at in _pieces(raw, start):
        one[here], two[here] = h.windows(start[here] - at)
    return block, start, one, two


def strip(raw: bytes, starts: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, removed runs and the SHA-256 of what stays, when the windows that start there go."""
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WIDTH, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
    return int(gone.sum()), runs, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()


def most_words(raw: bytes, start: np.ndarray, end: np.ndarray) -> int:
    """The most whole words (runs without ASCII white space) in any of some stretches of a text."""
    if not len(start):
        return 0
    data = np.frombuffer(raw, np.uint8)
    space = np.concatenate([[True], (data == 32) | ((data >= 9) & (data <= 13)), [True]])
    first, last = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    return int(max(0, (np.searchsorted(last, end, "right") - np.searchsorted(first, start)).max()))


def _keys(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("k1"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("k2")]


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
        for at in range(0, b.num_rows, 1024):
            found = [blocks(t.as_py()) for t in b.column(2).slice(at, 1024)]
            doc = np.repeat(np.arange(at, at + len(found)), [len(f[0]) for f in found])
            core, span, place = (np.concatenate([f[k] for f in found]) for k in range(3))
            yield pa.RecordBatch.from_arrays([_longs(core), _longs(span), pa.array(k1[doc]), pa.array(k2[doc]), _longs(place)], names=["core", "span", "k1", "k2", "place"])


#: What a listed block is. Repeated, in one document or in several; a common stretch, packed otherwise; an entry of the
#: dictionary: standing for several documents, for one that has it more than once, or for a single block.
WITHIN, ACROSS, STRETCH, MANY, AGAIN, ONE = 1, 2, 3, 4, 5, 6
ROWS = "core long, span long, k1 long, k2 long, place long"
ENTRY = "core long, k1 long, k2 long, place long, kind int, left binary, right binary"
NEIGHBOURS = "core long, k1 long, k2 long, place long, kind int, a int, b int, shared array<int>, edge long, left binary, right binary"


def _listed(codes: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Places and kinds of the entries of a text."""
    code = codes.values.to_numpy()
    code = code[(code & 7) >= MANY]
    return code >> 3, code & 7


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around each listed trigger, those of its core left out; the phrase before it stands backwards."""
    for b in batches:
        for k1, k2, raw, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
            text = raw.as_py()
            place, kind = _listed(codes)
            core = np.zeros(len(place), np.uint64)
            t, most = place >> 16, place >> 8 & 255
            for here, h, at in _pieces(text, t):
                x, own = t[here] - at, most[here] > 0
                core[here[own]] = _mix(h.of(0, x[own] - NEAR, x[own] + TAIL)) & ~np.uint64(1)
                core[here[~own]] = h.windows(x[~own])[0] | np.uint64(1)
            left = [text[x - m : x - NEAR][::-1] if m else b"" for x, m in zip(t.tolist(), most.tolist(), strict=True)]
            right = [text[x + TAIL : x + AHEAD] if m else text[x : x + WIDTH] for x, m in zip(t.tolist(), most.tolist(), strict=True)]
            n = len(place)
            yield pa.RecordBatch.from_arrays([_longs(core), pa.array(np.full(n, k1)), pa.array(np.full(n, k2)), _longs(place), pa.array(kind.astype(np.int32)), pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["core", "k1", "k2", "place", "kind", "left", "right"])


def _padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    size = pc.binary_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0)) + 1), np.uint8)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(bytearray(b"".join(column.to_pylist())), np.uint8)
    return out, size


def _common(column: pa.Array) -> np.ndarray:
    """How many bytes each row has in common with the next one."""
    rows, size = _padded(column)
    equal = rows[:-1] == rows[1:]
    equal &= np.arange(rows.shape[1]) < np.minimum(size[:-1], size[1:])[:, None]
    return equal.argmin(axis=1)


def _neighbours(ends: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ordered entries have in common with the one before and the one after.

    ``a`` and ``b`` are the most bytes in common before and after the trigger,
    ``shared`` packs both for each neighbour, with a bit for one of another document.
    The first and last row of a partition are given again with their bytes and an
    ``edge`` number; with ``ends`` the rows are such edges, and only pairs over the
    border of two partitions count.
    """
    part = None if ends else TaskContext.get().partitionId()
    held: pa.RecordBatch | None = None
    before = (0, 0, -1)  # of the held row and the one before it: bytes in common on both sides, and the packed pair
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is None and not ends:
            yield _edge(batch, 0, 2 * part)
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        core, k2, place, kind = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 4))
        window = (place >> 8 & 255) == 0
        a, b = _common(rows.column(5)) + np.where(window[1:], 0, NEAR), _common(rows.column(6)) + np.where(window[1:], 0, TAIL)
        met = core[1:] == core[:-1]
        if ends:
            edge = rows.column(7).to_numpy()
            met &= (edge[:-1] % 2 == 1) & (edge[1:] % 2 == 0)
        apart = (k2[1:] != k2[:-1]) | (kind[1:] == MANY) | (kind[:-1] == MANY)
        pair = np.where(met, a << 12 | b << 1 | apart, -1)
        yield _told(rows, len(rows) - 1, before, a * met, b * met, pair)
        if len(pair):
            before = (int(a[-1] * met[-1]), int(b[-1] * met[-1]), int(pair[-1]))
        held = rows.slice(len(rows) - 1)
    if held is not None:
        none = np.zeros(0, np.int64)
        yield _told(held, 1, before, none, none, none)
        if not ends:
            yield _edge(held, 0, 2 * part + 1)


def _told(rows: pa.RecordBatch, n: int, before: tuple[int, int, int], a: np.ndarray, b: np.ndarray, pair: np.ndarray) -> pa.RecordBatch:
    last = len(pair) < n  # the last row of all has nothing after it
    sides = [(np.append(before[k], x)[:n], np.append(x, fill)[:n] if last else x[:n]) for k, x, fill in ((0, a, 0), (1, b, 0), (2, pair, -1))]
    keep = np.flatnonzero(rows.column(4).to_numpy(zero_copy_only=False)[:n] >= AGAIN)
    shared = [[p for p in two if p >= 0] for two in zip(sides[2][0][keep].tolist(), sides[2][1][keep].tolist(), strict=True)]
    kept = rows.slice(0, n).take(pa.array(keep))
    empty = pa.nulls(len(keep), pa.binary())
    most = [pa.array(np.maximum(*sides[k])[keep].astype(np.int32)) for k in (0, 1)]
    return pa.RecordBatch.from_arrays([*[kept.column(k) for k in range(5)], *most, pa.array(shared, pa.list_(pa.int32())), pa.nulls(len(keep), pa.int64()), empty, empty], names=[c.split()[0] for c in NEIGHBOURS.split(", ")])


def _edge(rows: pa.RecordBatch, at: int, number: int) -> pa.RecordBatch:
    row, zero = rows.slice(at, 1), pa.array([0], pa.int32())
    return pa.RecordBatch.from_arrays([*[row.column(k) for k in range(5)], zero, zero, pa.array([[]], pa.list_(pa.int32())), pa.array([number], pa.int64()), row.column(5), row.column(6)], names=[c.split()[0] for c in NEIGHBOURS.split(", ")])


def _in_order(entries: DataFrame, *by: str) -> DataFrame:
    """What every entry has in common with its neighbours in the order of (core, *by)."""
    told = cut(entries.repartitionByRange("core", *by).sortWithinPartitions("core", *by).mapInArrow(lambda batches: _neighbours(False, batches), NEIGHBOURS), "order")
    edges = told.where("edge is not null").select("core", "k1", "k2", "place", "kind", "left", "right", "edge")  # two rows for each range
    over = edges.repartition(1).sortWithinPartitions("edge").mapInArrow(lambda batches: _neighbours(True, batches), NEIGHBOURS)
    return told.where("edge is null").unionByName(over).select("core", "k1", "k2", "place", "kind", "a", "b", "shared")


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows and common stretches of entries, as codes, and a bit for each cell with windows that are left open."""
    for batch in batches:
        out = []
        for core, k1, k2, place, kind, a, b, shared in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            t, most, least = place >> 16, place >> 8 & 255, place & 255
            free = [True] * (REACH + 1) if kind == ONE else []
            for pair in set(shared):
                x, y = pair >> 12, pair >> 1 & 2047
                if pair & 1:
                    out.append((core, k1, k2, (t << 20 | x << 11 | y) << 3 | STRETCH, place, 0))
                lo, hi = max(least, WIDTH - y), min(most, x)
                if kind == ONE and lo <= hi:
                    out.append((core, k1, k2, (t << 16 | hi << 8 | lo) << 3 | WITHIN, place, 0))
                    free[lo : hi + 1] = [False] * (hi + 1 - lo)
            if kind == ONE:
                open_ = [x for x in range(max(least, WIDTH - b), min(most, a) + 1) if free[x]]
                if open_:
                    out.append((core, k1, k2, None, place, sum({1 << x // CELL for x in open_})))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5], pa.int32())], names=["core", "k1", "k2", "code", "place", "cells"])


def _own(place: np.ndarray, k1: int, k2: int) -> np.ndarray:
    """A name of each entry itself."""
    return _mix(_mix((place >> 16).astype(np.uint64) + np.uint64(k2 & (1 << 64) - 1)) + np.uint64(k1 & (1 << 64) - 1))


def _name_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of what the windows of a cell share, for the cells of a core that are open; ``open`` where they are so in this entry."""
    bit = np.arange(REACH // CELL + 1)
    for b in batches:
        for k1, k2, raw, due in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
            text, (place, cells, mine) = raw.as_py(), (due.values.field(k).to_numpy() for k in range(3))
            most, least = place >> 8 & 255, place & 255
            entry, cell = np.nonzero((cells[:, None] >> bit & 1 == 1) & (least[:, None] < (bit + 1) * CELL) & (most[:, None] >= bit * CELL))
            t, n = place[entry] >> 16, len(entry)
            lo, hi = np.maximum(least[entry], cell * CELL), np.minimum(most[entry], cell * CELL + CELL - 1)
            one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            for here, h, at in _pieces(text, t):
                start = t[here] - at - cell[here] * CELL
                one[here], two[here] = (_mix(h.of(k, start, start + WIDTH - CELL + 1) + cell[here].astype(np.uint64)) for k in (0, 1))
            code = (t << 16 | hi << 8 | lo) << 3 | np.where(mine[entry] >> cell & 1, ONE, MANY)
            yield pa.RecordBatch.from_arrays([_longs(one), _longs(two), pa.array(np.full(n, k1)), pa.array(np.full(n, k2)), _longs(code), _longs(_own(place, k1, k2)[entry]), pa.array(mine[entry] >> cell & 1 == 1)], names=["w1", "w2", "k1", "k2", "code", "own", "open"])


def _name_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k1, k2, raw, codes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
            place, kind = _listed(codes)
            block, start, one, two = window_names(raw.as_py(), place)
            own = _own(place, k1, k2)
            n = len(start)
            yield pa.RecordBatch.from_arrays([_longs(one), _longs(two), pa.array(np.full(n, k1)), pa.array(np.full(n, k2)), _longs(start), _longs(own[block]), pa.array(kind[block] == ONE)], names=["w1", "w2", "k1", "k2", "start", "own", "open"])


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for raw, listed, more in zip(b.column(1), b.column(2), b.column(3), strict=True):
            data = raw.as_py()
            code = np.concatenate([x.values.to_numpy() for x in (listed, more) if x.is_valid])
            val, kind = code >> 3, code & 7
            _, start = _starts(val[(kind == WITHIN) | (kind == ACROSS)])
            whole, part = val[kind == ACROSS], val[kind == STRETCH]
            t, most = whole >> 16, whole >> 8 & 255
            ends = np.minimum(t + np.where(most == 0, WIDTH, AHEAD), len(data))
            words = most_words(data, np.concatenate([t - most, (part >> 20) - (part >> 11 & 511)]), np.concatenate([ends, (part >> 20) + (part & 2047)]))
            rows.append((len(data), *strip(data, np.unique(start)), words if words > PASSAGE else 0))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string()), pa.array(columns[4], pa.int64())], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "passage_words"])


def _packed(kind: Column, place: str = "place") -> Column:
    return (F.col(place) * 8 + kind).alias("code")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept_sha256, passage_words)`` of every row.

    Bytes covered by a ``WIDTH``-byte string that also starts anywhere else, in the
    same or another row, are removed; strings are judged on the input. Matches don't
    cross rows, rows that repeat each other are all removed, and texts shorter than
    ``WIDTH`` bytes, empty and null ones lose nothing. Rows are told apart by id (null
    included) and text. Other columns are not read.

    ``passage_words`` is zero unless the row shares a passage of over ``PASSAGE``
    words with another document (rows with the same id and text are one), of whatever
    number of bytes; then it is how many words were seen to be shared, at most those
    around one trigger. A passage is seen if it holds a trigger with ``NEAR`` bytes
    before and ``TAIL`` bytes after it, and is whole next to it in corpus order.
    """
    docs = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text_col))
    keyed = docs.select(F.col(id_col).alias("id"), *_keys(id_col, text_col), F.col(text_col).cast("binary").alias("raw"))
    long = keyed.where(F.octet_length("raw") >= CORE)
    parsed = Cut(long.select("k1", "k2", "raw").mapInArrow(_parse, ROWS), "parse")
    again = Cut(parsed.df.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"), "cores")
    blocks_again = Cut(parsed.df.join(again.df, "core"), "blocks")
    parsed.drop()
    place = F.min(F.struct("k1", "k2", "place"))
    spans = Cut(blocks_again.df.groupBy("core", "span").agg(F.count(F.lit(1)).alias("n"), place.alias("one"), (F.min("k2") != F.max("k2")).alias("many")), "spans")
    twice = Cut(spans.df.where("n > 1").select("core", "span", "many"), "twice")
    whole = blocks_again.df.join(twice.df, ["core", "span"]).select("k1", "k2", _packed(F.when(F.col("many"), ACROSS).otherwise(WITHIN)))
    mixed = Cut(spans.df.groupBy("core").agg(F.count(F.lit(1)).alias("spans")).where("spans > 1").select("core"), "mixed")
    kind = F.when(F.col("n") == 1, ONE).when(F.col("many"), MANY).otherwise(AGAIN)
    listed = spans.df.join(mixed.df, "core").select("one.k1", "one.k2", _packed(kind, "one.place"))
    lists = Cut(whole.unionByName(listed).groupBy("k1", "k2").agg(F.collect_set("code").alias("codes")), "lists")
    for used in (blocks_again, again, spans, twice, mixed):
        used.drop()
    if lists.df.count() <= KEYS:
        long = long.join(F.broadcast(lists.df.select("k1", "k2")), ["k1", "k2"], "left_semi")
    touched = cut(long.join(lists.df, ["k1", "k2"]), "touched")
    lists.drop()

    texts = touched.where(F.exists("codes", lambda x: x % 8 >= MANY)).dropDuplicates(["k1", "k2"]).select("k1", "k2", "raw", "codes")
    entries = cut(texts.mapInArrow(_entries, ENTRY), "entries")
    seen = _in_order(entries, "right", "left").unionByName(_in_order(entries, "left", "right"))
    each = seen.groupBy("core", "k1", "k2", "place", "kind").agg(F.max("a").alias("a"), F.max("b").alias("b"), F.flatten(F.collect_list("shared")).alias("shared"))
    judged = cut(each.mapInArrow(_judge, "core long, k1 long, k2 long, code long, place long, cells int"), "judged")

    mine = judged.where("cells > 0").select("core", "k1", "k2", "place", F.col("cells").alias("mine"))
    open_cores = cut(mine.groupBy("core").agg(F.bit_or("mine").alias("cells")), "open")
    due = entries.select("core", "k1", "k2", "place").join(open_cores, "core").join(mine, ["core", "k1", "k2", "place"], "left")
    due = due.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "cells", F.coalesce("mine", F.lit(0)).alias("mine"))).alias("due"))
    shared = lambda named: named.groupBy("w1", "w2").agg(F.min("own").alias("x"), F.max("own").alias("y"), F.max("open").alias("open")).where("x <> y and open").select("w1", "w2")
    cells = cut(texts.drop("codes").join(due, ["k1", "k2"]).mapInArrow(_name_cells, "w1 long, w2 long, k1 long, k2 long, code long, own long, open boolean"), "cells")
    left = cells.join(shared(cells), ["w1", "w2"]).groupBy("k1", "k2").agg(F.collect_set("code").alias("codes"))
    named = cut(texts.drop("codes").join(left, ["k1", "k2"]).mapInArrow(_name_windows, "w1 long, w2 long, k1 long, k2 long, start long, own long, open boolean"), "windows")
    windows = named.where("open").join(shared(named), ["w1", "w2"]).select("k1", "k2", F.expr(f"shiftleft(start, 19) + {WITHIN}").alias("code"))

    more = judged.where("code is not null").select("k1", "k2", "code").unionByName(windows).groupBy("k1", "k2").agg(F.collect_set("code").alias("more"))
    cleaned = touched.join(more, ["k1", "k2"], "left").select("id", "raw", "codes", "more").mapInArrow(_strip, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, passage_words long")

    none = F.lit(0).cast("long")
    rest = keyed.select("id", "k1", "k2", F.octet_length("raw").cast("long").alias("n_bytes"), F.sha2("raw", 256).alias("kept_sha256"))
    alone = rest.join(touched.select("k1", "k2").distinct(), ["k1", "k2"], "left_anti").select("id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), "kept_sha256", none.alias("passage_words"))
    return cleaned.unionByName(alone).withColumnRenamed("id", id_col)
