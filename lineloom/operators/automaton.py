"""Many literals in one pass over each line, by an Aho-Corasick automaton.

The work of a line grows with its length and its hits, not with the number of
literals. Specs come as a table of any size: they are dealt by hash into sets of about
``PART`` bytes, and each set becomes an automaton in the tasks, so what is broadcast is
bounded and thousands of literals need a single scan.

Matches take a scan for each set. Counts of one set are made in the tasks of its scan;
counts of several take one scan in all. It cuts lines into runs, the stretches of bytes
that some literal has: a literal lies in a single run, so the sets of automata pass over
the different runs alone, however often those occur, and what they find is joined to the
rows that have the run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineloom.storage import Cut

#: Bytes of literals in one automaton, and specs counted as at least so many bytes. An automaton over runs, whose tasks hold little else, has so many times that.
PART, LEAST, RUNS_PART = 8 << 20, 32, 3
#: Bytes of text that are looked at together, bytes of runs that are put together, and counts that a task holds at most.
PIECE, CHUNK, HELD = 4 << 20, 24 << 20, 1 << 20
#: Whose runs they are: of texts whose lower case differs in A-Z alone, of other texts, and of these in lower case.
PLAIN, GIVEN, LOW = 0, 1, 2
_COUNTS = "dataset string, spec_id string, literal string, n long, first_line long, last_line long"
_RUNS = "kind int, dataset string, run binary, chunk long, rows array<int>, first_line long, last_line long"
_MATCHES = "dataset string, spec_id string, literal string, line_number long, text string"
_built: dict[str, "_Machines"] = {}


class _Machines:
    """Two automata over specs (dataset, spec_id, sought, exact, literal): of literals whose case counts, and of the others."""

    def __init__(self, specs: pa.Table):
        self.ids, self.sought, self.literals = (specs.column(name).cast(pa.string()).combine_chunks() for name in ("spec_id", "sought", "literal"))
        datasets = specs.column("dataset").combine_chunks()
        self.datasets = {d: at for at, d in enumerate(datasets.unique().drop_null().to_pylist())}
        self.of = _codes(datasets, {**self.datasets, None: -1})  # -1: all datasets
        exact = specs.column("exact").combine_chunks()
        places = [np.flatnonzero(pc.equal(exact, of).to_numpy(zero_copy_only=False)) for of in (True, False)]
        self.kinds = [self._kind(zip(self.sought.take(pa.array(own)).to_pylist(), own.tolist(), strict=True)) for own in places]

    def _kind(self, own: Iterable[tuple]):
        """The automaton (none, if there is nothing to look for), where the specs of its literals begin, these specs, and those with an empty literal, which every line holds."""
        import ahocorasick

        by: dict[str, list[int]] = {}
        for literal, at in own:
            by.setdefault(literal, []).append(at)
        every, machine = by.pop("", []), ahocorasick.Automaton()
        for at, literal in enumerate(by):
            machine.add_word(literal, at)
        machine.make_automaton()
        begin = np.concatenate([[0], np.cumsum([len(v) for v in by.values()], dtype=np.int64)]).astype(np.int64)
        return machine if by else None, begin, np.array([at for v in by.values() for at in v], np.int64), np.array(every, np.int64)

    def find(self, kind: int, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Texts with each spec that they hold, as positions of both. Bytes that are no whole character are none of a literal's."""
        machine, begin, owners, every = self.kinds[kind]
        where, found = np.repeat(np.arange(len(texts)), len(every)), np.tile(every, len(texts))
        if machine is None or not texts:
            return where, found
        joined = b"\xff".join(texts).decode("utf-8", "surrogateescape")  # no text has this byte, and no literal its escape
        met = np.fromiter(chain.from_iterable(machine.iter(joined)), np.int64).reshape(-1, 2)
        if not len(met):
            return where, found
        between = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32) == 0xDCFF)
        key = np.unique(np.searchsorted(between, met[:, 0]) * len(begin) + met[:, 1])
        at, literal = key // len(begin), key % len(begin)
        many = begin[literal + 1] - begin[literal]
        owner = np.arange(many.sum()) + np.repeat(begin[literal] - np.cumsum(many) + many, many)
        return np.concatenate([where, np.repeat(at, many)]), np.concatenate([found, owners[owner]])


def _machines(held, number: str) -> _Machines:
    """Built once in a worker."""
    if number not in _built:
        _built.clear()
        _built[number] = _Machines(held.value)
    return _built[number]


def _pieces(b: pa.RecordBatch, of: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices with about ``PIECE`` bytes of a column."""
    step = max(1, len(b) * PIECE // max(1, b.column(of).nbytes))
    for at in range(0, len(b), step):
        yield b.slice(at, step)


def _codes(column: pa.Array, codes: dict) -> np.ndarray:
    """Numbers of texts by ``codes``; -2 for others."""
    named = column.dictionary_encode("encode")
    of = np.array([codes.get(name, -2) if name is not None else codes.get(None, -2) for name in named.dictionary.to_pylist()], np.int64)
    return of[named.indices.to_numpy()] if len(column) else np.zeros(0, np.int64)


def _hits(b: pa.RecordBatch, machines: _Machines) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch (dataset, line_number, text, low) with the positions of specs that they hold."""
    where, found = [], []
    for kind in range(2):
        there = np.flatnonzero(pc.is_valid(b.column(2 + kind)).to_numpy(zero_copy_only=False))
        row, at = machines.find(kind, b.column(2 + kind).drop_null().cast(pa.binary()).to_pylist())
        where.append(there[row])
        found.append(at)
    where, found = np.concatenate(where), np.concatenate(found)
    own = (machines.of[found] == -1) | (machines.of[found] == _codes(b.column(0), machines.datasets)[where])
    return where[own], found[own]


def _finder(held, number: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = _machines(held, number)
        for b in (piece for b in batches for piece in _pieces(b, 2)):
            where, found = _hits(b, machines)
            row, at = pa.array(where), pa.array(found)
            yield pa.RecordBatch.from_arrays([b.column(0).take(row), machines.ids.take(at), machines.literals.take(at), b.column(1).take(row), b.column(2).take(row)], names=["dataset", "spec_id", "literal", "line_number", "text"])

    return run


#: Numbers that stand for none when the smallest and the largest are sought.
_NONE = np.iinfo(np.int64)


def _bounds(numbers: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return pc.fill_null(numbers, _NONE.max).to_numpy(), pc.fill_null(numbers, _NONE.min).to_numpy()


def _summed(key: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """Sums, smallest and largest of equal keys."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return [key[begin], *(f.reduceat(x[order], begin) if len(key) else x for f, x in ((np.add, n), (np.minimum, low), (np.maximum, high)))]


def _counter(held, number: str):
    """Counts of a task's lines; what several tasks counted is summed afterwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines, names, counts, size = _machines(held, number), {}, [], 0
        specs = len(machines.ids)

        def put() -> Iterator[pa.RecordBatch]:
            key, n, low, high = _summed(*(np.concatenate(c) for c in zip(*counts, strict=True)))
            at, none = pa.array(key % specs), low > high
            of = pa.array(list(names), pa.string()).take(pa.array(key // specs))
            yield pa.RecordBatch.from_arrays([of, machines.ids.take(at), machines.literals.take(at), pa.array(n), pa.array(low, mask=none), pa.array(high, mask=none)], names=["dataset", "spec_id", "literal", "n", "first_line", "last_line"])

        for b in (piece for b in batches for piece in _pieces(b, 2)):
            where, found = _hits(b, machines)
            for name in b.column(0).unique().to_pylist():
                names.setdefault(name, len(names))
            low, high = _bounds(b.column(1))
            counts.append(_summed(_codes(b.column(0), names)[where] * specs + found, np.ones(len(where), np.int64), low[where], high[where]))
            size += len(counts[-1][0])
            if size >= HELD:
                counts = [_summed(*(np.concatenate(c) for c in zip(*counts, strict=True)))]
                size = len(counts[0][0])
                if 2 * size >= HELD:
                    yield from put()
                    counts, size = [], 0
        if counts:
            yield from put()

    return run


def _sought(specs: DataFrame) -> DataFrame:
    """``(dataset, spec_id, sought, exact, literal)``: specs that any line can have, with the form that is looked for."""
    exact = F.coalesce("case_sensitive", F.lit(False))
    return specs.where("literal is not null").select("dataset", "spec_id", F.when(exact, F.col("literal")).otherwise(F.lower("literal")).alias("sought"), exact.alias("exact"), "literal")


def _n_parts(given: DataFrame, each: int) -> int:
    return -(-(given.agg(F.sum(F.octet_length("sought") + LEAST)).first()[0] or 0) // each)


def _parts(given: DataFrame, parts: int) -> Iterator[tuple]:
    """The specs of each part, for the tasks, and a name that no other has."""
    for part in range(parts):
        own = given.where(F.pmod(F.xxhash64("spec_id", "sought"), F.lit(parts)) == part) if parts > 1 else given
        yield given.sparkSession.sparkContext.broadcast(own.toArrow()), uuid.uuid4().hex


def _cased(lines: DataFrame) -> DataFrame:
    return lines.select("dataset", F.col("line_number").cast("long").alias("line_number"), "text", F.lower("text").alias("low"))


def many_matches(lines: DataFrame, specs: DataFrame) -> DataFrame:
    """``(dataset, spec_id, literal, line_number, text)``: lines with each spec that they contain.

    ``specs`` (dataset, spec_id, literal, case_sensitive) may be any number; a null
    dataset stands for all of them. An empty literal is in every line, a null one in
    none; equal specs count one by one, and a null ``case_sensitive`` is false. Without
    case, text and literal are compared in Spark's lower case. A line counts once for a
    spec, however often it holds it.
    """
    given = _sought(specs)
    if not (parts := _n_parts(given, PART)):
        return lines.sparkSession.createDataFrame([], _MATCHES)
    return reduce(DataFrame.unionByName, [_cased(lines).mapInArrow(_finder(*part), _MATCHES) for part in _parts(given, parts)])


def many_counts(lines: DataFrame, specs: DataFrame) -> DataFrame:
    """``(dataset, spec_id, literal, n, first_line, last_line)`` of all specs that a dataset has lines for: the rows of ``many_matches``, counted, in one scan whatever the number of specs."""
    given = _sought(specs)
    if not (parts := _n_parts(given, PART)):
        return lines.sparkSession.createDataFrame([], _COUNTS)
    if parts == 1:
        counts = _cased(lines).mapInArrow(_counter(*next(_parts(given, 1))), _COUNTS)
    else:
        counts = _counts_by_runs(lines, given)
    return counts.groupBy("dataset", "spec_id", "literal").agg(F.sum("n").alias("n"), F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"))


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which bytes the literals (exact, sought) of a task have, and the shortest of them."""
    has, least = np.zeros((2, 256), bool), [None, None]
    for b in batches:
        for kind, of in enumerate((True, False)):
            own = b.column(1).filter(pc.equal(b.column(0), of)).cast(pa.binary())
            if len(own):
                has[kind, np.frombuffer(b"".join(own.to_pylist()), np.uint8)] = True
                least[kind] = min(pc.min(pc.binary_length(own)).as_py(), least[kind] or 1 << 30)
    kind, byte = np.nonzero(has)
    yield pa.RecordBatch.from_arrays([pa.array(kind == 0), pa.array(byte, pa.int32()), pa.array([least[k] for k in kind], pa.int32())], names=["exact", "byte", "least"])


def _cut_into_runs(texts: pa.Array, has: np.ndarray, least: int) -> tuple[np.ndarray, pa.Array]:
    """Rows and runs: the longest stretches of the bytes ``has`` in the texts, if they have ``least`` bytes."""
    texts = texts.cast(pa.binary())
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    values = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    if not len(values):
        return np.zeros(0, np.int64), pa.array([], pa.binary())
    inside = has[values]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = ends[(ends > 0) & (ends < len(values))]  # no run goes on into the next row
    first[edge] = inside[edge]
    last[edge - 1] = inside[edge - 1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - begin >= least
    begin, end = begin[long], end[long]
    change = np.zeros(len(values) + 1, np.int8)
    change[begin] += 1
    change[end] -= 1
    kept = values[np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
    at = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    return np.searchsorted(ends, begin, "right") - 1, pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(kept)])


def _runs(alphabets: dict[int, tuple[bytes, int]]):
    """For each kind of runs its bytes and the shortest literal; gives each chunk's different runs with the rows that have them."""

    def cut(b: pa.RecordBatch, before: int) -> dict[int, tuple[np.ndarray, pa.Array]]:
        texts, low = b.column(2), b.column(3)
        plain = pc.fill_null(pc.equal(pc.ascii_lower(texts), low), False).to_numpy(zero_copy_only=False)
        there, found = pc.is_valid(texts).to_numpy(zero_copy_only=False), {}
        for kind, (own, least) in alphabets.items():
            chosen = np.flatnonzero(plain if kind == PLAIN else there & ~plain)
            has = np.zeros(256, bool)
            has[np.frombuffer(own, np.uint8)] = True
            row, runs = _cut_into_runs((low if kind == LOW else texts).take(pa.array(chosen)), has, least)
            found[kind] = chosen[row] + before, runs
        return found

    def put(datasets: list[pa.Array], numbers: list[pa.Array], cuts: list[dict], chunk: int) -> Iterator[pa.RecordBatch]:
        datasets, numbers = pa.concat_arrays(datasets), pa.concat_arrays(numbers)
        names = datasets.unique()
        name, (low_of, high_of) = _codes(datasets, {d: at for at, d in enumerate(names.to_pylist())}), _bounds(numbers)
        for kind in alphabets:
            row, runs = np.concatenate([c[kind][0] for c in cuts]), pa.concat_arrays([c.pop(kind)[1] for c in cuts]).dictionary_encode()
            if not len(row):
                continue
            key = np.unique((name[row] * len(runs.dictionary) + runs.indices.to_numpy()) * len(name) + row)
            row, key = key % len(name), key // len(name)
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            low, high, key = np.minimum.reduceat(low_of[row], begin), np.maximum.reduceat(high_of[row], begin), key[begin]
            columns = [
                pa.array(np.full(len(key), kind, np.int32)), names.take(pa.array(key // len(runs.dictionary))), runs.dictionary.take(pa.array(key % len(runs.dictionary))), pa.array(np.full(len(key), chunk)),
                pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)).astype(np.int32)), pa.array(row.astype(np.int32))), pa.array(low, mask=low > high), pa.array(high, mask=low > high),
            ]
            whole = pa.RecordBatch.from_arrays(columns, names=["kind", "dataset", "run", "chunk", "rows", "first_line", "last_line"])
            for at in range(0, len(whole), 20_000):
                yield whole.slice(at, 20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, rows, size = TaskContext.get().partitionId() << 32, ([], [], []), 0, 0
        for b in (piece for b in batches for piece in _pieces(b, 2)):
            held[0].append(b.column(0))
            held[1].append(b.column(1))
            held[2].append(cut(b, rows))
            rows += len(b)
            size += b.column(0).nbytes + b.column(1).nbytes + sum(at.nbytes + runs.nbytes for at, runs in held[2][-1].values())
            if size >= CHUNK:
                yield from put(*held, chunk)
                chunk, held, rows, size = chunk + 1, ([], [], []), 0, 0
        if rows:
            yield from put(*held, chunk)

    return run


def _run_finder(held, number: str):
    """Which literals the runs (kind, run) have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = _machines(held, number)
        for b in (piece for b in batches for piece in _pieces(b, 1)):
            kinds = b.column(0).to_numpy()
            for low in range(2):
                chosen = np.flatnonzero(kinds != (GIVEN if low else LOW))
                runs = b.column(1).take(pa.array(chosen)).to_pylist()
                row, at = machines.find(low, [r.lower() for r in runs] if low else runs)
                take = pa.array(chosen[row])
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(np.full(len(row), not low)), machines.sought.take(pa.array(at))], names=["kind", "run", "exact", "sought"])

    return run


def _counts_by_runs(lines: DataFrame, given: DataFrame) -> DataFrame:
    """``(dataset, spec_id, literal, n, first_line, last_line)``, rows to be summed. Different runs of a row that hold the same literal are put together in their chunk, which has the whole row."""
    held = Cut(given, "specs").df
    sought = Cut(held.where("sought <> ''").select("exact", "sought").distinct(), "sought").df
    of = sought.mapInArrow(_bytes, "exact boolean, byte int, least int").groupBy("exact").agg(F.collect_set("byte").alias("has"), F.min("least").alias("least")).collect()
    alphabets = {GIVEN if r.exact else LOW: (bytes(sorted(r.has)), r.least) for r in of}
    if alphabets:
        low = alphabets.get(LOW, (b"", 0))[0]
        alphabets[PLAIN] = bytes(set(low + low.upper() + alphabets.get(GIVEN, (b"", 0))[0])), min(least for _, least in alphabets.values())
    runs = Cut(_cased(lines).mapInArrow(_runs(alphabets), _RUNS), "runs").df
    each = Cut(runs.select("kind", "run").distinct(), "each").df
    terms = sought.select(F.lit(None).cast("string").alias("dataset"), F.lit("").alias("spec_id"), "sought", "exact", F.lit("").alias("literal"))
    has = reduce(DataFrame.unionByName, [each.mapInArrow(_run_finder(*part), "kind int, run binary, exact boolean, sought string") for part in _parts(terms, max(1, _n_parts(terms, RUNS_PART * PART)))])
    met = runs.join(has.hint("merge"), ["kind", "run"]).groupBy("exact", "sought", "dataset", "chunk").agg(F.size(F.array_distinct(F.flatten(F.collect_list("rows")))).cast("long").alias("n"), F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"))
    found = met.groupBy("exact", "sought", "dataset").agg(F.sum("n").alias("n"), F.min("first_line").alias("first_line"), F.max("last_line").alias("last_line"))
    if held.where("sought = ''").limit(1).count():
        number = F.col("line_number").cast("long")
        every = lines.where("text is not null").groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("first_line"), F.max(number).alias("last_line"))
        found = found.unionByName(every.select(F.explode(F.array(F.lit(True), F.lit(False))).alias("exact"), F.lit("").alias("sought"), "*"))
    own = held.withColumnRenamed("dataset", "own")
    return own.join(found.hint("merge"), ["exact", "sought"]).where("own is null or own = dataset").select("dataset", "spec_id", "literal", "n", "first_line", "last_line")
