"""Collocations by Toivonen's sampling algorithm.

A seeded sample of the documents is mined level by level under a lowered threshold
and proposes phrases. One pass over all documents then counts the proposals together
with their negative border: every phrase that occurs, that is not proposed, and whose
two shorter parts (without the last and without the first word) are. If something on
the border is frequent, the sample missed it; a further pass counts what the border
gains by it, until nothing new is frequent. The counts are exact, whatever the sample.

Scale. Tasks know the proposals by a Bloom filter of at most ``BITS`` bits, so what is
broadcast is bounded; a false positive only has a phrase counted that need not be.
Counts are keyed by the phrase itself, summed inside each block of text first, and
shuffled after partial aggregation, so neither a hot language nor a hot phrase meets in
one task. Only phrases over the threshold are written. Splits are looked up by joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineloom.storage import cut

LONGEST, LEAST, SHARE, MOST, NONE = 5, 100, 100, 2000, "und"
#: One document in SAMPLE is mined for proposals, at LOWER of the threshold that it would have in proportion.
SAMPLE, LOWER, SEED = 8, 0.5, 13
#: Bits of the filter: a power of two with 32 for each phrase, at most BITS.
BITS, BLOCK = 1 << 28, 2 << 20

_MARK = b"\xff"  # stands in no UTF-8 text
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _MARK * 10)
_COUNTS = "key string, n long"  # phrase, tab, language: a phrase has no tab, and one column is shuffled in less than three


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _joined(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of all but its last word, and that word's."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(30))


def _spots(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size - 1)
    return h & mask, (h >> np.uint64(32)) & mask


def _within(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold; no filter holds none."""
    if bits is None:
        return np.zeros(len(h), bool)
    out = np.ones(len(h), bool)
    for spot in _spots(h, len(bits) * 8):
        out &= (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def filter_size(n: int) -> int:
    return min(BITS, 1 << max(16, (32 * n - 1).bit_length()))


def phrase_filter(phrases: DataFrame, size: int) -> np.ndarray | None:
    """The Bloom filter of ``phrases`` (lang, phrase); None if there are none. The driver gets its words alone, at most ``BITS`` / 64."""

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_length: dict[int, list[np.ndarray]] = {}
            for lang, phrase in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = phrase.split(b" ")
                by_length.setdefault(len(words), []).append(_word_hashes(lang, words))
            at = [spot for rows in by_length.values() for spot in _spots(reduce(_joined, np.stack(rows).T), size)]
            spot = np.concatenate(at).astype(np.int64) if at else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spot >> 6), pa.array(np.left_shift(np.uint64(1), (spot & 63).astype(np.uint64)).view(np.int64))], names=["word", "bits"])

    words = phrases.select("lang", "phrase").mapInArrow(spots, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    if not words.num_rows:
        return None
    out = np.zeros(size // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def _blocks(rows: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], int]]:
    """``(lang, words, tail)``: the words of about ``BLOCK`` bytes of one language, pieces ended by the mark."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(rows.column(0), rows.column(1).cast(pa.binary()), strict=True):
        lang, text = lang.as_py(), text.as_py()
        held.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text) + 1
        if sizes[lang] >= BLOCK:
            yield from ((lang, *p) for p in _cut(held.pop(lang)))
            sizes[lang] = 0
    for lang, own in held.items():
        yield from ((lang, *p) for p in _cut(own))


def _cut(texts: list[bytes]) -> Iterator[tuple[list[bytes], int]]:
    """``(words, tail)``: a long text goes on in further blocks, each of which repeats the last words of the one before.

    The ``tail`` words at a block's end only end phrases there; they open theirs in the next block.
    """
    data = _MARK.join(texts).translate(_FOLD) + _MARK
    at, carry = 0, []
    while at < len(data):
        end = min(len(data), at + 2 * BLOCK)
        if end < len(data):  # a long text: up to a place between two words
            stop = max(data.rfind(b" ", at, end), data.rfind(_MARK, at, end)) + 1
            if stop <= at:  # one word longer than a block
                stop = min(x for x in (data.find(b" ", end), data.find(_MARK, end)) if x >= 0) + 1
            end = stop
        words = carry + data[at:end].replace(_MARK, b" \xff ").split()
        at = end
        carry = words[-(LONGEST - 1) :] if at < len(data) else []
        yield words, len(carry)


def _count_block(lang: str, words: list[bytes], tail: int, bits: np.ndarray | None, old: np.ndarray | None, first: bool, longest: int = LONGEST) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """``(k, phrases, counts)`` of the phrases that start in a block, but for its last ``tail`` words, and that no pass before has counted."""
    numbers = _Numbers({_MARK: 0})
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    words.clear()  # repeated words need no objects of their own any more
    own = list(numbers)
    text = pa.array(own, pa.binary())
    starts = np.ones(len(ids), bool)
    starts[len(ids) - tail :] = False
    real = ids > 0
    if first:
        n = np.bincount(ids[starts & real], minlength=len(own))
        some = np.flatnonzero(n)
        yield 0, pa.array([b""], pa.binary()), np.array([n.sum()])
        yield 1, text.take(pa.array(some)), n[some]
    if bits is None:
        return
    h = _word_hashes(lang, own)
    word_hash, now, before = h, _within(bits, h)[ids] & real, _within(old, h)[ids] & real
    number = ids
    for k in range(2, longest + 1):
        both = now[:-1] & now[1:]
        at = np.flatnonzero(both)
        if not len(at):
            return
        counted = (before[:-1] & before[1:])[at]
        last = ids[at + k - 1]
        _, inverse = np.unique(number[at] * len(own) + last, return_inverse=True)
        where = np.empty(int(inverse.max()) + 1, np.int64)
        where[inverse] = np.arange(len(at))  # a place of each phrase
        head, end = number[at[where]], last[where]
        text_k = pc.binary_join_element_wise(text.take(pa.array(head)), pa.array(own, pa.binary()).take(pa.array(end)), b" ")
        h = _joined(h[head], word_hash[end])
        n = np.bincount(inverse[starts[at]], minlength=len(where))
        new = np.flatnonzero((n > 0) & ~counted[where])
        if len(new):
            yield k, text_k.take(pa.array(new)), n[new]
        if k == longest:
            return
        now, before, number_k = np.zeros(len(ids) - k + 1, bool), np.zeros(len(ids) - k + 1, bool), np.full(len(ids) - k + 1, -1)
        number_k[at] = inverse
        now[at] = _within(bits, h)[inverse]
        before[at] = _within(old, h)[inverse] & counted
        number, text = number_k, text_k


def _count_gain(words: list[bytes], lang: str, tail: int, bits: np.ndarray, old: np.ndarray, gain: np.ndarray, longest: int = LONGEST) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """What ``_count_block`` tells under ``bits`` and ``old``, by the few places that hold a phrase of ``bits`` that isn't in ``old``.

    ``gain`` are the bits that ``old`` lacks: a new phrase has one of its two there. A
    phrase counts if all its shorter parts are in ``bits`` and were not all in ``old``.
    """
    numbers = _Numbers({_MARK: 0})
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    words.clear()
    own = list(numbers)
    text, word_hash = pa.array(own, pa.binary()), _word_hashes(lang, own)

    def fresh(h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        for spot in _spots(h, len(gain) * 8):
            out |= (gain[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1
        some = np.flatnonzero(out)
        out[some] = _within(bits, h[some]) & ~_within(old, h[some])
        return out

    by_word = word_hash[ids]
    level = [by_word]  # level[k - 1][i]: the hash of the k words from i
    some = fresh(word_hash)[ids]  # whether a new phrase lies in the k words from i
    real = ids > 0
    in_now, in_old = _within(bits, word_hash)[ids] & real, _within(old, word_hash)[ids] & real
    able = in_now  # where all words of the parts that were joined last are in ``bits``
    for k in range(2, longest + 1):
        if len(ids) < k:
            return
        some = some[:-1] | some[1:]
        at = np.flatnonzero(some)
        if k > 2:  # parts of k - 1 words and less; those of one word are known at all places
            able = able[:-1] & in_now[k - 2 :]
            place = np.flatnonzero(able)  # a part with a word outside ``bits`` makes no phrase count
            part, new = np.zeros(len(able), np.uint64), np.zeros(len(able), bool)
            part[place] = _joined(level[-1][place], by_word[place + k - 2])
            new[place] = fresh(part[place])
            level.append(part)
            some = some | new[:-1] | new[1:]
            at = np.flatnonzero(some)
        now, before = np.ones(len(at), bool), np.ones(len(at), bool)
        for j in range(k):
            now &= in_now[at + j]
        at, before = at[now], before[now]
        for j in range(k):
            before &= in_old[at + j]
        for size in range(2, k):
            for j in range(k - size + 1):
                h = level[size - 1][at + j]
                now = _within(bits, h)
                at, before = at[now], (before & _within(old, h))[now]
        at = at[~before]
        at = at[at < len(ids) - tail]
        if len(at):
            found = pc.value_counts(pc.binary_join_element_wise(*[text.take(pa.array(ids[at + j])) for j in range(k)], b" "))
            yield k, found.field("values"), found.field("counts").to_numpy()


def _counter(bits, old, first: bool, longest: int, gains: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = (None if b is None else b.value for b in (bits, old))
        gain = now & ~before if gains and before is not None and not first else None
        for b in batches:
            for lang, words, tail in _blocks(b):
                own = pa.scalar(lang.encode())
                found = _count_block(lang, words, tail, now, before, first, longest) if gain is None else _count_gain(words, lang, tail, now, before, gain, longest)
                for _, phrases, n in found:
                    yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(phrases, own, b"\t").cast(pa.string()), pa.array(n.astype(np.int64))], names=["key", "n"])

    return run


def _named(counts: DataFrame) -> DataFrame:
    """``(lang, k, phrase, n)`` of keys; no words are ``k`` 0."""
    phrase = F.substring_index("key", "\t", 1)
    spaces = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
    rows = counts.select(F.expr("substring(key, instr(key, '\t') + 1)").alias("lang"), phrase.alias("phrase"), "n")
    return rows.select("lang", F.when(F.col("phrase") == "", 0).otherwise(spaces + 1).cast("int").alias("k"), "phrase", "n")


def frequent(texts: DataFrame, least: float, known: DataFrame | None = None, size: int | None = None, longest: int = LONGEST) -> DataFrame:
    """``(lang, k, phrase, n)``: all phrases of 1 to ``longest`` words with ``n >= least``, and all words of a language as ``k`` 0.

    ``texts`` is (lang, text). ``known`` (lang, phrase) are proposals; without any, the
    passes are levels. Each further pass counts only what the border gained; with
    proposals that is little, and looked for from the places of new phrases.
    """
    spark = texts.sparkSession
    share = lambda b: None if b is None else spark.sparkContext.broadcast(b)  # noqa: E731  at most BITS / 8 bytes
    size = filter_size(known.count() if known is not None else 1 << 20) if size is None else size
    bits, old, tables = phrase_filter(known, size) if known is not None else None, None, []
    held = [share(bits), None]
    few = known is not None
    for _ in range(longest + 1):
        counts = texts.mapInArrow(_counter(*held, not tables, longest, few), _COUNTS)
        found = cut(_named(counts.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)), "phrases")
        tables.append(found)
        new = found.where(f"k between 1 and {longest - 1}").select("lang", "phrase")
        if known is not None:
            new = new.join(known, ["lang", "phrase"], "left_anti")
        more = phrase_filter(new, size)
        if more is None:
            break
        known = new if known is None else known.unionByName(new)
        old, bits = bits, more if bits is None else bits | more
        held = [share(bits), held[0]]
    return reduce(DataFrame.unionByName, tables)


def prepared(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``(lang, text)``: a null language is ``und``, a null text is empty."""
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NONE)).alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def scored(found: DataFrame, share: int = SHARE) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of the candidates among ``found`` that no longer candidate absorbs.

    Of a candidate's cuts the one with the lowest score counts, ties to the shortest
    first part. It goes if a longer candidate that holds it has ``share`` per cent of
    its count: then one that is one word longer has them too, as counts never grow
    with a phrase. Products are decimals of 38 digits.
    """
    words = F.split("phrase", " ")
    part = lambda start, n: F.array_join(F.slice(words, start, n), " ")
    totals = found.where("k = 0").select("lang", F.col("n"))
    counts = found.where("k > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    most = found.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))
    longer = most.where("k > 2").select("lang", "a", F.explode(F.array(part(F.lit(1), F.col("k") - 1), part(F.lit(2), F.col("k") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    kept = most.join(longer, ["lang", "phrase"], "left").where(f"longest is null or cast(100 as decimal(3,0)) * cast(longest as decimal(19,0)) < cast({share} as decimal(9,0)) * cast(a as decimal(19,0))")
    cuts = kept.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("*", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    cuts = cuts.join(counts.withColumnsRenamed({"part": "head", "f": "l"}), ["lang", "head"]).join(counts.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
    cuts = cuts.join(totals, "lang").withColumns({"up": F.lit(1000).cast("decimal(4,0)") * _exact("a") * _exact("n"), "down": _exact("l") * _exact("r")})
    lowest = F.min(F.struct(F.expr("up div down").alias("score"), "cut", "a", "l", "r", "n")).alias("best")
    return cuts.groupBy("lang", "phrase").agg(lowest).select("lang", "phrase", *[F.col(f"best.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, share: int = SHARE, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``most`` phrases of each language by score, count and phrase.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces
    into words at spaces and tabs. Phrases have 2 to ``LONGEST`` words of one piece and
    occur ``least`` times, overlaps included; a repeated row counts each time. A null
    language is ``und``, and one with a literal ``und`` is the same. Null and empty texts
    have no words; texts and single words may be of any length. An empty table, or one
    without frequent phrases, has no rows. Ties in everything go to the smaller phrase by
    UTF-8 bytes. Other columns are not read, whatever their names.
    """
    texts = prepared(docs, text_col, lang_col)
    drawn = texts.where(F.rand(SEED) * SAMPLE < 1)  # by rows, so that copies are drawn one by one
    proposed = frequent(drawn, max(2.0, least * LOWER / SAMPLE), longest=LONGEST - 1).where("k > 0").select("lang", "phrase")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = scored(frequent(texts, least, proposed), share).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    for by in (["lang", "part"], ["lang"]):  # a language is ranked in parts first
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
