"""SimHash near-duplicates, searched through pivot distance tables.

A text's fingerprint has 64 bits: one for every bit position that is set in over
half of the XXH64 values of its word shingles. Two fingerprints link if they differ
in at most three bits, and linked documents form components.

Search. Equal fingerprints are merged first, so groups of copies cost one row.
Three differing bits touch at most three of five bit blocks, so linked
fingerprints agree on two whole blocks: ten keys of about 26 bits deal every
fingerprint to small buckets. In a bucket each fingerprint has a row in a pivot
table, its Hamming distances to a fixed set of reference fingerprints. A distance
to a reference can't change by more than the distance between two fingerprints,
so a pair whose largest coordinate difference is over three is discarded;
the survivors are verified bit by bit.

Scale. The text is read once and only (doc_id, fingerprint) leaves that pass.
A bucket of more than ``BLOCK`` fingerprints is cut into chunks, and each pair of
chunks is a block of its own, so no task holds a large bucket. A block with many
fingerprints returns a spanning forest of its links, not all pairs. Components are
contracted by alternating stars. Nothing is capped and nothing is collected.

:func:`keep_one_similar` links rows by the exact Jaccard similarity of their sets of
five-word shingles. It begins with the search above, over fingerprints of those
shingles: what the pivot tables and bits leave is verified by the sets, and only sets
that this didn't join are looked at any further. Three bits reach few pairs of lower
similarity, so further candidates share a block pair of the fingerprint, however many
bits differ, or one of ``BANDS`` keys, each of ``ROWS`` minima of the set under other
hashes: at similarity 0.8 one pair in 16,000 shares none. Shingles that no other set has bound what a set can have in common with any, so
heavily edited copies drop out before pairs are made. All candidates of a bucket meet
its centre, the set with the least share of such shingles; then only pairs that this
left in different components are looked at, each pair once, inside blocks of bounded
size. Those that can be alike by their sizes and residues, which loses none, and agree
in ``AGREE`` of the minima (at similarity 0.8 one pair in 50,000 agrees in fewer) are
compared, so a group of near copies costs a star.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineloom.llm.rows import ID, ROW, row_hash, with_keys
from lineloom.operators.components import connected_components
from lineloom.storage import cut

SEED, SHINGLE, BITS, BLOCK, PIVOTS, FEW = 42, 3, 3, 2048, 24, 1_000_000
#: Near copies by content: shingle length, least similarity as a fraction, keys and minima in a key.
WIDE, SIMILAR, BANDS, ROWS = 5, (4, 5), 32, 6
#: Least number of the minima that a pair has in common: 0.68 of them, 4 standard deviations under what 0.8 gives.
AGREE, RESIDUES = 130, 2048
#: Five blocks of the 64 bits, and the ten pairs of them.
EDGES = (0, 13, 26, 39, 52, 64)
MASKS = [sum(((1 << EDGES[b + 1]) - (1 << EDGES[b])) for b in pair) for pair in combinations(range(5), 2)]


def shingle_hashes(text: str | None, size: int, chunk: int = 1 << 16) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle of the lower-cased text, in arrays of at most ``chunk``."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, and only the six ASCII separators
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    last = min(size, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, chunk):
        to = min(n, at + chunk)
        a, b = starts[at:to].tolist(), ends[at + last : to + last].tolist()
        yield np.fromiter([digest(line[x:y], SEED) for x, y in zip(a, b, strict=True)], np.uint64, to - at)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint; zero for a text without words."""
    return _majority(shingle_hashes(text, size))


def _majority(hashes: Iterable[np.ndarray]) -> int:
    total, n = np.zeros(64, np.int64), 0
    for h in hashes:
        total += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(total * 2 > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, id_type: str = "bigint") -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` is the fingerprint as a signed long. A null text has no words."""
    narrow = docs.select(F.col(id_col).cast(id_type).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), size) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return narrow.mapInArrow(run, f"id {id_type}, fp bigint")


def _references(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.arange(n, dtype=np.uint64) % np.uint64(2)


def _close(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
    """Which of the pairs (i, j) link: coordinate after coordinate, then the bits themselves."""
    keep = np.arange(len(i))
    for k in range(0, table.shape[0], 4):  # survivors get fewer with every four references
        if not len(keep):
            return keep
        part = table[k : k + 4]
        far = np.abs(part[:, i[keep]] - part[:, j[keep]]).max(axis=0)
        keep = keep[far <= bits]
    return keep[np.bitwise_count(fp[i[keep]] ^ fp[j[keep]]) <= bits]


def _forest(fp: np.ndarray, table: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of one large block."""
    label, everyone = np.arange(len(fp)), np.arange(len(fp))
    for x in range(len(fp)):
        near = _close(fp, table, np.full(len(fp), x), everyone, bits)
        groups, first = np.unique(label[near], return_index=True)
        if len(groups) > 1:
            yield np.full(len(groups), fp[x]), fp[near[first]]
            label[np.isin(label, groups)] = groups[0]


def _links(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, fp) come ordered by block; a block may go over several batches."""
    refs = _references()

    def solve(block: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        table = np.bitwise_count(fp[None, :] ^ refs[:, None]).astype(np.int8)  # the pivot distance table
        bounds = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        big = np.zeros(len(fp), bool)
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - s > 32:
                big[s:e] = True
                for x, y in _forest(fp[s:e], table[:, s:e], bits):
                    a.append(x)
                    b.append(y)
        i, step = np.flatnonzero(~big), 1
        while len(i):
            i = i[i + step < len(fp)]
            i = i[block[i] == block[np.minimum(i + step, len(fp) - 1)]]
            hit = _close(fp, table, i, i + step, bits) if len(i) else i
            a.append(fp[i[hit]])
            b.append(fp[i[hit] + step])
            step += 1
        x, y = np.concatenate(a), np.concatenate(b)
        apart = x != y
        return pa.RecordBatch.from_arrays([pa.array(x[apart].view(np.int64)), pa.array(y[apart].view(np.int64))], names=["src", "dst"])

    blocks, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for b in batches:
        blocks = np.concatenate([blocks, b.column(0).to_numpy()])
        fps = np.concatenate([fps, b.column(1).to_numpy().view(np.uint64)])
        full = np.searchsorted(blocks, blocks[-1]) if len(blocks) else 0
        if full:
            yield solve(blocks[:full], fps[:full])
            blocks, fps = blocks[full:], fps[full:]
    if len(fps):
        yield solve(blocks, fps)


def _pair_blocks(rows: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """Rows dealt so that all pairs of a bucket meet: ``block`` and ``side``, 0 where all rows meet each other, else 1 and 2, which meet.

    A bucket of more than ``block`` rows is cut into chunks, and each pair of chunks is a block of its own.
    """
    sizes = cut(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("chunks"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size"), "buckets")
    mine = rows.join(sizes, key).withColumn("mine", F.expr(f"pmod(xxhash64({member}), chunks)").cast("int")).withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).cast("int")
    named = F.when(F.col("chunks") == 1, F.col(key)).otherwise(F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")))
    dealt = mine.withColumn("block", named).withColumn("side", side).drop(key, "chunks", "mine", "other")
    return dealt.repartition("block").sortWithinPartitions("block", "side")


def fingerprint_links(distinct: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(src, dst)`` among distinct fingerprints ``fp``; large blocks give a spanning forest of theirs."""
    if not 0 <= bits <= 3:
        raise ValueError("the ten block pairs find at most three differing bits")
    signed = [m - (1 << 64) if m >> 63 else m for m in MASKS]
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("band"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for i, m in enumerate(signed)])
    dealt = distinct.select("fp", F.explode(keys).alias("k")).select("fp", F.xxhash64("k.band", "k.key").alias("bucket"))
    ordered = _pair_blocks(dealt, "bucket", "fp", block).select("block", "fp")
    return ordered.mapInArrow(lambda batches: _links(bits, batches), "src long, dst long")


def fingerprint_classes(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """``(fp, component, component_id)`` of every distinct fingerprint of ``fps`` (id, fp)."""
    classes = cut(fps.groupBy("fp").agg(F.min("id").alias("least_id")), "classes")
    found = connected_components(fingerprint_links(classes.select("fp"), bits))
    named = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return named.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` for every row.

    ``component_id`` is the smallest id reachable over links of fingerprints that
    differ in at most ``bits`` bits, the row's own included. Rows with a null id
    get the component of their text too and never name one unless all its ids are
    null. Texts without words (null, empty, white space) have fingerprint zero and
    are linked like any other. Repeated rows give repeated rows. Other columns are
    not read.
    """
    fps = cut(fingerprints(docs, id_col, text_col, size), "fingerprints")
    label = fingerprint_classes(fps, bits).drop("component")
    return fps.join(label, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` with the id as a struct of the id itself and a hash of the row."""
    return docs.select(F.struct(F.col(id_col).cast("long").alias("id"), row_hash(docs).alias("row")).alias("id"), F.col(text_col).cast("string").alias("text"))


def _first_rows(docs: DataFrame, id_col: str, named: DataFrame) -> DataFrame:
    """Of ``docs`` the row of each component that comes first by (id, row), null ids last; ``named`` is (id struct, component)."""
    first = named.groupBy("component").agg(F.min(F.struct(F.col("id.id").isNull().alias("none"), F.col("id").alias("key"))).alias("one"))
    kept = first.select(F.coalesce("one.key.id", F.lit(0)).cast("long").alias(ID), F.col("one.key.row").alias(ROW))
    keyed = with_keys(docs, id_col)
    return keyed.join(kept, [ID, ROW], "left_semi").dropDuplicates([ID, ROW]).drop(ID, ROW)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One row of each component of near duplicates, all columns kept: that of the smallest id, null ids last.

    Ids are whole numbers. Of rows with that id the one with the smallest hash of all
    columns stays, of equal rows one.
    """
    fps = cut(fingerprints(_named_rows(docs, id_col, text_col), "id", "text", size, "struct<id:bigint,row:bigint>"), "fingerprints")
    label = fingerprint_classes(fps.select(F.col("id.id").alias("id"), "fp"), bits).select("fp", "component")
    return _first_rows(docs, id_col, fps.join(label, "fp").select("id", "component"))


def _factors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    odd = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd(BANDS * ROWS), odd(BANDS * ROWS), odd(BANDS * ROWS + len(MASKS))


def _minima(members: np.ndarray, factors: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of a set of shingle hashes under each hash function."""
    a, b, mix = factors
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), 1024):
        least = np.minimum(least, (a[:, None] * members[None, at : at + 1024] + b[:, None]).min(axis=1))
    return least * mix[: len(a)]


def _bits(members: np.ndarray) -> bytes:
    """A bit for each residue of the shingle hashes."""
    bits = np.zeros(RESIDUES, bool)
    bits[(members >> np.uint64(20)) % np.uint64(RESIDUES)] = True
    return np.packbits(bits).tobytes()


def _keys(least: np.ndarray, fp: int, factors: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Bucket keys of a set: one for each band of its minima, then the fingerprint's block pairs."""
    bands = least.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    blocks = (np.array([fp & m for m in MASKS], np.uint64) + np.uint64(1)) * factors[2][len(least) :]
    return np.concatenate([bands, blocks]).view(np.int64)


def _members(hashes: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)


def sketches(docs: DataFrame, size: int = WIDE) -> DataFrame:
    """``(id, digest, n, fp, keys, minima)`` of rows ``(id, text)``: a hash of the row's set of shingles, its size, its fingerprint, its buckets, and 16 bits of each minimum followed by the set's residues."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors()
        for b in batches:
            digests, sizes, fps, keys, minima = [], [], [], [], []
            for t in b.column(1):
                hashes = list(shingle_hashes(t.as_py(), size))
                members = _members(hashes)
                least = _minima(members, factors)
                digests.append(xxhash.xxh64_intdigest(members.tobytes(), SEED))
                sizes.append(len(members))
                fps.append(_majority(hashes))
                keys.append(_keys(least, fps[-1], factors).tolist() if len(members) else [])
                minima.append((least >> np.uint64(48)).astype("<u2").tobytes() + _bits(members))
            columns = [b.column(0), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64())), pa.array(minima, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "n", "fp", "keys", "minima"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, digest bigint, n bigint, fp bigint, keys array<bigint>, minima binary")


def _shingle_sets(texts: DataFrame, size: int) -> DataFrame:
    """``(digest, members)`` of rows ``(digest, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [_members(list(shingle_hashes(t.as_py(), size))).view(np.int64) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["digest", "members"])

    return texts.mapInArrow(run, "digest bigint, members array<bigint>")


def _alike(inner: Column, a: Column, b: Column) -> Column:
    """Whether sets of ``a`` and ``b`` members with ``inner`` in common reach the similarity."""
    num, den = SIMILAR
    return inner * (num + den) >= (a + b) * num


def _near_minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components that can be alike and agree in ``AGREE`` of the minima.

    Residues that one set has and the other hasn't are members that aren't shared, so
    they bound what is. Sizes and members without another set bound it too.
    Rows are (block, side, digest, n, most, component, minima, band, keys). A pair that
    shares several buckets is told in the first of them only.
    """
    num, den = SIMILAR

    def solve(rows: pa.Table) -> pa.RecordBatch:
        side, digest, n, most, component = (rows.column(k).to_numpy() for k in range(1, 6))
        sketch = np.frombuffer(b"".join(rows.column(6).to_pylist()), np.uint8).reshape(len(side), -1)
        minima, bits = (np.ascontiguousarray(part).view(kind) for part, kind in ((sketch[:, : 2 * BANDS * ROWS], "<u2"), (sketch[:, 2 * BANDS * ROWS :], "<u8")))
        band, keys = int(rows.column(7)[0].as_py()), np.stack(rows.column(8).to_numpy())
        left, right = (np.flatnonzero(side == k) for k in ((0, 0) if not side[0] else (1, 2)))
        src, dst = [], []
        if len(left) and len(right) and (component != component[0]).any():
            for x in left:
                y = right if side[0] else right[right > x]
                y = y[(component[y] != component[x]) & (np.minimum(most[y], most[x]) * (num + den) >= (n[y] + n[x]) * num)]
                y = y[(minima[y] == minima[x]).sum(axis=1) >= AGREE]
                y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)]
                inner = np.minimum(n[x] - np.bitwise_count(bits[x] & ~bits[y]).sum(axis=1, dtype=np.int64), n[y] - np.bitwise_count(bits[y] & ~bits[x]).sum(axis=1, dtype=np.int64))
                y = y[inner * (num + den) >= (n[y] + n[x]) * num]
                src.append(np.minimum(digest[x], digest[y]))
                dst.append(np.maximum(digest[x], digest[y]))
        none = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(none + src)), pa.array(np.concatenate(none + dst))], names=["src", "dst"])

    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        blocks = b.column(0).to_numpy()
        bounds = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]])) if len(blocks) else np.zeros(0, np.int64)
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if held and blocks[s] != last:
                yield solve(pa.Table.from_batches(held).combine_chunks())
                held = []
            held.append(b.slice(s, e - s))
            last = blocks[s]
    if held:
        yield solve(pa.Table.from_batches(held).combine_chunks())


def pivot_pairs(classes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pairs ``(src, dst)`` of sets ``(digest, n, fp)`` that the search by pivot tables gives.

    A fingerprint stands for its first set: the other sets with it meet that one, and
    first sets meet if their fingerprints link.
    """
    some = classes.where("n > 0").select("digest", "fp")
    first = cut(some.groupBy("fp").agg(F.min("digest").alias("first")), "fingerprints")
    same = some.join(first, "fp").where("digest <> first").select(F.col("first").alias("src"), F.col("digest").alias("dst"))
    links = fingerprint_links(first.select("fp"), block=block).select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).distinct()
    for end, name in (("x", "src"), ("y", "dst")):
        links = links.join(first.select(F.col("fp").alias(end), F.col("first").alias(name)), end)
    return same.unionByName(links.select("src", "dst"))


def similar_links(classes: DataFrame, texts: DataFrame, size: int = WIDE, block: int = BLOCK, few: int = FEW) -> DataFrame:
    """Links ``(src, dst)`` that give the components of similar sets.

    ``classes`` is (digest, n, fp, keys, id) with the id of one row of each set, ``texts``
    (id, text). The ids whose texts are needed are broadcast if there are at most
    ``few``, else joined.
    """
    dealt = classes.select("digest", "n", F.posexplode("keys").alias("band", "key"))
    dealt = cut(dealt.join(cut(dealt.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key"), "shared"), "key"), "dealt")
    needed = cut(classes.join(dealt.select("digest").distinct(), "digest", "left_semi").select("id", "digest"), "needed")
    sets = cut(_shingle_sets(texts.join(F.broadcast(needed) if needed.count() <= few else needed, "id").select("digest", "text").dropDuplicates(["digest"]), size), "sets")
    owners = sets.select("digest", F.explode("members").alias("member")).groupBy("member").agg(F.count(F.lit(1)).alias("sets"), F.min("digest").alias("digest"))
    own = owners.where("sets = 1").groupBy("digest").agg(F.count(F.lit(1)).alias("own"))
    most = F.col("n") - F.coalesce("own", F.lit(0))  # a set can have no more in common with any other
    alive = cut(dealt.join(own, "digest", "left").withColumn("most", most).where(_alike(F.col("most"), F.col("n"), F.col("most"))).select("key", "band", "digest", "n", "most"), "alive")
    centre = alive.groupBy("key").agg(F.min(F.struct((1 - F.col("most") / F.col("n")).alias("own"), "digest", "n", "most")).alias("c"), F.count(F.lit(1)).alias("size")).where("size > 1")
    dealt = cut(alive.join(cut(centre.select("key", F.col("c.digest").alias("first"), F.col("c.n").alias("first_n"), F.col("c.most").alias("first_most")), "centres"), "key"), "dealt")
    may = lambda a, b, x, y: _alike(F.least(a, b, x, y), a, b)

    def verify(pairs: DataFrame) -> DataFrame:
        sides = [sets.select(F.col("digest").alias(k), F.col("members").alias(f"m{k}")) for k in ("src", "dst")]
        both = pairs.join(sides[0], "src").join(sides[1], "dst")
        return both.where(_alike(F.size(F.array_intersect("msrc", "mdst")), F.size("msrc"), F.size("mdst"))).select("src", "dst")

    close = cut(verify(pivot_pairs(classes, block)), "close")  # fingerprints that link share a bucket, so all their sets are there
    joined = cut(connected_components(close), "joined")
    stars = dealt.where((F.col("digest") != F.col("first")) & may(F.col("n"), F.col("first_n"), F.col("most"), F.col("first_most"))).select(F.col("first").alias("src"), F.col("digest").alias("dst")).distinct()
    for end in ("src", "dst"):
        stars = stars.join(joined.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left")
    apart = F.coalesce("csrc", "src") != F.coalesce("cdst", "dst")
    near = cut(close.unionByName(verify(stars.where(apart).select("src", "dst"))), "stars")
    named = dealt.join(connected_components(near).withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    named = cut(named.select("key", "band", "digest", "n", "most", "first", "component"), "named")
    mixed = cut(named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key"), "mixed")
    rest = named.where("digest <> first").join(mixed, "key").select("key", "band", "digest", "n", "most", "component")  # the centre of a bucket has met all others
    rest = cut(rest.join(classes.select("digest", "minima", "keys"), "digest"), "rest")
    dealt = _pair_blocks(rest, "key", "digest", block).select("block", "side", "digest", "n", "most", "component", "minima", "band", "keys")
    across = dealt.mapInArrow(_near_minima, "src long, dst long").distinct()
    return near.unionByName(cut(verify(across), "across"))


def keep_one_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WIDE, block: int = BLOCK) -> DataFrame:
    """One row of each component of rows whose shingle sets have the Jaccard similarity ``SIMILAR`` or more, as :func:`keep_one` chooses it.

    Texts without words (null, empty, white space) are alike; a text of fewer than
    ``size`` words is one shingle. Whole texts are read, however long. Rows that
    repeat each other, in all columns or in some, are near duplicates, so one stays.
    """
    keyed = _named_rows(docs, id_col, text_col)
    found = cut(sketches(keyed, size), "sketches")
    classes = cut(found.groupBy("digest").agg(F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("minima").alias("minima"), F.min("id").alias("id")), "classes")
    label = connected_components(similar_links(classes, keyed, size, block)).withColumnRenamed("node", "digest")
    named = found.select("id", "digest").join(label, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    return _first_rows(docs, id_col, named)
