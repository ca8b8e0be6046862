import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lineloom.llm import packing as P
from lineloom.llm.queries import QUERIES, tokenizer_path

FILE = tokenizer_path("LINELOOM_WORD_TOKENIZER", "word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def texts():
    rng = random.Random(8)
    bits = ["word", "Word,", "Été", "don't", "USA's", " ", "\n", "\t", " ", "12345", "a1b2", "!?", "end.", "<|endoftext|>", "<|startoftext|>x", "日本", " ", "á", "́", "İ", "ΑΣ", "\x1c", "\x00", "'s", "🙂"]
    return ["", None, " ", "a", "A.", "x" * 5000, "long " * 9000] + ["".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 60))) for _ in range(400)]


def test_encoder_agrees_with_the_library(library):
    e = P.Encoder(FILE)
    assert e.cuts
    given = [t or "" for t in texts()]
    for _ in range(2):  # the second time words are known
        for t, raw in zip(given, e.encode([t.encode() for t in given]), strict=True):
            assert np.frombuffer(raw, f"<u{e.width}").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


LETTERS = [chr(c) for c in [*range(33, 60), *range(61, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]] + list("Œœ¡«»¿–—‘’“”…")


def test_latin_words_are_cut_before_the_library(library, monkeypatch):
    """Words with accents, apostrophes or Latin punctuation don't go through the file's rules one by one."""
    rng, e = random.Random(3), P.Encoder(FILE)
    given = ["Été, été! ÉTÉ", "don't Don'T l'été's", "¿Qué? Straße œuvre", "", "  "] + [" ".join("".join(rng.choices(LETTERS, k=rng.randint(1, 9))) for _ in range(30)) for _ in range(300)]
    monkeypatch.setattr(e, "_raw", lambda texts: [pytest.fail(f"{t!r} went to the library as it is") for t in texts])
    for t, raw in zip(given, e.encode([t.encode() for t in given]), strict=True):
        assert np.frombuffer(raw, f"<u{e.width}").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_parts_are_asked_for_once(monkeypatch):
    e, asked = P.Encoder(FILE), []
    parts = e._parts
    monkeypatch.setattr(e, "_parts", lambda new: asked.extend(new) or parts(new))
    assert e.encode(["Été, été! word".encode(), "ÉTÉ word-word".encode()]) and e.encode(["Word. été".encode()])
    assert sorted(asked) == ["!", ",", "-", ".", "word", "été"]


def test_other_words_are_asked_for_once(library, monkeypatch):
    e, asked = P.Encoder(FILE), []
    raw = e._raw
    monkeypatch.setattr(e, "_raw", lambda texts: asked.extend(texts) or raw(texts))
    for _ in range(2):
        assert np.frombuffer(e.encode(["слово a слово <b>".encode()])[0], "<u2").tolist() == library.encode("слово a слово <b>", add_special_tokens=False).ids
    assert sorted(asked) == ["<b>", "слово"]


@pytest.mark.parametrize("given", [["日本 <b>"], ["日本", "<|endoftext|>", ""], [""], [" \n "], ["", "a", ""], []])
def test_words_of_one_kind_and_none(library, given):
    got = P.Encoder(FILE).encode([t.encode() for t in given])
    assert [np.frombuffer(raw, "<u2").tolist() for raw in got] == [library.encode(t, add_special_tokens=False).ids for t in given]


def test_encoder_of_another_file_gets_whole_texts():
    e, plain = P.Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    assert not e.cuts
    assert np.frombuffer(e.encode([b" two  words"])[0], f"<u{e.width}").tolist() == plain.encode(" two  words", add_special_tokens=False).ids


def held(rows, want, window):
    """Every id in one piece, sequences gapless, none over the window, padding only where a size is no power of two."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert docs.keys() == want.keys()
    for i, pieces in docs.items():
        ids, at = want[i], 0
        for start, length, crc, n in sorted(pieces):
            assert start == at and n == len(ids) and crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    return len(sequences), sum(map(len, sequences.values()))


@pytest.mark.parametrize("window", [64, 2048])
def test_pieces(spark, library, window):
    from pyspark.sql import functions as F

    rows = [(i - 30, t, 1, "x", 2, "y") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, ids string, row int, file string").repartition(3)
    got = P.pack(df, FILE, window=window).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset").collect()
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    sequences, _ = held(got, want, window)
    tokens = sum(map(len, want.values()))
    assert sequences <= tokens // window + (tokens % window).bit_count()


def test_repeated_and_null_ids_and_empty_tables(spark):
    rows = [(None, "a b"), (None, "a b"), (7, "c"), (7, "c"), (7, None)]
    got = P.pack(spark.createDataFrame(rows, "doc_id long, text string"), FILE).collect()
    assert Counter((r.doc_id, r.length, r.doc_tokens) for r in got if r.length == r.doc_tokens) + Counter() <= Counter({(None, 3, 3): 2, (7, 2, 2): 2, (7, 1, 1): 1})
    assert sum(r.length for r in got) == 11 and {r.sequence_id for r in got if r.offset == 0} == {r.sequence_id for r in got}
    assert P.pack(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_rank_once(seed):
    rng, window = np.random.default_rng(seed), 256
    hist = np.zeros(window, np.int64)
    kinds = [rng.integers(1, window, 40), np.arange(1, 12), np.array([1]), np.array([255, 254]), rng.integers(100, 200, 30), np.arange(1, window)]
    hist[kinds[seed]] = rng.integers(1, [50, 5000, 100000, 77, 3, 400][seed], len(kinds[seed]))
    plan = P.make_plan(hist, window)
    tokens, full, pieces = int((np.arange(window) * hist).sum()), defaultdict(int), defaultdict(list)
    for length, start, lo, hi, size, sequence, offset in plan.lines:
        pieces[length].append((start, lo, hi, size))
        full[sequence, hi - lo] += 0
    assert sum((hi - lo) * size for own in pieces.values() for _, lo, hi, size in own) == tokens
    for length, own in pieces.items():
        covered = np.zeros(hist[length], np.int64)
        for start, lo, hi, size in sorted(own):
            assert (covered[lo:hi] == start).all()
            covered[lo:hi] += size
        assert (covered == length).all()
    used = np.zeros(plan.sequences, np.int64)
    for _, _, lo, hi, size, sequence, offset in plan.lines:
        used[sequence : sequence + hi - lo] += size
    short = used[used < window]
    assert (used <= window).all() and len(short) == (tokens % window).bit_count() and all(int(x).bit_count() == 1 for x in short)
    cut = sum(hi - lo for _, start, lo, hi, *_ in plan.lines if start)
    assert cut <= plan.sequences - plan.solved  # one document a sequence of the greedy part


def test_least_squares_uses_the_histogram():
    """Where combinations fill windows exactly, the solver finds them and nothing is cut."""
    hist = np.zeros(2048, np.int64)
    hist[[1000, 1048, 500, 700, 848]] = [300, 300, 90, 90, 90]
    lengths, times = P.combinations(hist, 2048)
    x = P.solve(lengths, times, hist)
    assert (x >= 0).all()
    made = np.zeros(2048)
    np.add.at(made, lengths.ravel(), (times * x[:, None]).ravel())
    assert np.abs(made - hist).max() < 1
    plan = P.make_plan(hist)
    assert plan.solved == plan.sequences == 390 and not any(line[1] for line in plan.lines)


def test_query(spark, library):
    at = "/root/testdata/sf0.001"
    want = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in spark.read.parquet(f"{at}/documents.parquet").collect()}
    sequences, pieces = held(QUERIES["op11_packing"](spark, at).collect(), want, 2048)
    assert pieces < len(want) + sequences + 20
