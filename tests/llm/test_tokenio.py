import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from lineloom.llm import tokenio as T
from lineloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def texts():
    rng = random.Random(8)
    bits = ["word", "Été", "don't", " ", "  ", "\n", "\n\n", "\t", " \n", "\u00a0", "12345", "!?", "<|endoftext|>", "日本", "\u2028", "a\u0301", "'s", "🙂"]
    return ["", None, " ", "a", " lead", "trail ", "x" * 5000] + ["".join(rng.choice(bits) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 60))) for _ in range(400)]


def test_encoder_agrees_with_the_library(library):
    e = T.Encoder(tokenizer_path())
    for t, raw in zip(texts(), e.encode([t or "" for t in texts()]), strict=True):
        assert np.frombuffer(raw, f"<u{e.width}").tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_round_trip(spark, library):
    rows = [(i * 13 % 1009 - 20, t, 1, "x") for i, t in enumerate(texts())] + [(None, "no id", 1, "x"), (None, "none", 1, "x"), (7, "again", 1, "x"), (7, "again", 1, "x"), (7, "Again", 1, "x")]
    got = T.tokens_round_trip(spark.createDataFrame(rows, "doc_id long, text string, start int, keys string"), tokenizer_path()).collect()
    want, start = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted((i or 0, *x) for i, *x in want)


def test_empty_table(spark):
    assert T.tokens_round_trip(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 62, 20_000).astype(np.uint64)
    mph = T.PerfectHash.build(np.unique(keys))
    assert sorted(mph.rank(np.unique(keys)).tolist()) == list(range(len(np.unique(keys))))
    assert T.PerfectHash.build(np.zeros(0, np.uint64)).rank(keys[:3]).tolist() == [-1, -1, -1]


def test_lookup_refuses_unknown_keys(spark, tmp_path):
    df = spark.createDataFrame([(i * 3, f"text {i}") for i in range(200)], "doc_id long, text string")
    file = T.write_tokens(df.coalesce(1), str(tmp_path), tokenizer_path()).collect()[0].file
    shard = T.Shard(file)
    known, unknown = shard.keys, shard.keys + 1
    assert (shard.find(known) == np.arange(len(known))).all() and (shard.find(unknown) == -1).all()


def test_query_gives_special_tokens_the_ids_of_an_untouched_library(spark, tmp_path):
    from lineloom.llm.queries import QUERIES

    untouched = Tokenizer.from_file(tokenizer_path())
    rows = list(enumerate([*texts(), "end <|endoftext|> next", "a<|endoftext|>b c"]))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in QUERIES["op10_token_output"](spark, str(tmp_path)).collect()}
    ids = {i: untouched.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids.items()}
