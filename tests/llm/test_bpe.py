import base64
import os
import random

import pytest

from cauldra.llm import bpe

needs_files = pytest.mark.skipif(not os.path.exists(bpe.VOCABULARY), reason="no vocabulary here")


def reference():
    tiktoken = pytest.importorskip("tiktoken")
    path = bpe.VOCABULARY.replace(".json", ".tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={}), list(ranks)


@needs_files
def test_ids_equal_the_library_on_random_texts():
    enc, words = reference()
    ours, r = bpe.encoder(), random.Random(4)
    for _ in range(4000):
        s = "".join(r.choice(words).decode("utf-8", "ignore") if r.random() < 0.7 else chr(r.choice([r.randrange(32, 127), r.randrange(0x4E00, 0x9FFF), r.randrange(0x400, 0x450), 0x1F375, 0x301])) for _ in range(r.randrange(1, 14)))
        assert ours.encode(s) == enc.encode_ordinary(s)


@needs_files
@pytest.mark.parametrize("s", ["", " ", "\n\n\t ", "<|endoftext|>", "a" * 50_000, "漢字" * 5_000, "🍵" * 300, "don't  stop\r\n", "\x00\x01", "é vs é"])
def test_edges(s):
    enc, _ = reference()
    assert bpe.encoder().encode(s) == enc.encode_ordinary(s)


@needs_files
def test_column(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, None, "y"), (3, "", None), (1, "hello world", "x")], "doc_id long, text string, ids string")
    got = [(r["doc_id"], r["ids"], r["n"]) for r in bpe.encode_column(df.drop("ids"), "doc_id", "text", count="n").orderBy("doc_id").collect()]
    ids = bpe.encoder().encode("hello world")
    assert got == [(1, ids, 2), (1, ids, 2), (2, [], 0), (3, [], 0)]
    # A column of the input that has the name of the result is simply not read.
    assert bpe.encode_column(df, "doc_id", "text").columns == ["doc_id", "ids"]
    assert bpe.encode_column(df.limit(0), "doc_id", "text").count() == 0
