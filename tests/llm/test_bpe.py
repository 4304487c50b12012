import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Row

from aerolith.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    data = open(public_tokenizers.path(request.param), "rb").read()
    ranks = bpe.read_ranks(data)
    return bpe.Codec(ranks, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_tokens_as_merging(both):
    codec, other = both
    rng = random.Random(1)
    kinds = ["abcdefgh", " \n\t", "étöñ日本語🙂", "0123456789", "!?#-_'", "theing  ", "\x00\x7f­﻿"]
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 40)))
        ids = codec.encode(text)
        assert ids == other.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3000, "ab" * 4000, "é" * 999, "thethethe" * 2000, "=-" * 3000, "", "<|endoftext|>"])
def test_long_pieces_and_special_strings(both, text):
    codec, other = both
    assert codec.encode(text) == other.encode_ordinary(text)


def test_small_memory_gives_the_same(both, monkeypatch):
    codec, other = both
    monkeypatch.setattr(bpe, "MOST_REMEMBERED", 6)
    text = " ".join(f"word{k % 11} thing{k % 7}" for k in range(200))
    assert codec.encode(text) == other.encode_ordinary(text)


def test_frames(spark):
    rows = [(1, "Hello world"), (2, None), (2, ""), (None, "Größe 日本"), (1, "Hello world")]
    df = spark.createDataFrame([Row(doc_id=i, text=t, bpe="clash", token_ids=1) for i, t in rows], "doc_id long, text string, bpe string, token_ids int")
    back = bpe.decode(bpe.encode(df, PATH, PATTERN), PATH, PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in rows)
    digests = bpe.round_trip_digests(df, PATH, PATTERN).collect()
    assert sorted(r.bpe.decoded_sha256 for r in digests) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows)
    assert bpe.round_trip_digests(df.where("false"), PATH, PATTERN).count() == 0


def test_refuses_what_it_cannot_hold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_VOCABULARY_BYTES", 10)
    (tmp_path / "v").write_bytes(b"x" * 11)
    with pytest.raises(ValueError):
        bpe.vocabulary(spark, str(tmp_path / "v"))
