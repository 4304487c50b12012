"""Operator 1: byte-level BPE encoding and decoding.

A text is cut into pieces by the tokenizer's pattern and each piece is encoded by itself. The bytes of a piece are
mapped to Latin-1, so that one character stands for one byte, and an Aho-Corasick automaton over the vocabulary reports
every token at every place in one scan. From the longest token at each place the encoder goes forward; where two
neighbours could not have come out of the merges it tries the next shorter token, and where none is left it steps back
and never tries that place again. So every place is given up once at most and the work is linear in the piece.

Whether two neighbours are compatible is decided by undoing merges at their seam, last merge first, and looking for one
that BPE would have done across it earlier; the answers are remembered. This gives exactly the tokens that merging by
rank gives.

Defined results: a null text is encoded as an empty one (no ids). Texts and pieces of any length are encoded whole.
Ids that are not in the vocabulary make decode() fail. Extra columns are kept; repeated rows are encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import take_over, values

#: A vocabulary file is read on the driver and broadcast; one that is larger than this is refused.
MOST_VOCABULARY_BYTES = 64 << 20
#: Encoded pieces and pair answers that a worker remembers before it starts anew.
MOST_REMEMBERED = 400_000
NONE = -1


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token -> rank, from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class _Pieces(dict):
    """Piece -> its ids as little-endian 32-bit numbers; encodes what it doesn't hold. Two generations: when the young
    one is full it becomes the old one, from which pieces that are still in use come back."""

    def __init__(self, codec: Codec):
        self.codec, self.old = codec, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            found = self.codec.encode_piece(piece.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= 64:
            if len(self) >= MOST_REMEMBERED // 2:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder for one vocabulary of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.size = [0] * (max(ranks.values(), default=0) + 1)
        self.shorter = [NONE] * len(self.size)
        self.pattern = regex.compile(pattern)
        self.tokens = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.tokens.add_word(token.decode("latin-1"), (rank, len(token) - 1))
            self.size[rank] = len(token)
        self.tokens.make_automaton()
        for token, rank in ranks.items():
            cut = len(token) - 1
            while cut and token[:cut] not in ranks:
                cut -= 1
            self.shorter[rank] = ranks[token[:cut]] if cut else NONE
        self.halves: dict[int, tuple[int, int]] = {}  # of a token that merging makes: its two parts
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1 and (parts := self._last_merge(token, rank)):
                self.halves[rank] = parts
                self.merged[parts] = rank
        self.pairs.clear()
        self.pieces = _Pieces(self)

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens of lower rank that merging joins to this one: the cut whose parts are compatible."""
        ranks = self.ranks
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None and a < rank and b < rank and self._whole(token[:cut], a) and self._whole(token[cut:], b) and self._compatible(a, b):
                return a, b
        return None

    def _whole(self, token: bytes, rank: int) -> bool:
        return len(token) == 1 or rank in self.halves

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves a and b side by side."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        merged, halves = self.merged, self.halves
        limit = 1 << 62  # merges across the seam from this rank on come too late
        while True:
            joined = merged.get((a, b))
            if joined is not None and joined < limit:
                return False
            ta, tb = halves.get(a), halves.get(b)
            if ta is None and tb is None:
                return True
            # undo the later of the two tokens' merges; of equal ones the right token's came second
            if tb is None or (ta is not None and a > b):
                limit, a = a, ta[1]
            else:
                limit, b = b + 1, tb[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None and (len(piece) == 1 or whole in self.halves):
            return [whole]
        n = len(piece)
        longest = [NONE] * (n + 1)
        for end, (rank, before) in self.tokens.iter(piece.decode("latin-1")):
            longest[end - before] = rank  # ends grow, so the last one seen is the longest
        size, shorter, known, compatible = self.size, self.shorter, self.pairs.get, self.compatible
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, rank, last = 0, longest[0], NONE
        while at < n:
            while rank != NONE:
                if alive[at + size[rank]]:
                    if last == NONE:
                        break
                    fits = known(last << 32 | rank)
                    if fits or (fits is None and compatible(last, rank)):
                        break
                rank = shorter[rank]
            if rank != NONE:
                out.append(rank)
                at += size[rank]
                last, rank = rank, longest[at]
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte of the text")
                alive[at] = 0
                rank = out.pop()
                at -= size[rank]
                last = out[-1] if out else NONE
        return out

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec_of(data: bytes, pattern: str) -> Codec:
    """The codec of a vocabulary file's bytes, built once in each Python process."""
    take_over("bpe", _codecs.clear)
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(data), pattern)
    return _codecs[key]


def vocabulary(spark: SparkSession, path: str):
    """A vocabulary file of checked size, broadcast. The path need only exist on the driver."""
    with open(path, "rb") as f:
        data = f.read(MOST_VOCABULARY_BYTES + 1)
    if len(data) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def encoded(text: Column, vocab, pattern: str) -> Column:
    """array<int> of the ids of a text column."""

    @F.arrow_udf("array<int>")
    def bpe_encode(column: pa.Array) -> pa.Array:
        codec = codec_of(vocab.value, pattern)
        packed = [codec.encode_packed(x or "") for x in values(column)]
        offsets = np.cumsum([0, *(len(x) // 4 for x in packed)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))

    return bpe_encode(text)


def decoded(ids: Column, vocab, pattern: str) -> Column:
    """The bytes of an array<int> column of ids; null as no ids."""

    @F.arrow_udf("binary")
    def bpe_decode(column: pa.Array) -> pa.Array:
        codec = codec_of(vocab.value, pattern)
        return pa.array([codec.decode(x or ()) for x in values(column)], pa.binary())

    return bpe_decode(ids)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """docs with a column of token ids; one of that name is replaced."""
    return docs.withColumn(ids, encoded(F.col(f"`{text}`").cast("string"), vocabulary(docs.sparkSession, path), pattern))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """df with a column of the bytes that its ids stand for; one of that name is replaced."""
    return df.withColumn(out, decoded(F.col(f"`{ids}`"), vocabulary(df.sparkSession, path), pattern))


def round_trip_digests(docs: DataFrame, path: str, pattern: str, text: str = "text", column: str = "bpe") -> DataFrame:
    """docs with a struct of n_tokens, ids_sha256 and decoded_sha256: each text is encoded, its ids are decoded, and
    only digests leave the worker, so that ids of long texts never fill a batch."""
    vocab = vocabulary(docs.sparkSession, path)

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def bpe_digests(column: pa.Array) -> pa.Array:
        codec = codec_of(vocab.value, pattern)
        n, ids, back = [], [], []
        for x in values(column):
            packed = codec.encode_packed(x or "")
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            back.append(hashlib.sha256(codec.decode(np.frombuffer(packed, "<u4").tolist())).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.withColumn(column, bpe_digests(F.col(f"`{text}`").cast("string")))
