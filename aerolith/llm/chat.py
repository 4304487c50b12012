"""Operator 11: conversations as token ids of a chat template, with a loss mask.

Assembly is by tokens: role and text of a turn are encoded by themselves, and the marks of the template are ids of their
own that are spliced in between, so that no text can make a mark and no token crosses from a text into a mark. The loss
mask follows from lengths: +1 where a segment that is to be learned begins, -1 where it ends, and the running sum.

Written out as text, a mark is a string, and texts can hold that string. Such control strings are escaped in texts: one
backslash more after their first character, whether there are some already or not. Taking one off undoes it, whatever
the text was. A template whose strings overlap, where this would not hold, is refused.

A formatted turn is a row; `examples` joins a conversation's turns to training examples of a bounded length, `turns`
reads roles and texts back from the ids, and `digests` sums a conversation up as it is read in order.

Defined results: null texts and roles are empty. Turns follow each other by turn (null first), equal ones by the digest of
role and text; repeated rows are turns of their own. Rows without conv_id are a conversation of that id. An empty table
gives an empty result. Extra columns are kept by `formatted`, a column of its output's name is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm import bpe
from aerolith.llm.common import running_sum, small_pieces, values

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Marks before and after the text of a role's turn. A turn that begins without a mark is `bare`'s; a role without
    marks of its own is spelled out between `role_marks`."""

    marks: dict[str, tuple[str, str]] = field(default_factory=lambda: {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")})
    bare: str = "assistant"
    end: str = "</s>"
    begin: str = "<s>"
    role_marks: tuple[str, str] = ("<<ROLE>>", "<</ROLE>>")
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        strings = self.strings
        for a in strings:
            if len(a) < 2 or ESCAPE in a or strings.count(a) > 1:
                raise ValueError(f"{a!r} can't be a control string")
            for b in strings:
                if any(b.startswith(a[k:]) or a[k:].startswith(b) for k in range(1, len(a))):
                    raise ValueError(f"the control strings {a!r} and {b!r} overlap")

    @property
    def strings(self) -> list[str]:
        return [self.begin, self.end, *self.role_marks, *(x for pair in self.marks.values() for x in pair)]

    def _pattern(self, marks: str) -> re.Pattern:
        escape = re.escape(ESCAPE)
        return re.compile("|".join(f"{re.escape(x[0])}{escape}{marks}{re.escape(x[1:])}" for x in self.strings))

    def escaper(self):
        found = self._pattern("*")
        return lambda text: found.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)

    def unescaper(self):
        found = self._pattern("+")
        return lambda text: found.sub(lambda m: m[0][0] + m[0][2:], text)


class _Splicer:
    """A template in the ids of a vocabulary: its marks take the first ids that are free."""

    def __init__(self, template: Template, codec: bpe.Codec):
        self.template, self.codec = template, codec
        first = len(codec.size)
        self.ids = {mark: first + k for k, mark in enumerate(template.strings)}
        self.mark = {k: mark for mark, k in self.ids.items()}
        self.first = first
        self.escape, self.unescape = template.escaper(), template.unescaper()

    def _packed(self, *marks: str) -> bytes:
        return np.array([self.ids[m] for m in marks], "<u4").tobytes()

    def segments(self, role: str, text: str) -> list[tuple[bytes, bool]]:
        """(ids, whether they are learned) of the parts of a turn."""
        t = self.template
        body = (self.codec.encode_packed(self.escape(text)), role in t.learned)
        if role == t.bare:
            return [body, (self._packed(t.end), False)]
        if role in t.marks:
            before, after = t.marks[role]
            return [(self._packed(before), False), body, (self._packed(after), False)]
        name = self.codec.encode_packed(self.escape(role))
        return [(self._packed(t.role_marks[0]), False), (name, False), (self._packed(t.role_marks[1]), False), body, (self._packed(t.end), False)]

    def read(self, ids: np.ndarray, loss: np.ndarray) -> tuple[str, str, str, int]:
        """(role, text, text under the mask, characters of the written form) of a turn."""
        t = self.template
        cuts = np.flatnonzero(ids >= self.first)
        marks = [self.mark[k] for k in ids[cuts].tolist()]
        between = [ids[a:b] for a, b in zip([0, *(cuts + 1)], [*cuts, len(ids)])]
        parts = [self.codec.decode(x.tolist()).decode() for x in between]
        if marks == [t.end]:
            role, text = t.bare, parts[0]
        elif len(marks) == 3 and (marks[0], marks[1], marks[2]) == (*t.role_marks, t.end):
            role, text = self.unescape(parts[1]), parts[2]
        else:
            role, text = next((r for r, m in t.marks.items() if marks == list(m)), None), parts[1] if len(parts) > 1 else ""
            if role is None:
                raise ValueError(f"no turn of the template: {marks[:4]}")
        under = self.codec.decode(ids[loss & (ids < self.first)].tolist()).decode()
        return role, self.unescape(text), self.unescape(under), sum(map(len, parts)) + sum(map(len, marks))


def loss_masks(lengths: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """For segments one after the other, whether each of their tokens is learned: steps at the ends of learned segments,
    summed up."""
    ends = np.cumsum(lengths)
    step = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
    np.add.at(step, (ends - lengths)[learned], 1)
    np.add.at(step, ends[learned], -1)
    return np.cumsum(step)[:-1] > 0


def turn_order(turn: str = "turn", role: str = "role", text: str = "text") -> list[Column]:
    """The order of turns; rows of the same turn by a digest, which is shorter than a text as a key."""
    return [F.col(f"`{turn}`").asc_nulls_first(), turn_digest(role, text).asc()]


def turn_digest(role: str = "role", text: str = "text") -> Column:
    """Equal for turns of equal role and text, null and empty ones the same."""
    r, t = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    return F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256)


def formatted(df: DataFrame, path: str, pattern: str, template: Template | None = None, role: str = "role", text: str = "text", column: str = "chat") -> DataFrame:
    """df with a struct of ids (array of int) and loss (array of boolean) for each turn."""
    template = template or Template()
    vocab = bpe.vocabulary(df.sparkSession, path)

    @F.arrow_udf("ids array<int>, loss array<boolean>")
    def chat_format(roles: pa.Array, texts: pa.Array) -> pa.Array:
        splicer = _Splicer(template, bpe.codec_of(vocab.value, pattern))
        parts, ends = [], [0]
        for r, t in zip(values(roles), values(texts), strict=True):
            parts += splicer.segments(r or "", t or "")
            ends.append(len(parts))
        lengths = np.array([len(x) // 4 for x, _ in parts], np.int64)
        loss = loss_masks(lengths, np.array([y for _, y in parts], bool))
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)])[ends], pa.int32())
        ids = pa.array(np.frombuffer(b"".join(x for x, _ in parts), "<i4"), pa.int32())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, pa.array(loss))], ["ids", "loss"])

    return df.withColumn(column, chat_format(F.col(f"`{role}`").cast("string"), F.col(f"`{text}`").cast("string")))


def turns(chat: DataFrame, path: str, pattern: str, template: Template | None = None, ids: str = "chat.ids", loss: str = "chat.loss", column: str = "read") -> DataFrame:
    """chat with a struct of what its ids say: role, text, learned (the text under the mask) and n_chars of the written
    form. Ids that the template can't have made are an error."""
    template = template or Template()
    vocab = bpe.vocabulary(chat.sparkSession, path)

    @F.arrow_udf("role string, text string, learned string, n_chars long")
    def chat_read(ids: pa.Array, loss: pa.Array) -> pa.Array:
        splicer = _Splicer(template, bpe.codec_of(vocab.value, pattern))
        rows = []
        for k in range(len(ids)):
            i, m = (np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in (ids[k], loss[k]))
            rows.append(splicer.read(i, m))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.StructArray.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["role", "text", "learned", "n_chars"])

    return chat.withColumn(column, chat_read(F.col(ids), F.col(loss)))


def examples(chat: DataFrame, max_tokens: int, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", ids: str = "chat.ids", loss: str = "chat.loss") -> DataFrame:
    """Training examples: (conv, example, ids, loss). A conversation's turns follow each other; the turns that begin within
    the same max_tokens of it are one example, so no row holds more than that and one turn, however long the
    conversation is. Where turns begin comes from sums by range, not from one task for a conversation."""
    rows = chat.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), turn_digest(role, text).alias("tie"), F.col(ids).alias("ids"), F.col(loss).alias("loss"))
    placed = running_sum(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("tie")], {"at": F.size("ids").cast("long")}, "chat-turns")
    one = F.sort_array(F.collect_list(F.struct("at", "tie", "ids", "loss")))
    grouped = placed.groupBy("conv", F.floor(F.col("at") / max_tokens).alias("example")).agg(one.alias("t"))
    return grouped.select(F.col("conv").alias(conv), "example", F.flatten(F.col("t.ids")).alias("ids"), F.flatten(F.col("t.loss")).alias("loss"))


def digests(read: DataFrame, conv: str = "conv_id", turn: str = "turn", column: str = "read") -> DataFrame:
    """For each conversation, from turns that were read back: n_turns, turns_sha256 (over role, line feed, text, line feed),
    loss_chars, loss_sha256 and formatted_chars. A digest is taken in order, so a conversation's turns pass by one task,
    one after the other; only sums are held."""
    rows = read.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(column).alias("r")).select("conv", "turn", "r.*")
    rows = rows.withColumn("tie", turn_digest())
    kind = rows.schema["conv"].dataType.simpleString()
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = f"`{conv}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out, conv_type = None, None, [], None

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 6
            out.clear()
            kinds = (conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)

        def close() -> None:
            n, all_turns, chars, loss, total = state
            out.append((key, n, all_turns.hexdigest(), chars, loss.hexdigest(), total))

        for batch in small_pieces(batches):
            conv_type = batch.schema.field("conv").type
            for c, role, text, learned, n in zip(*(batch.column(x).to_pylist() for x in ("conv", "role", "text", "learned", "n_chars")), strict=True):
                if state is None or c != key:
                    if state is not None:
                        close()
                    key, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += n
            if len(out) > 10_000:
                yield batch_of()
        if state is not None:
            close()
        if out:
            yield batch_of()

    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "tie")
    return ordered.mapInArrow(summed, schema)
