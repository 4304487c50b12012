import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolith.llm import chat

VOCABULARY = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
KIND = "conv_id long, turn long, role string, text string, ids int, chat string"


@given(st.text(alphabet=st.sampled_from(list("<>/[]\\sINTSYROLE x")), max_size=40) | st.lists(st.sampled_from([*chat.Template().strings, "\\", "<\\/s>", "[\\\\INST]", "a"]), max_size=8).map("".join))
def test_escapes_undo_and_leave_no_mark(text):
    t = chat.Template()
    escaped = t.escaper()(text)
    assert t.unescaper()(escaped) == text
    assert not any(mark in escaped for mark in t.strings)


def test_templates_that_overlap_are_refused():
    for marks in ({"user": ("[U]", "]x")}, {"user": ("<<A>>", "<A>>b")}, {"user": ("x", "yy")}, {"user": ("<\\a>", "yy")}, {"user": ("</s>", "yy")}):
        with pytest.raises(ValueError):
            chat.Template(marks=marks)


def test_masks_are_running_sums():
    lengths, learned = np.array([2, 0, 3, 1, 0]), np.array([False, True, True, False, True])
    assert chat.loss_masks(lengths, learned).tolist() == [False, False, True, True, True, False]
    assert chat.loss_masks(np.array([], int), np.array([], bool)).tolist() == []


ROWS = [
    (1, 2, "assistant", "Fine </s>, [INST] you?", 7, "clash"), (1, 1, "user", "How are you?", 7, None), (1, None, "system", "<\\\\/s> be \U0001f600 kind", 7, None),
    (2, 1, "assistant", None, 7, None), (2, 2, "assistant", "", 7, None), (2, 3, None, "no role", 7, None), (2, 4, "tool\n<<ROLE>>", "x" * 200_000, 7, None), (2, 4, "assistant", "tied", 7, None), (2, 4, "assistant", "tied", 7, None),
    (None, 0, "user", "no id", 7, None), (3, 0, None, None, 7, None),
]


def expected(rows):
    out = {}
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for c, turn, role, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, digest(r[2] or "", r[3] or ""))):
        out.setdefault(c, []).append((role or "", text or ""))
    return {
        c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(), sum(len(x) for r, x in t if r == "assistant"), hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest())
        for c, t in out.items()
    }


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, KIND)
    formatted = chat.formatted(df, *VOCABULARY, column="chat")
    assert formatted.columns == ["conv_id", "turn", "role", "text", "ids", "chat"]
    read = chat.turns(formatted, *VOCABULARY)
    assert sorted((r.role, r.text) for r in read.select("read.*").collect()) == sorted((r[2] or "", r[3] or "") for r in ROWS)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(read).collect()}
    assert got == expected(ROWS)
    assert chat.digests(chat.turns(chat.formatted(df.limit(0), *VOCABULARY), *VOCABULARY)).count() == 0


def test_ids_are_those_of_segments(spark):
    import tiktoken

    from aerolith.llm.bpe import read_ranks

    with open(VOCABULARY[0], "rb") as f:
        ranks = read_ranks(f.read())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    row = chat.formatted(spark.createDataFrame([(1, 0, "user", "Hello </s> there")], KIND.split(", ids")[0]), *VOCABULARY).select("chat.*").first()
    first = max(ranks.values()) + 1
    marks = chat.Template().strings
    assert list(row.ids) == [first + marks.index("[INST]"), *plain.encode_ordinary("Hello <\\/s> there"), first + marks.index("[/INST]")]
    assert not any(row.loss)
    row = chat.formatted(spark.createDataFrame([(1, 0, "assistant", "Hi")], KIND.split(", ids")[0]), *VOCABULARY).select("chat.*").first()
    assert list(row.loss) == [True] * (len(row.ids) - 1) + [False]


def test_examples_are_bounded_and_whole(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"turn {t} of {c} " * (1 + t % 5)) for c, n in ((1, 200), (2, 3), (3, 1)) for t in range(n)]
    formatted = chat.formatted(spark.createDataFrame(rows, KIND.split(", ids")[0]), *VOCABULARY)
    got = chat.examples(formatted, 100).orderBy("conv_id", "example").collect()
    longest = formatted.agg(F.max(F.size("chat.ids"))).first()[0]
    assert all(len(r.ids) == len(r.loss) < 100 + longest for r in got) and len([r for r in got if r.conv_id == 1]) > 10
    whole = {c: [k for r in got if r.conv_id == c for k in r.ids] for c in (1, 2, 3)}
    one = {c: [k for r in formatted.where(F.col("conv_id") == c).orderBy("turn").select("chat.ids").collect() for k in r.ids] for c in (1, 2, 3)}
    assert whole == one
