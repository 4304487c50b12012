"""Operator 10: quality rules as a bitmask ledger.

Every rule is evaluated once for every document. The ledger keeps the measurements and one failure bit for each rule;
policies are versioned masks over these bits, and ablations are bitwise aggregations, so a policy can be changed or
weighed without another look at the texts.

Words are runs of anything but ASCII white space, counted over the whole text as UTF-8 bytes.

Defined results: a null or empty text has no words, so all its measurements are 0 and the rule too_few_words fails.
Lines are split at line feeds. Repeated rows are judged one by one; null ids pass through; extra columns are kept.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import take_over, values

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower")
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
SPACE = b" \t\n\v\f\r"
CONTINUATION = bytes(range(0x80, 0xC0))

#: Rule name -> SQL condition of failure, over the measurements. The place in the list is the bit; append only.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("capitals", "n_upper > n_lower"),
)

BIT = {name: 1 << k for k, (name, _) in enumerate(RULES)}

#: Version -> mask of the rules that reject a document.
POLICIES: dict[str, int] = {
    "base": BIT["too_few_words"] | BIT["repeated_windows"],
    "2026-1": sum(BIT.values()),
}
CURRENT = "2026-1"


def measure_text(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    words = text.split()
    n = len(words)
    stripped = text.translate(None, SPACE)
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeated = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        counts = Counter(windows)
        if len(counts) < len(windows):
            upto = 0  # words before this place are counted already
            for at, window in enumerate(windows):
                if counts[window] > 1:
                    repeated += at + 3 - max(at, upto)
                    upto = at + 3
    size = len(stripped)
    return (
        n,
        size - (0 if stripped.isascii() else size - len(stripped.translate(None, CONTINUATION))),
        size - len(stripped.translate(None, SYMBOLS)),
        lines,
        dup,
        repeated,
        size - len(stripped.translate(None, UPPER)),
        size - len(stripped.translate(None, LOWER)),
    )


def _struct(column: pa.Array) -> pa.Array:
    take_over("quality", dict)
    rows = [measure_text(x or b"") for x in values(column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()))]
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * len(MEASURES))], list(MEASURES))


def measured(text: Column) -> Column:
    """A struct of the measurements of a text column; other columns stay in the JVM."""

    @F.arrow_udf(", ".join(f"{x} long" for x in MEASURES))
    def quality_measures(column: pa.Array) -> pa.Array:
        return _struct(column)

    return quality_measures(text)


def fail_bits(prefix: str = "") -> Column:
    """The failure bits of all rules, from columns with the names of the measurements (or fields, with a prefix)."""
    bits = F.lit(0).cast("long")
    for k, (_, condition) in enumerate(RULES):
        for name in MEASURES:
            condition = condition.replace(name, f"{prefix}{name}") if prefix else condition
        bits = bits + F.when(F.expr(condition), F.lit(1 << k)).otherwise(0).cast("long")
    return bits


def ledger(docs: DataFrame, text: str = "text", column: str = "quality_ledger") -> DataFrame:
    """docs with one more column, a struct of the measurements and fail_bits. Rows, order and other columns stay."""
    inner = docs.withColumn(column, measured(F.col(f"`{text}`").cast("string")))
    fields = [F.col(f"`{column}`.{x}").alias(x) for x in MEASURES]
    return inner.withColumn(column, F.struct(*fields, fail_bits(f"`{column}`.").alias("fail_bits")))


def passes(bits: Column, policy: str = CURRENT) -> Column:
    """Whether a policy keeps a document with these failure bits."""
    return bits.bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def ablation(bits: DataFrame, column: str = "fail_bits", policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: (rule, n_failed, n_only, n_docs, any_bits): documents failing it, failing nothing else
    (which dropping the rule would keep), all documents, and the union of all bits seen. One pass over the bits."""
    mask = POLICIES[policy]
    held = [(name, 1 << k) for k, (name, _) in enumerate(RULES) if mask >> k & 1]
    col = F.col(column)
    sums = [F.count("*").alias("n_docs"), F.coalesce(F.bit_or(col), F.lit(0).cast("long")).alias("any_bits")]
    for name, bit in held:
        sums += [F.count_if(col.bitwiseAND(F.lit(bit).cast("long")) != 0).alias(f"f_{name}"), F.count_if(col.bitwiseAND(F.lit(mask).cast("long")) == bit).alias(f"o_{name}")]
    one = bits.agg(*sums)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"f_{n}").alias("n_failed"), F.col(f"o_{n}").alias("n_only")) for n, _ in held])
    return one.select(F.explode(rows).alias("r"), "n_docs", "any_bits").select("r.rule", "r.n_failed", "r.n_only", "n_docs", "any_bits")
