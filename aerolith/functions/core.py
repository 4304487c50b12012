"""Building blocks of the column functions.

Word boundaries: a pattern's \\b is a place between an ASCII word character and anything else, as RE2 and JavaScript see
it; Java's own boundary takes letters beyond ASCII for word characters, so `pattern` spells it out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as JavaScript sees it.
SPACE = r"[\s\x{00A0}\x{FEFF}]"
_BOUNDARY = r"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))"


def pattern(text: str, flags: str = "iu") -> str:
    """A pattern with ASCII word boundaries and the flags given (case-blind by default)."""
    return (f"(?{flags})" if flags else "") + re.sub(r"(?s)\\(.)", lambda m: _BOUNDARY if m[1] == "b" else m[0], text)


def _folds_to(letter: str) -> str:
    """The characters that a case-blind pattern takes for a letter."""
    fold = lambda x: x.upper().lower() if len(x.upper()) == 1 else x
    others = {"i": "\u0130\u0131"}.get(letter.lower(), "")
    return "".join(chr(k) for k in (*range(0x30, 0x250), 0x1E9E, 0x212A, 0x212B) if fold(chr(k)) == fold(letter)) + letter + others


def _firsts(body: str, blind: bool) -> str | None:
    """What a match of a pattern can begin with, as the inside of a character class; None where that is not plain."""
    depth, in_class, k, cuts = 0, False, 0, [-1]
    while k < len(body):
        x = body[k]
        if x == "\\":
            k += 1
        elif in_class:
            in_class = x != "]"
        elif x == "[":
            in_class = True
        elif x in "()":
            depth += 1 if x == "(" else -1
        elif x == "|" and depth == 0:
            cuts.append(k)
        k += 1
    if len(cuts) > 1:
        parts = [_firsts(body[a + 1 : b], blind) for a, b in zip(cuts, [*cuts[1:], len(body)], strict=True)]
        return None if None in parts else "".join(parts)
    body = body.removeprefix(_BOUNDARY)
    if body[:1] == "(" and (body[1:2] != "?" or body[:3] == "(?:"):
        depth, k = 0, 0
        while k < len(body):  # the group's end; patterns with parentheses in classes are left alone
            depth += {"(": 1, ")": -1}.get(body[k], 0)
            if depth == 0:
                break
            k += 2 if body[k] == "\\" else 1
        inside = body[3 if body[:3] == "(?:" else 1 : k]
        return None if body[k + 1 : k + 2] in ("?", "*", "{") or re.search(r"\[[^\]]*[()]", inside) else _firsts(inside, blind)
    one = re.match(r"([^\W_]|€)(?![?*{])", body)
    if one:
        return _folds_to(one[1]) if blind else one[1]
    some = None if blind else re.match(r"\[([A-Z0-9-]+)\](?!\?|\*|\{0)", body)
    return some[1] if some else None


def led(regex: str) -> str:
    """The same pattern with a look at the first character in front, where that can only be one of a few: a list of
    labels is then tried where one can begin, not at every character of a text."""
    flags = re.match(r"\(\?([a-z]+)\)", regex)
    body = regex[flags.end() :] if flags else regex
    if flags and "x" in flags[1]:
        return regex
    firsts = _firsts(body, bool(flags) and "i" in flags[1])
    return f"(?=[{firsts}]){flags[0] if flags else ''}(?:{body})" if firsts else regex


def found(c: Column, regex: str, group: int = 1) -> Column:
    """A group of the first match, null if there is none or the group is empty. The pattern runs once: an expression that
    names its text several times doubles with each level of nesting."""
    return given(F.regexp_extract(c, led(regex), group))


def let(value: Column, use) -> Column:
    """use(value), with the value computed once: keeps expressions small that need a value many times."""
    return F.transform(F.array(value), use)[0]


def once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """df with columns that are computed once for each row, however often they are used and whatever filters follow: a
    generator of one row stands between them and what comes after, which the optimizer does not look through. They are
    computed below the generator, in a projection, as a generator's own expressions are interpreted one by one."""
    own = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = df.select("*", F.struct(*[value.alias(name) for name, value in columns.items()]).alias("__made"))
    return made.select("*", F.explode(F.array("__made")).alias("__once")).select(*own, *[F.col(f"__once.`{name}`") for name in columns])


def chain(c: Column, *steps: tuple[str, str]) -> Column:
    """regexp_replace, one after the other."""
    for regex, by in steps:
        c = F.regexp_replace(c, led(regex), by)
    return c


def trimmed(c: Column) -> Column:
    return chain(c, (rf"^{SPACE}+|{SPACE}+$", ""))


def lowered(c: Column) -> Column:
    """c in lower case; Spark's own function is asked only where a letter may change, as it takes many times longer than
    the look."""
    return F.when(c.rlike(r"[^\x00-@\[-\x7F]"), F.lower(c)).otherwise(c)


def missing(c: Column) -> Column:
    """Null and the empty string."""
    return c.isNull() | (c.cast("string") == "")


def given(c: Column) -> Column:
    """Null for the empty string. c is named once, so that it is computed once wherever this stands."""
    return F.try_element_at(F.array_remove(F.array(c), ""), F.lit(1))


def looked_up(c: Column, values: Mapping, default=None) -> Column:
    """A value by key from a small fixed mapping."""
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    out = F.try_element_at(table, c)
    return out if default is None else F.coalesce(out, F.lit(default))


def any_of(c: Column, parts: Iterable[str]) -> Column:
    """Whether c holds any of these strings."""
    out = F.lit(False)
    for part in parts:
        out = out | c.contains(part)
    return out


def first_case(*cases: tuple[Column, object], otherwise=None) -> Column:
    """The value of the first case that holds."""
    out = None
    for condition, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
