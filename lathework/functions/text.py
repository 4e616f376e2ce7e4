"""String and token columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column, keep_empty: bool = False) -> Column:
    """Tokens between runs of whitespace. ``keep_empty`` keeps the empty token in front of leading blanks."""
    parts = F.split(text, r"\s+")
    return parts if keep_empty else F.array_remove(parts, "")


def plain_words(line: Column) -> Column:
    """Lower-case alphanumeric tokens; ``.``, ``!``, ``?`` and whitespace separate, other characters vanish.

    The characters are stripped from the whole line before it is split, which gives the same
    tokens as cleaning each one and keeps the expression inside generated code.
    """
    kept = F.regexp_replace(F.lower(line), r"[^a-z0-9.!?\s]", "")
    return F.array_remove(F.split(kept, r"[.!?\s]+"), "")


def neighbours(tokens: Column) -> Column:
    """Array of (``first``, ``second``) for each adjacent pair of tokens."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(tokens, F.lit(1), pairs).alias("first"), F.slice(tokens, F.lit(2), pairs).alias("second")
    )


def mentioned(text: Column, terms: Sequence[str]) -> Column:
    """The ``terms`` that occur in ``text`` as whole blank-separated tokens, each once."""
    return F.array_intersect(F.array(*[F.lit(t) for t in terms]), F.split(text, " "))


def before_last(text: Column, delimiter: str) -> Column:
    """``text`` up to the last ``delimiter``; null where there is none."""
    tail = F.substring_index(text, delimiter, -1)
    return F.when(F.contains(text, F.lit(delimiter)), F.substring(text, F.lit(1), F.length(text) - F.length(tail) - len(delimiter)))


def field(text: Column, separator: str, index: int) -> Column:
    """The ``index``-th field (0 first) of ``text`` split on the regex ``separator``; null past the end."""
    return F.get(F.split(text, separator), F.lit(index))


def phone_shaped(text: Column) -> Column:
    """First dash in fourth place and last dash in eighth, as in ``239-663-0109``."""
    last_dash = F.length(text) - F.length(F.substring_index(text, "-", -1))
    return (F.instr(text, "-") == 4) & (last_dash == 8)


def matches(text: Column, pattern: str) -> Column:
    """Whole-string, case-sensitive regex match; a pattern without regex characters is an equality, which scans can take."""
    if not re.search(r"[\\^$.|?*+()\[\]{}]", pattern):
        return text == pattern
    return text.rlike(f"^(?:{pattern})$")
