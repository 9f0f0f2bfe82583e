"""Text splitting with the semantics of Java's ``String.split(sep)``.

Java drops *trailing* empty strings, keeps leading and inner ones, and
returns the input itself when the separator never occurs, so ``""``
gives one empty word. Spark's ``split`` keeps trailing empties, hence
the rewrite below. All of it stays a JVM expression (no UDF).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_split(col: str | Column, sep: str = ",") -> Column:
    """``array<string>`` equal to Java ``col.split(sep)`` for a literal ``sep``.

    ``""`` -> ``[""]``; ``","`` -> ``[]``; ``",a"`` -> ``["", "a"]``;
    ``"a,,b"`` -> ``["a", "", "b"]``; ``"a,"`` -> ``["a"]``.
    """
    c = _c(col)
    return split_trimmed(c, strip_trailing(c, sep), sep)


def strip_trailing(col: str | Column, sep: str = ",") -> Column:
    """``col`` without its trailing run of ``sep`` (first half of ``java_split``)."""
    if len(sep) == 1:
        return F.rtrim(_c(col), F.lit(sep))     # looks at the end only
    return F.regexp_replace(_c(col), f"(?:{re.escape(sep)})+\\z", "")


def split_trimmed(col: str | Column, trimmed: str | Column, sep: str = ",") -> Column:
    """Second half of ``java_split`` given ``strip_trailing(col)``; lets a caller
    compute the regex once in a projection before an ``explode``."""
    c, t = _c(col), _c(trimmed)
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(t == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(t, re.escape(sep))))


def text_lines(col: str | Column) -> Column:
    """Lines of a text the way a line reader yields them.

    Split on ``\\n`` or ``\\r\\n``; a final line end closes the last line rather
    than starting an empty one, and an empty text has no lines. A text without
    ``\\r\\n`` is split on the one character, which needs no pattern matching.
    """
    c = _c(col)
    plain = F.split(c, "\n")
    closed = F.when(c.endswith("\n"), F.slice(plain, F.lit(1), F.size(plain) - 1)).otherwise(plain)
    mixed = F.split(F.regexp_replace(c, "\r?\n\\z", ""), "\r?\n")
    return (F.when(c == F.lit(""), F.array().cast("array<string>"))
            .when(c.contains("\r\n"), mixed)
            .otherwise(closed))
