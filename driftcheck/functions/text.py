"""Column helpers that reproduce Python text semantics with built-in functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's re.escape puts a backslash before.
PY_RE_ESCAPE_CLASS = r"([\t\n\r\x0B\f #$&()*+\-.?\[\\\]^{|}~])"

# Java inline flags that give Python ``re.search(p, s, re.IGNORECASE)`` semantics:
# case-insensitive, Unicode case folding, and only "\n" as line terminator.
PY_SEARCH_FLAGS = "(?idu)"


def py_re_escape(c: Column) -> Column:
    """``re.escape`` of a string column."""
    return F.regexp_replace(c, PY_RE_ESCAPE_CLASS, r"\\$1")


def drop_dangling_backslash(c: Column) -> Column:
    """Remove an odd trailing backslash left by cutting an escaped text."""
    return F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)\\\z", "$1")


def py_search(text: Column, pattern: str) -> Column:
    """``re.search(pattern, text, re.IGNORECASE)`` is not None, as a JVM regex test."""
    return text.rlike(PY_SEARCH_FLAGS + py_to_java_regex(pattern))


def py_truthy(s: Column) -> Column:
    """``bool(value)`` of a JSON scalar read as a string (false/0/empty/null are false)."""
    low = F.lower(F.trim(s))
    return F.coalesce(~low.isin("false", "0", "0.0", "", "null"), F.lit(False))


def py_to_java_regex(pattern: str) -> str:
    """Python-only group syntax in JVM form: ``(?P<n>`` -> ``(?<n>``, ``(?P=n)`` -> ``\\k<n>``."""
    pattern = re.sub(r"\(\?P<(\w+)>", r"(?<\1>", pattern)
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern)


def py_to_java_regex_col(pattern: Column) -> Column:
    """Column form of :func:`py_to_java_regex`."""
    p = F.regexp_replace(pattern, r"\(\?P<(\w+)>", "(?<$1>")
    return F.regexp_replace(p, r"\(\?P=(\w+)\)", "\\\\k<$1>")
