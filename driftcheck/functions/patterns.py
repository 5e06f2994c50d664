"""What a rule's regular expression can reach: the line breaks that a match may span, and a text that every match holds."""

from __future__ import annotations

import math
import re
import warnings
from re import _constants as K
from re import _parser
from typing import NamedTuple

NEWLINE = 10
#: Shorter texts say too little to look for.
LEAST_LITERAL = 3
#: Letters beyond ASCII that a case-insensitive search takes for ASCII ones.
FOLDED = {0x130: "i", 0x131: "i", 0x212A: "k", 0x17F: "s"}

_REPEATS = (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT)
_ANCHORS = (K.AT_BEGINNING, K.AT_BEGINNING_STRING, K.AT_END, K.AT_END_STRING)
_WITH_BREAK = (K.CATEGORY_SPACE, K.CATEGORY_NOT_DIGIT, K.CATEGORY_NOT_WORD)


class Shape(NamedTuple):
    """``breaks``: the most line breaks in a match (may be infinite); ``special``: what a
    match is also depends on the text around it; ``literal``: ASCII text, lower-cased, that every match holds, or None."""

    breaks: float
    special: bool
    literal: str | None


def fold(text: str) -> str:
    """Text in which a literal of :class:`Shape` is found wherever a case-insensitive search finds it."""
    return text.translate(FOLDED).lower() if not text.isascii() else text.lower()


def shape(pattern: str) -> Shape:
    """The shape of a Python pattern; one that cannot be parsed depends on everything."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = _parser.parse(pattern, re.IGNORECASE)
    except (re.error, OverflowError, RecursionError):
        return Shape(math.inf, True, None)
    flags = tree.state.flags
    breaks, special = _reach(tree, flags)
    return Shape(breaks, special, max(_literals(tree), key=len, default=None))


def _in_class(items) -> bool:
    """Whether a character class holds the line break."""
    held = False
    for op, arg in items:
        if op is K.LITERAL:
            held |= arg == NEWLINE
        elif op is K.RANGE:
            held |= arg[0] <= NEWLINE <= arg[1]
        elif op is K.CATEGORY:
            held |= arg in _WITH_BREAK
    return held != (items[0][0] is K.NEGATE)


def _reach(tree, flags: int) -> tuple[float, bool]:
    breaks, special = 0.0, False
    for op, arg in tree:
        more, odd = 0.0, False
        if op is K.LITERAL:
            more = arg == NEWLINE
        elif op is K.NOT_LITERAL:
            more = arg != NEWLINE
        elif op is K.ANY:
            more = bool(flags & re.DOTALL)
        elif op is K.IN:
            more = _in_class(arg)
        elif op is K.BRANCH:
            parts = [_reach(p, flags) for p in arg[1]]
            more, odd = max(p[0] for p in parts), any(p[1] for p in parts)
        elif op is K.SUBPATTERN:
            _, add, drop, p = arg
            more, odd = _reach(p, (flags | add) & ~drop)
        elif op is K.ATOMIC_GROUP:
            more, odd = _reach(arg, flags)
        elif op in _REPEATS:
            _, most, p = arg
            more, odd = _reach(p, flags)
            more = 0 if not more else math.inf if most is K.MAXREPEAT else more * most
        elif op is K.AT:
            odd = arg in _ANCHORS and not (flags & re.MULTILINE and arg in (K.AT_BEGINNING, K.AT_END)) or arg not in (*_ANCHORS, K.AT_BOUNDARY)
        elif op is not K.GROUPREF:
            more, odd = math.inf, True
        else:
            more = math.inf if breaks else 0  # repeats what a group matched
        breaks, special = breaks + more, special or odd
    return breaks, special


def _literals(tree) -> list[str]:
    """Runs of ASCII text that each match of ``tree`` holds."""
    found, run = [], ""
    for op, arg in tree:
        if op is K.LITERAL and 32 <= arg < 127:
            run += chr(arg).lower()
            continue
        found.append(run)
        run = ""
        if op is K.SUBPATTERN:
            found += _literals(arg[3])
        elif op is K.ATOMIC_GROUP:
            found += _literals(arg)
        elif op in _REPEATS and arg[0] > 0:
            found += _literals(arg[2])
    return [x for x in [*found, run] if len(x) >= LEAST_LITERAL]
