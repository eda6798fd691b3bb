"""Patterns of the fixed values as Spark's (Java's) regular expressions."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, as the classes of `java()` have it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Letters that match an ASCII one in any case but do not become it in lower case: long s, dotless i, dotted I, Kelvin.
ODD, PLAIN = "\u017f\u0131\u0130\u212a", "siik"


def java(pattern: str, flags: str = "") -> str:
    """Unicode case and classes, line feed as the only line end, and `\\Z` as the very end."""
    return f"(?uUd{flags})" + pattern.replace("\\Z", "\\z")


def hits(text: Column, pattern: str, flags: str = "") -> Column:
    return text.rlike(java(pattern, flags))


def first(text: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    """The group of the first match, or an empty string."""
    return F.regexp_extract(text, java(pattern, flags), group)


def every(text: Column, pattern: str, flags: str = "", group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(java(pattern, flags)), F.lit(group))


def sub(text: Column, pattern: str, flags: str, put: str) -> Column:
    return F.regexp_replace(text, java(pattern, flags), put)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE))


def squeeze(text: Column) -> Column:
    return strip(sub(text, r"\s+", "", " "))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once, however often use looks at it."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def folded(text: Column) -> Column:
    """Lower case, for needed()."""
    return F.lower(F.translate(text, ODD, PLAIN))


@lru_cache(maxsize=None)
def literals(pattern: str, least: int = 3) -> tuple[str, ...]:
    """Lower-case strings of which every match holds at least one; none where the pattern has no such."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            import re._parser as parser

            tree = parser.parse(pattern)
    except Exception:  # noqa: BLE001  a pattern that only Java can read
        return ()
    return tuple(_needed(list(tree), least) or ())


@lru_cache(maxsize=None)
def parts(pattern: str, least: int = 2) -> tuple[tuple[str, ...], ...]:
    """Lots of lower-case strings; every match holds at least one of each lot. The longest come first."""
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            import re._parser as parser

            tree = parser.parse(pattern)
    except Exception:  # noqa: BLE001  a pattern that only Java can read
        return ()
    lots = dict.fromkeys(tuple(sorted(set(o))) for o in _options(list(tree), least))
    return tuple(sorted(lots, key=lambda o: -min(map(len, o))))


def _needed(items: list, least: int) -> list[str] | None:
    """Of the parts that every match has the strings whose shortest is longest."""
    return max(_options(items, least), key=lambda o: min(map(len, o)), default=None)


def _options(items: list, least: int) -> list[list[str]]:
    """The parts that every match has, each as the strings that it can be."""
    options: list[list[str]] = []
    run = ""
    for op, arg in [*items, (None, None)]:
        name = str(op)
        char = chr(arg).lower() if name == "LITERAL" else ""
        if len(char) == 1:
            run += char
            continue
        if len(run) >= least:
            options.append([run])
        run, inner = "", None
        if name == "SUBPATTERN":
            inner = _needed(list(arg[3]), least)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0]:
            inner = _needed(list(arg[2]), least)
        elif name == "BRANCH":
            each = [_needed(list(b), least) for b in arg[1]]
            inner = None if None in each else sum(each, [])
        if inner:
            options.append(inner)
    return options


def needed(low: Column, pattern: str) -> Column | None:
    """Whether folded text can hold a match at all, or None where nothing is known."""
    lots = [reduce(lambda a, b: a | b, [low.contains(x) for x in lot]) for lot in parts(pattern)]
    return reduce(lambda a, b: a & b, lots) if lots else None


def hits_in(text: Column, low: Column, pattern: str, flags: str = "") -> Column:
    """hits(), with the pattern only tried where low, the folded text, has what every match needs."""
    can = needed(low, pattern)
    return hits(text, pattern, flags) if can is None else can & hits(text, pattern, flags)
