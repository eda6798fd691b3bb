"""Weighted pattern classification: Column to Column, without a shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .regex import bound, folded, hits, hits_in, java, needed, strip
from .text import filled

HEAD, WINDOW = 400, 3000
Rules = list[tuple[str, int, list[tuple[str, str, int]]]]


def windows(text: Column, size: int = WINDOW) -> Column:
    """Overlapping stretches, each half a window after the last, up to the end of the text."""
    step = size // 2
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * step + 1, F.lit(size)))


def _type_score(text: Column, least: int, signals: list[tuple[str, str, int]], can: list[Column], bonus: Column) -> Column:
    head = F.substring(text, 1, HEAD)
    # The head is only looked at where the whole was hit.
    parts = [F.when(c & hits(text, p, f), F.when(bonus & hits(head, p, f), 2 * w).otherwise(w)).otherwise(0) for (p, f, w), c in zip(signals, can)]
    return bound(reduce(lambda a, b: a + b, parts), lambda total: F.when(total >= least, total).otherwise(0))


def _possible(low: Column, rules: Rules) -> list[list[Column]]:
    """For each rule's signals whether folded text can hold a match."""
    return [[F.lit(True) if (can := needed(low, p)) is None else can for p, _, _ in signals] for _, _, signals in rules]


def type_scores(text: Column, bonus: Column | None = None, rules: Rules = V.PIECE_RULES, whole: Column | None = None, part: Column | None = None) -> Column:
    """array<int> in rule order: the weights of the signals that hit, those in the head twice under a
    bonus; zero below the type's least score.

    whole has for each signal whether a text that this one is cut from can hold a match; where part is false, that
    is all of this one."""
    more = F.lit(True) if bonus is None else bonus

    def scores(low: Column) -> Column:
        can = _possible(low, rules)
        if whole is not None:
            at = iter(range(sum(map(len, can))))
            can = [[F.get(whole, F.lit(next(at))) & (~part | c) for c in each] for each in can]
        return F.array(*[_type_score(text, least, signals, each, more) for (_, least, signals), each in zip(rules, can)])

    return bound(folded(text), scores)


def confidence(best: Column, second: Column) -> Column:
    margin = F.when(second <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least((best - second) / F.greatest(best, F.lit(1)), F.lit(1.0))))
    return F.when(best <= 0, F.lit(0.0)).otherwise(F.round(F.lit(0.65) * F.least(best / 30.0, F.lit(1.0)) + F.lit(0.35) * margin, 3))


def _ranked(scores: Column, firsts: Column) -> Column:
    """Types that scored, best first: by score, then the window that first had it, then rule order."""
    rows = F.transform(F.arrays_zip(scores.alias("s"), firsts.alias("w")), lambda x, i: F.struct((-x["s"]).alias("s"), x["w"].alias("w"), i.alias("i")))
    return F.array_sort(F.filter(rows, lambda x: x["s"] < 0))


def classify(text: Column, rules: Rules = V.PIECE_RULES, size: int = WINDOW, many: bool = True, least: int = 0) -> Column:
    """struct<tipo, score, confianca> of a text.

    A short text is scored at once. A long one sums the scores of its windows, the first with the head
    bonus and a weight of 1.5; where no window has a type, twice the window from the start is tried.
    """
    # As a lambda variable the text is worked out once, however often the rules look at it.
    return F.transform(F.array(filled(text)), lambda t: _classified(t, rules, size, many, least))[0]


def _classified(text: Column, rules: Rules, size: int, many: bool, least: int) -> Column:
    # What the whole text cannot hold is not looked for in its windows.
    whole = bound(folded(text), lambda low: F.array(*[c for each in _possible(low, rules) for c in each]))
    return bound(F.struct(whole.alias("whole"), ((F.length(text) > size) & F.lit(many)).alias("long")), lambda x: _told(text, rules, size, least, x["whole"], x["long"]))


def _told(text: Column, rules: Rules, size: int, least: int, whole: Column, long: Column) -> Column:
    parts = F.when(long, windows(text, size)).otherwise(F.array(F.substring(text, 1, size)))
    scored = F.transform(parts, lambda w, i: F.struct(i.alias("i"), type_scores(w, i == 0, rules, whole, long).alias("s")))
    start = F.struct(F.array_repeat(F.lit(0.0), len(rules)).alias("s"), F.array_repeat(F.lit(2**31 - 1), len(rules)).alias("w"))
    summed = F.aggregate(
        scored,
        start,
        lambda a, x: F.struct(
            F.zip_with(a["s"], x["s"], lambda p, q: p + q * F.when(long & (x["i"] == 0), 1.5).otherwise(1.0)).alias("s"),
            F.zip_with(a["w"], x["s"], lambda p, q: F.when(q > 0, F.least(p, x["i"])).otherwise(p)).alias("w"),
        ),
    )
    found = bound(summed, lambda x: _ranked(x["s"], x["w"]))
    # Only worked out where no window of a long text has a type.
    wide = type_scores(F.substring(text, 1, 2 * size), None, rules, whole, long).cast("array<double>")
    wide = _ranked(wide, F.array_repeat(F.lit(0), len(rules)))
    best = bound(found, lambda r: F.when((F.size(r) > 0) | ~long, r).otherwise(wide))
    names = F.array(*[F.lit(n) for n, _, _ in rules])

    def told(r: Column) -> Column:
        top = F.bround(-F.get(r, F.lit(0))["s"]).cast("int")
        second = F.coalesce(F.bround(-F.get(r, F.lit(1))["s"]).cast("int"), F.lit(0))
        kind = F.element_at(names, F.get(r, F.lit(0))["i"] + 1)
        kind = F.when(F.lit(least > 0) & (top < least), "DOC").otherwise(kind)
        return F.when(F.size(r) == 0, F.struct(F.lit("DOC").alias("tipo"), F.lit(0).alias("score"), F.lit(0.0).alias("confianca"))).otherwise(
            F.struct(kind.alias("tipo"), top.alias("score"), confidence(top, second).alias("confianca"))
        )

    # One lambda variable, so that the ranking is worked out once.
    return F.transform(F.array(best), told)[0]


def accepted_type(piece: Column) -> Column:
    """DOC instead of a full piece below a confidence of 0.3."""
    return F.when((piece["confianca"] < 0.3) & piece["tipo"].isin(V.FULL_PIECES), F.lit("DOC")).otherwise(piece["tipo"])


def cover_score(text: Column) -> Column:
    score = lambda t, low: reduce(lambda a, b: a + b, [F.when(hits_in(t, low, p, f), w).otherwise(0) for p, f, w in V.COVER_SIGNALS])
    return bound(filled(text), lambda t: bound(folded(t), lambda low: score(t, low)))


def cover(text: Column) -> Column:
    """struct<score, is_cover, grey>: five and more is a cover, three and four are grey."""
    return F.transform(F.array(cover_score(text)), lambda s: F.struct(s.alias("score"), (s >= 5).alias("is_cover"), ((s >= 3) & (s < 5)).alias("grey")))[0]


def _first_of(cases: list[tuple[Column, object]], other: Column) -> Column:
    return reduce(lambda acc, c: F.when(c[0], F.lit(c[1])).otherwise(acc), reversed(cases), other)


def class_route(case_class: Column, subject: Column) -> Column:
    """The prompt of a case class by the first pattern found in class and subject."""
    t = F.concat(filled(case_class), F.lit(" "), filled(subject))
    return bound(t, lambda t: _first_of([(hits(t, p, f), k) for p, f, k in V.CLASS_ROUTES], F.lit("outros")))


def class_code(case_class: Column) -> Column:
    """The code of a case class: its first name that holds the class or is held by it; a blank is TCO."""
    names = [(n.lower(), code) for code, names in V.CASE_CLASSES for n in names]
    found = lambda low, c: _first_of([(low.contains(n) | F.lit(n).contains(low), code) for n, code in names], c)
    return bound(strip(filled(case_class)), lambda c: bound(F.lower(c), lambda low: found(low, c)))


def accepted_class(case_class: Column, wanted: list[str]) -> Column:
    """Whether a class holds, or is held by, a name of a wanted code or a literal."""
    if not wanted:
        return F.lit(True)
    known = {code.upper(): [n.lower() for n in names] for code, names in V.CASE_CLASSES}
    names = [n for w in wanted for n in known.get(w.upper().strip(), [w.lower()])]
    return bound(F.lower(strip(filled(case_class))), lambda low: reduce(lambda a, b: a | b, [low.contains(n) | F.lit(n).contains(low) for n in names]))


def parse_filter(given: str | list[str] | None) -> list[str]:
    """Class codes separated by commas, plus signs or blanks."""
    import re

    return [p for p in re.split(r"[,+\s]+", " ".join(given) if isinstance(given, list) else given or "") if p]


def piece_label(label: Column) -> Column:
    """The canonical label of a piece: by alias, then by name, else DOC."""
    low, up = F.lower(strip(filled(label))), F.upper(strip(filled(label)))
    alias = F.create_map(*[F.lit(x) for kv in V.PIECE_ALIASES for x in kv])
    return F.coalesce(F.get(F.array(alias[low]), F.lit(0)), F.when(up.isin(V.PIECE_LABELS), up), F.lit("DOC"))


def measures(text: Column) -> Column:
    """struct of a flag for each measure, outras, and trechos: 80 characters around each first hit."""
    return bound(filled(text), lambda t: bound(folded(t), lambda low: bound(F.array(*[hits_in(t, low, p, f) for _, p, f in V.MEASURES]), lambda flags: _measures(t, low, flags))))


def _measures(text: Column, low: Column, flags: Column) -> Column:
    snippets = []
    for k, (name, p, f) in enumerate(V.MEASURES):
        m = F.regexp_extract(text, java(p, f), 0)
        at = F.regexp_instr(text, F.lit(java(p, f)))
        begin = F.greatest(F.lit(1), at - 80)
        snippets.append(F.when(flags[k], F.struct(F.lit(name).alias("cautelar"), strip(F.substring(text, begin, at + F.length(m) + 80 - begin)).alias("trecho"))))
    return F.struct(
        *[flags[k].alias(n) for k, (n, _, _) in enumerate(V.MEASURES)],
        (~F.array_contains(flags, True) & hits_in(text, low, r"art(?:igo|\.|º)?\s*319", "i")).alias("outras"),
        F.filter(F.array(*snippets), lambda s: s.isNotNull()).alias("trechos"),
    )


def folded_act(act: Column) -> Column:
    """An act as its executor and ease look at it."""
    return F.lower(strip(filled(act)))


def executor_of(low: Column) -> Column:
    return _first_of([(low.contains(k), who) for who, keys in V.EXECUTORS for k in keys], F.lit("Verificar"))


def ease_of(low: Column) -> Column:
    return _first_of([(low.contains(k), n) for k, n in V.EASE], F.lit(3))


def executor(act: Column) -> Column:
    return bound(folded_act(act), executor_of)


def ease(act: Column) -> Column:
    return bound(folded_act(act), ease_of)


def signal_hit(text: Column, signal: str, flags: str | None = None) -> Column:
    """A pattern's match, or with flags None a plain part of the text in any case."""
    return F.lower(filled(text)).contains(signal.lower()) if flags is None else hits(filled(text), signal, flags)


