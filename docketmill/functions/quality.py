"""How readable a text is: Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V
from .regex import strip
from .text import filled

# Thresholds of poor text.
MIN_LENGTH, MAX_CORRUPT, MIN_VALID, MIN_WORDS = 80, 0.02, 0.55, 15
REAL_WORD = "^[A-Za-záéíóúâêôãõçÁÉÍÓÚÂÊÔÃÕÇ]{3,}$"


def _share(text: Column, pattern: str) -> Column:
    n = F.length(text)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.regexp_count(text, F.lit(pattern)) / n)


def corrupt_density(text: Column) -> Column:
    return _share(filled(text), V.CORRUPT_CHARS)


def valid_ratio(text: Column) -> Column:
    return _share(filled(text), V.VALID_CHARS)


def _words(text: Column) -> Column:
    return F.split(text, r"(?U)\s+")


def real_words(text: Column) -> Column:
    return F.size(F.filter(_words(filled(text)), lambda w: w.rlike(REAL_WORD)))


def poor_text(text: Column, least: int = MIN_LENGTH) -> Column:
    """struct<poor, reason>: short, corrupt, invalid or wordless, in this order."""
    t = strip(filled(text))
    reason = (
        F.when(F.length(t) < least, "short")
        .when(corrupt_density(t) > MAX_CORRUPT, "corrupt")
        .when(valid_ratio(t) < MIN_VALID, "invalid")
        .when(real_words(t) < MIN_WORDS, "few words")
    )
    return F.struct(reason.isNotNull().alias("poor"), F.coalesce(reason, F.lit("")).alias("reason"))


def ocr_quality(text: Column) -> Column:
    t = strip(filled(text))
    words = F.size(F.filter(_words(t), lambda w: F.length(w) >= 3))
    return F.when(F.length(t) == 0, F.lit(0.0)).otherwise(valid_ratio(t) - corrupt_density(t) * 5 + F.least(words / 200.0, F.lit(1.0)))


def better_text(a: Column, b: Column) -> Column:
    """The text of the higher quality and length; blanks lose, ties go to the first."""
    a, b = strip(filled(a)), strip(filled(b))
    worth = lambda t: ocr_quality(t) + F.least(F.length(t) / 1000.0, F.lit(5.0))
    return F.when(a == "", b).when(b == "", a).when(worth(a) >= worth(b), a).otherwise(b)


def result_ratios(before: Column, after: Column) -> Column:
    """struct<tokens, reduction>: a quarter of the length, and the share removed in percent."""
    n, m = F.length(filled(before)), F.length(filled(after))
    return F.struct(F.floor(m / 4).cast("int").alias("tokens"), F.when(n == 0, F.lit(0.0)).otherwise((1 - m / n) * 100).alias("reduction"))
