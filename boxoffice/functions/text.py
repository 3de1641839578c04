"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(c: Column) -> Column:
    """Capitalise every maximal run of letters.

    Differs from ``initcap``, which only looks at spaces: ``10km`` becomes ``10Km``.
    """
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def replace_text(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def code_label(c: Column) -> Column:
    """``credit_card`` as ``CREDIT CARD``."""
    return F.upper(replace_text(c, "_", " "))


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """The captured group, or null where the pattern does not occur."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def contains_any_case(c: Column, part: str) -> Column:
    return F.lower(c).contains(part.lower())


def lacks_words(c: Column, *words: str) -> Column:
    """True where the lowercased text holds none of the words; null text gives null."""
    checks = [~F.lower(c).like(f"%{w}%") for w in words]
    out = checks[0]
    for check in checks[1:]:
        out = out & check
    return out
