"""Text measures, votes and labels as column expressions; every list and threshold is the caller's."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of Vietnamese beyond Latin-1.
VIETNAMESE = "ăđĩũơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ"


#: Latin letters with marks and what they are without, by the character database.
_MARKED = "".join(c for c in map(chr, range(0xC0, 0x1F00)) if unicodedata.normalize("NFD", c)[0].isascii() and unicodedata.normalize("NFD", c) != c)
_BARE = "".join(unicodedata.normalize("NFD", c)[0] for c in _MARKED)


def folded(text: Column) -> Column:
    """The text in lower case without the marks of Latin letters; '' for null."""
    return F.lower(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _MARKED, _BARE), r"[\x{0300}-\x{036F}]", ""))


def graded(points: Sequence[tuple[Column, float]], least: float = 0.0, most: float = 10.0) -> Column:
    """The sum of the points of the true conditions, clamped; a null condition gives none."""
    total = reduce(add, [F.when(c, F.lit(float(p))).otherwise(0.0) for c, p in points], F.lit(0.0))
    return F.greatest(F.lit(float(least)), F.least(F.lit(float(most)), total))


def vote(signs: Sequence[Column], least: int) -> Column:
    """Whether at least so many of the signs are true; nulls are not."""
    return reduce(add, [F.when(s, 1).otherwise(0) for s in signs], F.lit(0)) >= least


def holds_any(text: Column, needles: Sequence[str]) -> Column:
    """Whether the lower-case text holds one of the needles; null holds none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return reduce(or_, [low.contains(n) for n in needles], F.lit(False))


def fullness(text: Column, full: int, ends: Sequence[str], walls: Sequence[str]) -> Column:
    """'empty', 'walled' (short and with a wall's words), 'truncated' (ends like a cut text), 'full' or 'short'."""
    s = F.trim(F.coalesce(text, F.lit("")))
    cut = reduce(or_, [s.endswith(e) for e in ends], F.lit(False))
    short = F.length(s) < full
    return F.when(s == "", "empty").when(short & holds_any(s, walls), "walled").when(cut, "truncated").when(short, "short").otherwise("full")


def word_count(text: Column) -> Column:
    """Runs of letters; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\p{L}+"))


def vietnamese(text: Column, least_share: float = 0.08) -> Column:
    """Whether at least a share of the letters are ones that only Vietnamese writes; texts without letters are not."""
    low = F.lower(F.coalesce(text, F.lit("")))
    letters = F.length(F.regexp_replace(low, r"\P{L}+", ""))
    return (letters > 0) & (F.length(F.regexp_replace(low, f"[^{VIETNAMESE}]+", "")) >= least_share * letters)


def english(text: Column, words: Sequence[str], least_share: float = 0.12) -> Column:
    """Whether at least a share of the words are among these common ones."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = F.regexp_count(low, F.lit(r"\b(?:" + "|".join(words) + r")\b"))
    return (word_count(low) > 0) & (hits >= least_share * word_count(low))


def unsupported_names(text: Column, corpus: Column, pattern: str = r"\b\p{Lu}[\p{L}]+(?: \p{Lu}[\p{L}]+)+") -> Column:
    """Names of two or more capitalised words that the corpus text does not hold, in order, each once."""
    names = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0)))
    base = F.lower(F.coalesce(corpus, F.lit("")))
    return F.filter(names, lambda n: ~base.contains(F.lower(n)))


def listed(parts: Sequence[tuple[Column, Sequence[str]]]) -> Column:
    """The values of all true conditions, in the order given; an empty array if none is true."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(c, F.array(*[F.lit(v) for v in vs])).otherwise(none) for c, vs in parts])


def second_label(rules: Sequence[tuple[Column, str]], first: Column) -> Column:
    """The label of the first true rule that is not the first label already; null if none."""
    out: Column | None = None
    for condition, label in rules:
        test = condition & ~first.eqNullSafe(F.lit(label))
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.lit(None).cast("string") if out is None else out


def impact(place: Column, tone: Column, places: int, extreme: float) -> Column:
    """Half by the rank, half by the tone, each up to 50, rounded half to even; nulls count as the last place and no tone."""
    by_rank = 50 * (1 - F.least(F.coalesce(place, F.lit(places)), F.lit(places)) / F.lit(float(places)))
    by_tone = 50 * F.least(F.abs(F.coalesce(tone, F.lit(0.0))) / F.lit(float(extreme)), F.lit(1.0))
    return F.bround(by_rank + by_tone, 0).cast("int")


def source_label(host: Column, names: Mapping[str, str]) -> Column:
    """A source's name: the listed one, else the host's first label with a capital; '' for none."""
    first = F.initcap(F.substring_index(host, ".", 1))
    if not names:
        return first
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, host), first)


def source_family(host: Column, families: Mapping[str, str]) -> Column:
    """The family of the longest listed domain that the host is or lies below, else its last two labels."""
    rules = [((host == d) | host.endswith(f".{d}"), f) for d, f in sorted(families.items(), key=lambda kv: (-len(kv[0]), kv[0]))]
    out = F.substring_index(host, ".", -2)
    for condition, family in reversed(rules):
        out = F.when(condition, F.lit(family)).otherwise(out)
    return out


def source_tier(host: Column, tiers: Sequence[Sequence[str]]) -> Column:
    """0 for the domains of the first list and what lies below them, 1 for the second's, and so on; their number for others."""
    out = F.lit(len(tiers))
    for n in range(len(tiers) - 1, -1, -1):
        hit = reduce(or_, [(host == d) | host.endswith(f".{d}") for d in tiers[n]], F.lit(False))
        out = F.when(hit, n).otherwise(out)
    return out


def has_clock(text: Column) -> Column:
    """Whether a written time holds an hour and minutes that are not midnight's zeros alone."""
    t = F.regexp_extract(F.coalesce(text, F.lit("")), r"[T ](\d{1,2}:\d{2}(?::\d{2})?)", 1)
    return (t != "") & ~t.isin("00:00", "00:00:00", "0:00")


def display_time(published: Column, extracted: Column) -> Column:
    """The written publication time where it has a clock, else its day with the clock of the extraction, else the extraction."""
    day = F.regexp_extract(F.coalesce(published, F.lit("")), r"^(\d{4}-\d{2}-\d{2})", 1)
    clock = F.date_format(extracted, "HH:mm:ss")
    own = F.regexp_replace(F.substring(published, 1, 19), "T", " ")
    return F.when((day != "") & has_clock(published), own).when(day != "", F.concat_ws(" ", F.nullif(day, F.lit("")), clock)).otherwise(F.date_format(extracted, "yyyy-MM-dd HH:mm:ss"))


def shortened(text: Column, most: int, mark: str = "…") -> Column:
    """The trimmed text, cut to ``most`` characters and marked where it was longer; '' for null."""
    s = F.trim(F.coalesce(text, F.lit("")))
    return F.when(F.length(s) > most, F.concat(F.rtrim(F.substring(s, 1, most)), F.lit(mark))).otherwise(s)
