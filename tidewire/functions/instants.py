"""Publication times in many written forms, as one instant in microseconds since 1970-01-01 UTC."""

from __future__ import annotations

from zoneinfo import available_timezones

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names and their usual short forms, by language.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
    "janvier": 1, "février": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7, "août": 8, "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12,
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "januar": 1, "februar": 2, "märz": 3, "juni": 6, "juli": 7, "oktober": 10, "dezember": 12,
    "января": 1, "февраля": 2, "марта": 3, "апреля": 4, "мая": 5, "июня": 6, "июля": 7, "августа": 8, "сентября": 9, "октября": 10, "ноября": 11, "декабря": 12,
}

# Zone abbreviations and the offsets they name.
ZONES = {
    "z": "+00:00", "ut": "+00:00", "utc": "+00:00", "gmt": "+00:00", "wet": "+00:00", "west": "+01:00", "bst": "+01:00",
    "cet": "+01:00", "cest": "+02:00", "eet": "+02:00", "eest": "+03:00", "msk": "+03:00", "мск": "+03:00", "ist": "+05:30",
    "ict": "+07:00", "jst": "+09:00", "aest": "+10:00", "aedt": "+11:00", "est": "-05:00", "edt": "-04:00", "cst": "-06:00",
    "cdt": "-05:00", "mst": "-07:00", "mdt": "-06:00", "pst": "-08:00", "pdt": "-07:00",
}

#: Regions by the time zone database; names of links outside an area, such as posix/..., are left out.
REGIONS = sorted({"UTC"} | {z for z in available_timezones() if "/" in z and z[0].isupper() and not z.startswith(("SystemV", "US/Pacific-New"))})

_SEP = "\u0001"
_ZONE = r"(?:\(?(?:GMT|UTC)?([+-]\d{1,2}(?::?\d{2})?)\)?(?:\[[^\]]*\])?|[\[(]?(\p{L}{1,5})[\])]?|\[?(\p{L}[\w+-]*/[\w/+-]+)\]?)?"
_CLOCK = r"(\d{1,2})[:h](\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*(?i:([ap])\.?m\.?(?!\p{L}))?(?:\s*Uhr)?"
_DATE_THEN_CLOCK = rf"^(.*?\d)(?:T|t|,?\s+)(?:à\s+|at\s+|um\s+|в\s+)?{_CLOCK}\s*{_ZONE}$"
_CLOCK_THEN_DATE = rf"^{_CLOCK},?\s+(\S.*?\d{{4}})\s*{_ZONE}$"
_ISO = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$"
_DIGITS = r"^(?:\p{L}[^\d]*)?(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$"
_DAY_NAME = r"^(?:\p{L}[^\d]*)?(\d{1,2})\.?\s+(?:de\s+)?(\p{L}+)\.?,?\s+(?:de\s+)?(\d{4})$"
_NAME_DAY = r"^(?:\p{L}+,\s+)?(\p{L}+)\.?\s+(\d{1,2}),?\s+(\d{4})$"


def _groups(s: Column, pattern: str, order: str, n: int) -> Column:
    """The pattern's groups as an array of ``n``, in the order given; null where it does not match."""
    parts = F.split(F.regexp_replace(s, pattern, _SEP.join(f"${g}" for g in order.split())), _SEP)
    return F.try_element_at(F.filter(F.array(parts), lambda p: F.size(p) == n), F.lit(1))


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def _digits_micros(s: Column) -> Column:
    """A string of digits alone: an epoch in seconds or finer by its length, or yyyyMMdd with or without a clock; UTC."""
    n, v = F.length(s), s.try_cast("long")
    part = lambda at, size: F.substring(s, at, size).try_cast("int")
    clock = lambda at, least: F.when(n >= least, part(at, 2)).otherwise(F.lit(0))
    stamp = F.try_make_timestamp(part(1, 4), part(5, 2), part(7, 2), clock(9, 12), clock(11, 12), _seconds(clock(13, 14), F.lit("")), F.lit("UTC"))
    return (
        F.when(n.isin(8, 12, 14), F.unix_micros(stamp))
        .when(v <= 0, None)
        .when(n.isin(9, 10), v * 1_000_000)
        .when(n == 13, v * 1000)
        .when(n == 16, v)
        .when(n == 19, F.floor((v - F.pmod(v, F.lit(1000))) / F.lit(1000)))
        .cast("long")
    )


def _seconds(second: Column, fraction: Column) -> Column:
    """Seconds with the fraction cut after microseconds; null from 60 on."""
    micros = F.rpad(F.coalesce(F.substring(fraction, 1, 6), F.lit("")), 6, "0")
    return F.when(second < 60, F.concat(second.cast("string"), F.lit("."), micros).cast("decimal(8,6)"))


def _date_parts(date: Column, order: Column) -> Column:
    """Year, month and day of a written date; ``order`` (dmy or mdy) reads the all-digit ones, dmy where it is null."""
    named = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    iso, digits = _groups(date, _ISO, "1 2 3", 3), _groups(date, _DIGITS, "1 2 3", 3)
    word = F.coalesce(_groups(date, _DAY_NAME, "1 2 3", 3), _groups(date, _NAME_DAY, "2 1 3", 3))
    return F.coalesce(
        iso,
        F.when(digits.isNotNull() & (order == "mdy"), F.array(digits[2], digits[0], digits[1])),
        F.when(digits.isNotNull(), F.array(digits[2], digits[1], digits[0])),
        F.when(word.isNotNull(), F.array(word[2], named[F.lower(word[1])].cast("string"), word[0])),
    )


def _zone(offset: Column, name: Column, region: Column) -> Column:
    """The zone a string names, as an offset or a region; '' where it names none, null where it is unknown."""
    abbreviations = F.create_map(*[F.lit(x) for kv in ZONES.items() for x in kv])
    digits = F.regexp_replace(F.substring(offset, 2, 9), ":", "")
    four = F.when(F.length(digits) <= 2, F.concat(F.lpad(digits, 2, "0"), F.lit("00"))).otherwise(F.lpad(digits, 4, "0"))
    fits = (F.substring(four, 1, 2).cast("int") <= 18) & (F.substring(four, 3, 2).cast("int") < 60)
    return (
        F.when(offset != "", F.when(fits, F.concat(F.substring(offset, 1, 1), F.substring(four, 1, 2), F.lit(":"), F.substring(four, 3, 2))))
        .when(region != "", F.when(region.isin(REGIONS), region))
        .when(name != "", abbreviations[F.lower(name)])
        .otherwise("")
    )


def written_time(text: Column, order: Column) -> Column:
    """What a time string says, before a source's clock is asked.

    A struct of ``micros`` (the instant, where the string itself settles it), and ``year``, ``month``, ``day``, ``hour``,
    ``minute``, ``second`` (the local time, where it names a clock time without a zone). All fields are null for null,
    empty, relative, impossible and placeholder values.
    """
    s = _trimmed(text)
    # clock parts: hour, minute, second, fraction, half, offset, name, region, date
    f = F.coalesce(_groups(s, _DATE_THEN_CLOCK, "2 3 4 5 6 7 8 9 1", 9), _groups(s, _CLOCK_THEN_DATE, "1 2 3 4 5 7 8 9 6", 9))
    raw = F.struct(s.alias("s"), f.alias("f"), _date_parts(F.coalesce(f[8], s), order).alias("d"), _zone(f[5], f[6], f[7]).alias("z"))

    def settle(x: Column) -> Column:
        whole, c, d, zone = x["s"], x["f"], x["d"], x["z"]
        h = c[0].try_cast("int")
        half = F.lower(c[4])
        hour = F.when(half == "", h).when(h.between(1, 12), h % 12 + F.when(half == "p", 12).otherwise(0))
        sec = _seconds(F.when(c[2] == "", "0").otherwise(c[2]).try_cast("int"), c[3])
        y, mo, day = (d[k].try_cast("int") for k in range(3))
        date = F.when(y.between(2, 9998), y)
        at_zone = F.unix_micros(F.try_make_timestamp(date, mo, day, hour, c[1].try_cast("int"), sec, F.nullif(zone, F.lit(""))))
        midnight = F.unix_micros(F.try_make_timestamp(date, mo, day, F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"), F.lit("UTC")))
        micros = F.when(whole.rlike(r"^[0-9]+$"), _digits_micros(whole)).when(c.isNull(), midnight).otherwise(at_zone)
        local = c.isNotNull() & (zone == "")
        keep = lambda v: F.when(local, v)
        return F.struct(
            F.when(micros != 0, micros).alias("micros"), keep(date).alias("year"), keep(mo).alias("month"), keep(day).alias("day"),
            keep(hour).alias("hour"), keep(c[1].try_cast("int")).alias("minute"), keep(sec).alias("second"),
        )

    return F.transform(F.array(raw), settle)[0]


def at_clock(t: Column, zone: Column) -> Column:
    """The instant in microseconds of a local time on a zone's clock, null without a zone.

    A clock time that occurs twice means the first; one that is skipped is read with the offset before the change.
    """
    stamp = F.try_make_timestamp(t["year"], t["month"], t["day"], t["hour"], t["minute"], t["second"], F.when(zone.isin(REGIONS), zone))
    return F.unix_micros(stamp)
