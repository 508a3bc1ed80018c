"""Text expressions: city keys, labels, reasons, JSON metadata."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

from salesloom.functions.fixed import (
    CURRENCY_NAMES,
    MACRO_REGION_STATES,
    RAINY_DAY_MM,
    UNKNOWN_MACRO_REGION,
    WEATHER_CATEGORIES,
)

# What Python's str.strip removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
EM_DASH = "—"


@cache
def accent_alphabets() -> tuple[str, str]:
    """All accented letters and, position by position, their unaccented base letters."""
    accented, plain = [], []
    for code in range(0xC0, sys.maxunicode + 1):
        letter = chr(code)
        if not unicodedata.decomposition(letter):
            continue
        base = [c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0] != letter:
            accented.append(letter)
            plain.append(base[0])
    return "".join(accented), "".join(plain)


def normalize_city(city: Column) -> Column:
    """Join key of a city name: accents removed, lower case, trimmed; NULL becomes ''."""
    accented, plain = accent_alphabets()
    base = F.translate(F.coalesce(city, F.lit("")), accented, plain)
    without_marks = F.regexp_replace(base, r"\p{Mn}+", "")
    return F.btrim(F.lower(without_marks), F.lit(WHITESPACE))


def lower_trim(text: Column) -> Column:
    """Lower case and trimmed, accents kept."""
    return F.btrim(F.lower(text), F.lit(WHITESPACE))


def map_lookup(pairs: dict[str, str], key: Column) -> Column:
    """Value of `key` in a small constant map, NULL when absent."""
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])[key]


def macro_region(state: Column) -> Column:
    """Macro-region of a state code in any case."""
    regions = {s: region for region, states in MACRO_REGION_STATES.items() for s in states}
    return F.coalesce(map_lookup(regions, F.upper(state)), F.lit(UNKNOWN_MACRO_REGION))


def currency_name(code: Column) -> Column:
    """Currency name of an ISO code, the code itself when unnamed."""
    return F.coalesce(map_lookup(CURRENCY_NAMES, code), code)


def category_fallback(english: Column, portuguese: Column) -> Column:
    """English category, else the Portuguese one, else 'unknown'."""
    return F.coalesce(english, portuguese, F.lit("unknown"))


def pair_label(base: Column, quote: Column) -> Column:
    """`base/quote` label of a currency pair."""
    return F.concat(base, F.lit("/"), quote)


def unknown_member(attribute: Column) -> Column:
    """Dimension attribute with 'Unknown' for a missing member."""
    return F.coalesce(attribute, F.lit("Unknown"))


def weather_category(code: Column) -> Column:
    """Weather category of a WMO code; a missing code stays missing."""
    branch = F.when(code.isNull(), F.lit(None).cast("string"))
    for label, low, high in WEATHER_CATEGORIES:
        branch = branch.when(code.between(low, high), label)
    return branch.otherwise("other")


def change_label(change: Column) -> Column:
    """Arrow, signed percentage and direction of a relative change; FLAT when zero or missing."""
    percent = F.concat(
        F.when(change > 0, "+").otherwise("-"),
        F.round(F.abs(change) * 100, 1).cast("decimal(18,1)").cast("string"),
        F.lit("%"),
    )
    return (
        F.when(change > 0, F.concat(F.lit("▲ "), percent, F.lit(" (UP)")))
        .when(change < 0, F.concat(F.lit("▼ "), percent, F.lit(" (DOWN)")))
        .otherwise("▬ 0.0% (FLAT)")
    )


def late_label(actual: Column, estimated: Column) -> Column:
    """'LATE: n days' when delivered after the promise, else the day count; em dash when open."""
    days = actual.cast("string")
    return (
        F.when(actual > estimated, F.concat(F.lit("LATE: "), days, F.lit(" days")))
        .when(actual.isNotNull(), days)
        .otherwise(EM_DASH)
    )


def rain_label(precipitation: Column) -> Column:
    """Millimetres of rain with ' (High)' above the rainy-day threshold; em dash when missing."""
    millimetres = precipitation.cast("string")
    return (
        F.when(precipitation > RAINY_DAY_MM, F.concat(millimetres, F.lit(" (High)")))
        .when(precipitation.isNotNull(), millimetres)
        .otherwise(EM_DASH)
    )


def or_dash(value: Column) -> Column:
    """Text of a value, em dash when missing."""
    return F.coalesce(value.cast("string"), F.lit(EM_DASH))


def json_text(**fields: Column) -> Column:
    """JSON object text of named columns."""
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
