"""Column expressions: time, text, thresholds and classes. All stay inside whole-stage codegen."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

OBSERVED, FORECAST, SIMULATED = "OBSERVED", "FORECAST", "SIMULATED"

# fixed values: rain and discharge cutoffs of the published scoring rule
RAIN_YELLOW_24, RAIN_YELLOW_48 = 30.0, 60.0
RAIN_RED_24, RAIN_RED_48 = 60.0, 100.0
DISCHARGE_YELLOW, DISCHARGE_RED = 0.70, 0.90
P_YELLOW, P_RED = 0.2, 0.5
TREND_PCT = 5.0
STATION_TIME_FORMATS = ("yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "d/M/yy H:mm")
LOCAL_OFFSET_MINUTES = 330


def past_or_future(t: Column, now: Column) -> Column:
    return F.when(t <= now, F.lit(OBSERVED)).otherwise(F.lit(FORECAST))


def shift_minutes(ts: Column, minutes: int) -> Column:
    return ts + F.make_interval(mins=F.lit(minutes))


def local_to_utc(ts: Column, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    return shift_minutes(ts, -offset_minutes)


def parse_station_time(s: Column, formats=STATION_TIME_FORMATS, offset_minutes: int = LOCAL_OFFSET_MINUTES) -> Column:
    """First format that fits, then local time to UTC; null when none fits."""
    tries = []
    for f in formats:
        t = F.try_to_timestamp(F.trim(s), F.lit(f)).cast("timestamp_ntz")
        # two-digit years from 69 on are in the last century
        tries.append(F.when(F.year(t) >= 2069, t - F.expr("INTERVAL '100' YEAR")).otherwise(t) if re.search(r"(?<!y)yy(?!y)", f) else t)
    return local_to_utc(F.coalesce(*tries), offset_minutes)


# a plain decimal number; casts alone would also take type suffixes
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number_or_null(s: Column) -> Column:
    return F.when(s.cast("string").rlike(NUMBER), s.try_cast("double"))


def key_of(s: Column, lower: bool = False, limit: int | None = None, default: str | None = None) -> Column:
    """Text as a file or column key: runs of other characters become one underscore."""
    k = F.regexp_replace(s, "[^A-Za-z0-9]+", "_")
    k = F.regexp_replace(k, "^_+|_+$", "")
    if lower:
        k = F.lower(k)
    if limit is not None:
        k = F.left(k, F.lit(limit))
    if default is not None:
        k = F.coalesce(F.nullif(k, F.lit("")), F.lit(default))
    return k


@cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """For ``translate``: letters that fold to one letter, then marks that go; and letters that fold to several.

    Folding is canonical decomposition, combining marks dropped, case folded. Hangul syllables stay whole.
    """
    one, gone, many = {}, [], {}
    for cp in range(0x41, sys.maxunicode + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        flat = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x)).casefold()
        if not flat:
            gone.append(c)
        elif len(flat) > 1:
            many[c] = flat
        elif flat != c:
            one[c] = flat
    return "".join([*one, *gone]), "".join(one.values()), many


# white space as Unicode has it
BLANKS = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def fold_text(s: Column) -> Column:
    """Diacritics dropped, case folded, trimmed; JVM-side for whole texts. Vowel signs of Indic scripts stay."""
    src, dst, many = _fold_tables()
    long = s
    for c, flat in many.items():
        long = F.replace(long, F.lit(c), F.lit(flat))
    # a text without such letters, most of them, is not searched for each
    has_many = F.length(F.translate(s, "".join(many), "")) < F.length(s)
    return F.btrim(F.translate(F.when(has_many, long).otherwise(s), src, dst), F.lit(BLANKS))


def cyclic_day_distance(a: Column, b: Column) -> Column:
    gap = F.abs(a - b)
    return F.least(gap, F.lit(366) - gap)


def day_harmonic(day: Column, kind: str) -> Column:
    angle = F.lit(6.283185307179586) * F.dayofyear(day) / F.lit(365.25)
    return F.sin(angle) if kind == "sin" else F.cos(angle)


def rain_score(h24: Column, h48: Column) -> Column:
    return (
        F.when((h24 >= RAIN_RED_24) | (h48 >= RAIN_RED_48), 2)
        .when((h24 >= RAIN_YELLOW_24) | (h48 >= RAIN_YELLOW_48), 1)
        .otherwise(0)
    )


def discharge_score(share: Column) -> Column:
    return F.when(share >= DISCHARGE_RED, 2).when(share >= DISCHARGE_YELLOW, 1).otherwise(0)


def risk_class(total: Column) -> Column:
    return F.when(total >= 3, "RED").when(total == 2, "YELLOW").otherwise("GREEN")


def two_tier_colour(p_elevated: Column, p_extreme: Column) -> Column:
    return F.when(p_extreme >= P_RED, "RED").when(p_elevated >= P_YELLOW, "YELLOW").otherwise("GREEN")


def trend_pct(now: Column, before: Column) -> Column:
    return F.when(before > 0, F.lit(100.0) * (now - before) / before)


def trend_word(pct: Column, band: float = TREND_PCT) -> Column:
    return F.when(pct >= band, "rising").when(pct <= -band, "falling").when(pct.isNotNull(), "steady")


def mark_status(level: Column, warning: Column, danger: Column) -> Column:
    """Null level gives null; a missing mark is never exceeded."""
    return (
        F.when(level.isNull(), F.lit(None).cast("string"))
        .when(level >= danger, "above_danger")
        .when(level >= warning, "above_warning")
        .otherwise("below_warning")
    )


def exposure_tier(place_m: Column, river_m: Column, near_km: Column) -> Column:
    drop = place_m - river_m
    return F.when(
        drop.isNotNull(),
        F.when((drop <= 6) & (near_km <= 8), "higher")
        .when((drop >= 20) | (near_km >= 20), "lower")
        .otherwise("moderate"),
    )


# fixed values: the published sentences, one per colour
SENTENCE_RED = "A tested river model expects unusually high water on the %s near here by tomorrow."
SENTENCE_YELLOW = "A tested river model sees a raised chance of high water on the %s near here by tomorrow - worth watching."
SENTENCE_GREEN = "A tested river model expects the %s near here to stay in its normal range through tomorrow (river currently %s)."


def basis_sentence(colour: Column, river: Column, trend: Column) -> Column:
    return (
        F.when(colour == "RED", F.format_string(SENTENCE_RED, river))
        .when(colour == "YELLOW", F.format_string(SENTENCE_YELLOW, river))
        .otherwise(F.format_string(SENTENCE_GREEN, river, trend))
    )


# fixed value: how a headline names its river
RIVER_PATTERN = r"River\s+([A-Za-z()\- ]+?)\s+at\s"


def river_named(headline: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(headline, RIVER_PATTERN, 1)), F.lit(""))


def provenance(value: Column, cls: Column, source: Column, retrieved_at: Column, **extra: Column) -> Column:
    """The published form of a value; wrap last, at the publishing edge."""
    parts = [value.alias("value"), cls.alias("class"), source.alias("source"), retrieved_at.alias("retrieved_at")]
    return F.struct(*parts, *[c.alias(k) for k, c in extra.items()])
