"""Turning fetched documents (nested JSON, feeds, alert markup, word tables) into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions import scalars as S

HOURLY_SCHEMA = "struct<hourly:struct<time:array<string>,precipitation:array<double>>>"
DAILY_SCHEMA = (
    "struct<daily:struct<time:array<string>,river_discharge:array<double>,river_discharge_min:array<double>,"
    "river_discharge_median:array<double>,river_discharge_mean:array<double>,river_discharge_max:array<double>>>"
)


def hourly_rows(docs: DataFrame, key: str, doc: str, now: Column, back_hours: int = 72, ahead_hours: int = 48) -> DataFrame:
    """Parallel time and value arrays to rows; nulls and hours outside the window dropped."""
    d = docs.select(key, now.alias("_now"), F.from_json(doc, HOURLY_SCHEMA).alias("_d"))
    zipped = F.arrays_zip(F.col("_d.hourly.time").alias("t"), F.col("_d.hourly.precipitation").alias("mm"))
    rows = d.select(key, "_now", F.inline(zipped)).withColumn("t", F.to_timestamp_ntz("t", F.lit("yyyy-MM-dd'T'HH:mm")))
    lo = F.col("_now") - F.make_interval(hours=F.lit(back_hours))
    hi = F.col("_now") + F.make_interval(hours=F.lit(ahead_hours))
    rows = rows.filter(F.col("mm").isNotNull() & F.col("t").between(lo, hi))
    return rows.withColumn("cls", S.past_or_future(F.col("t"), F.col("_now"))).drop("_now")


def daily_rows(docs: DataFrame, keys: list[str], doc: str, today: Column) -> DataFrame:
    """As ``hourly_rows`` for daily discharge, with the ensemble as a struct when any member is there."""
    d = docs.select(*keys, F.from_json(doc, DAILY_SCHEMA).alias("_d"))
    parts = ("min", "median", "mean", "max")
    # a series the document does not carry counts as one without values
    held = lambda c: F.coalesce(F.col(f"_d.daily.{c}"), F.array().cast("array<double>"))
    zipped = F.arrays_zip(
        F.col("_d.daily.time").alias("t"),
        held("river_discharge").alias("q"),
        *[held(f"river_discharge_{p}").alias(f"e_{p}") for p in parts],
    )
    rows = d.select(*keys, F.inline(zipped)).filter("q IS NOT NULL")
    members = [F.col(f"e_{p}").alias(p) for p in parts]
    ensemble = F.when(F.coalesce(*members).isNotNull(), F.struct(*members))
    day = F.to_date("t")
    return rows.select(*keys, day.alias("d"), "q", S.past_or_future(day, today).alias("cls"), ensemble.alias("ensemble"))


# fixed values: the fields of an alert, in order
ALERT_FIELDS = (
    "identifier", "sender", "sent", "status", "msgType", "event", "urgency", "severity",
    "certainty", "effective", "onset", "expires", "headline", "description", "areaDesc",
)


def tag_text(doc: Column, tag: str) -> Column:
    return F.trim(F.regexp_replace(F.regexp_extract(doc, f"(?s)<cap:{tag}>(.*?)</cap:{tag}>", 1), r"^\s+|\s+$", ""))


def alert_fields(docs: DataFrame, ident: str, doc: str) -> DataFrame:
    """Named fields of each alert, and a coordinate when both numbers parse.

    The feed carries latitude and longitude in its altitude and ceiling fields.
    """
    d = F.col(doc)
    fields = {f: tag_text(d, f) for f in ALERT_FIELDS}
    fields["identifier"] = F.coalesce(F.nullif(fields["identifier"], F.lit("")), F.col(ident).cast("string"))
    lat, lon = S.number_or_null(tag_text(d, "altitude")), S.number_or_null(tag_text(d, "ceiling"))
    both = lat.isNotNull() & lon.isNotNull()
    return docs.select(
        *[c.alias(f) for f, c in fields.items()], F.when(both, lat).alias("approx_lat"), F.when(both, lon).alias("approx_lon")
    )


# fixed value: how an item of the published feed links its document
ITEM_LINK = r"FetchXMLFile\?identifier=(\d+)"


def relevant_items(feeds: DataFrame, key: str, feed: str, vocabulary: str, link: str = ITEM_LINK) -> DataFrame:
    """Items of each feed that carry an identifier (the first group of ``link``) and match the vocabulary (a regex, any case)."""
    items = feeds.select(key, F.explode(F.regexp_extract_all(feed, F.lit("(?s)<item>(.*?)</item>"), 1)).alias("item"))
    ident = F.nullif(F.regexp_extract("item", link, 1), F.lit(""))
    return items.withColumn("identifier", ident).filter(F.col("identifier").isNotNull() & F.col("item").rlike(f"(?i){vocabulary}"))


def line_table(words: DataFrame, doc: str, top: str, x: str, text: str, entities: list[str], line_height: float = 3.0) -> DataFrame:
    """Words with positions to lines that name an entity and carry four or more numbers.

    A line is the words of one document with the same rounded height, so the arrays are as short
    as a printed line.
    """
    # gathering words shrinks nothing, so they are shuffled as they are and gathered once
    lines = words.select(doc, F.bround(F.col(top) / line_height).cast("bigint").alias("line"), x, text).repartition(doc, "line")
    g = lines.groupBy(doc, "line").agg(F.array_sort(F.collect_list(F.struct(F.col(x).alias("x"), F.col(text).alias("w")))).alias("_w"))
    toks = F.transform("_w", lambda s: s["w"])
    g = g.withColumn("_t", toks).withColumn("raw", F.array_join("_t", " "))
    padded = F.concat(F.lit(" "), F.col("raw"), F.lit(" "))
    named = F.filter(
        F.array(*[F.lit(e) for e in entities]), lambda e: F.startswith(F.col("raw"), e) | F.contains(padded, F.concat(F.lit(" "), e, F.lit(" ")))
    )
    numbers = F.transform(F.filter("_t", lambda w: w.rlike(r"^-?\d+(\.\d+)?$")), lambda w: w.cast("double"))
    out = g.withColumn("entity", F.get(named, F.lit(0))).withColumn("numbers", numbers)
    return out.filter(F.col("entity").isNotNull() & (F.size("numbers") >= 4)).select(doc, "line", "entity", "numbers", "raw")


def label_numbers(df: DataFrame, numbers: str) -> DataFrame:
    """Positional numbers of a reservoir report line to named columns, with the fill fraction."""
    n = lambda i: F.get(F.col(numbers), F.lit(i))
    size = F.size(numbers)
    mddl, frl, designed, level = n(0), n(1), n(2), n(3)
    sane = (frl > mddl) & (level >= mddl) & (level <= frl + 1)
    return df.withColumns(
        {
            "mddl_m": mddl,
            "frl_m": frl,
            "designed_mu": designed,
            "present_level_m": level,
            "present_storage_mu": F.when((designed > 0) & (size >= 9), n(4)),
            "fill_fraction": F.when(sane, (level - mddl) / (frl - mddl)),
            "n_raw": size,
            "needs_review": ~size.isin(6, 9),
        }
    )


# a field read as text keeps a nested object as its own JSON, whether bare or wrapped
SNAPSHOT_SCHEMA = (
    "generated_at string, basin string, degraded boolean, shipped string, model string, error string, "
    "inputs struct<q_today_m3s:string>, predictions struct<h1:struct<q_m3s:string,p_exceed_threshold:string>>, "
    "threshold_m3s string, colour string"
)


def flatten_snapshot(docs: DataFrame, key: str, doc: str) -> DataFrame:
    """One ledger row per forecast snapshot; each field may be bare or wrapped with provenance."""
    d = docs.select(key, F.from_json(doc, SNAPSHOT_SCHEMA).alias("_d"))

    def field(path: str) -> Column:
        c = F.col(f"_d.{path}")
        return F.when(F.startswith(c, F.lit("{")), F.get_json_object(c, "$.value")).otherwise(c)

    return d.select(
        key,
        "_d.generated_at",
        "_d.basin",
        F.coalesce("_d.degraded", F.lit(False)).alias("degraded"),
        F.coalesce("_d.shipped", "_d.model").alias("shipped"),
        S.number_or_null(field("inputs.q_today_m3s")).alias("q_now_m3s"),
        S.number_or_null(field("predictions.h1.q_m3s")).alias("predicted_h1_m3s"),
        S.number_or_null(field("predictions.h1.p_exceed_threshold")).alias("p_exceed_h1"),
        S.number_or_null(field("threshold_m3s")).alias("threshold_m3s"),
        field("colour").alias("colour"),
        "_d.error",
    )
