"""Reading and writing point and station series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from freshet.functions import scalars as S


def write_partitioned(df: DataFrame, path: str, part: str) -> str:
    """One table partitioned by time part; all points share its files, and a large part gets several."""
    df.hint("rebalance", F.col(part)).write.partitionBy(part).mode("errorifexists").parquet(path)
    return path


def scan_points(
    spark: SparkSession, path: str, schema: T.StructType, part: str, parts: list[int], key: str | None = None, keys: list | None = None
) -> DataFrame:
    """Chosen time parts (pruned as folders) and points (pushed into the scan) of a point table."""
    df = spark.read.schema(schema).parquet(path).filter(F.col(part).isin(parts))
    return df if keys is None else df.filter(F.col(key).isin(keys))


def _parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """What can be read of a part: damaged files give the rows before the damage; None if there is nothing to read.

    The columns come from the footers of all files, as the one that is looked at otherwise may be the damaged one.
    """
    try:
        return spark.read.options(ignoreCorruptFiles="true", mergeSchema="true").parquet(path)
    except AnalysisException:
        return None


def union_parts(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """Parts side by side by column name, as far as they can be read: ``parts_account`` tells what was lost."""
    found = [df for p in paths if (df := _parquet(spark, p)) is not None]
    if not found:
        return spark.createDataFrame([], schema)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def _one_form(file: Column) -> Column:
    """Local files are named with one slash in some places and three in others."""
    return F.regexp_replace(file, "^file:/+", "file:///")


def file_listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, bytes) of every file under the paths, without reading any.

    A scan passes over files without a byte, so the names come from the list that the driver makes for any read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "file string").withColumn("file", _one_form(F.col("file")))
    sizes = files.select(_one_form(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return names.join(sizes, "file", "left").select("file", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def parts_account(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file of the parts, or per missing part: path, file, bytes, expected, n_rows, reason.

    ``expected`` is the row count of the file's footer (null if that can't be read), ``n_rows`` how many rows ``union_parts`` gets
    from it. ``reason`` is null for a file read whole, else ``missing``, ``empty``, ``unreadable`` or ``damaged``.
    """
    out = []
    for p in paths:
        try:
            listed = file_listing(spark, p)
        except AnalysisException:
            gone = {"file": "string", "bytes": "bigint", "expected": "bigint", "n_rows": "bigint"}
            out.append(spark.range(1).select(F.lit(p).alias("path"), *[F.lit(None).cast(t).alias(n) for n, t in gone.items()], F.lit("missing").alias("reason")))
            continue
        df = _parquet(spark, p)
        if df is None:
            read = listed.select("file", F.lit(None).cast("bigint").alias("expected"), F.lit(None).cast("bigint").alias("n_rows")).limit(0)
        else:
            df = df.select("*", _one_form(F.col("_metadata.file_path")).alias("__file"))
            # no column is read for the one count, every column for the other (JSON may be null, so it is made)
            by_footer = df.groupBy(F.col("__file").alias("file")).agg(F.count(F.lit(1)).alias("expected"))
            values = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "__file"]))
            decoded = df.groupBy(F.col("__file").alias("file")).agg(F.count(values).alias("n_rows"))
            read = by_footer.join(decoded, "file", "left")
        j = listed.join(read, "file", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
        lost = F.when(F.col("bytes") == 0, "empty").when(F.col("expected").isNull(), "unreadable").when(F.col("n_rows") < F.col("expected"), "damaged")
        # a file without rows has none to count
        out.append(j.select(F.lit(p).alias("path"), "file", "bytes", "expected", "n_rows", lost.alias("reason")))
    return reduce(lambda a, b: a.unionByName(b), out)


def skipped_parts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The parts and files that ``union_parts`` leaves out or reads in part, with the reason: path, file, n_rows, reason."""
    return parts_account(spark, paths).filter("reason IS NOT NULL").select("path", "file", "n_rows", "reason")


# splits a CSV line outside double quotes
CSV_COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def _csv_cells(line: Column) -> Column:
    return F.transform(F.split(line, CSV_COMMA), lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))


def _plain(name: Column) -> Column:
    return F.lower(F.trim(name))


def _telemetry(spark: SparkSession, path: str | list[str], station: str, time: str) -> DataFrame:
    """Every line below a header as file, station, district, lat, lon, t, value, and those of files without a header (``headed`` is false)."""
    lines = spark.read.text(path).select(_one_form(F.col("_metadata.file_path")).alias("file"), _csv_cells(F.col("value")).alias("cells"))
    names = F.transform("cells", _plain)
    is_head = F.array_contains(names, station.strip().lower()) & F.array_contains(names, time.strip().lower())
    heads = lines.filter(is_head).groupBy("file").agg(F.first(names).alias("head"))
    rows = lines.filter(~is_head & (F.concat_ws("", "cells") != "")).join(heads, "file", "left")

    def cell(name: str) -> Column:
        return F.nullif(F.get("cells", F.array_position("head", F.lit(name.strip().lower())).cast("int") - 1), F.lit(""))

    return rows.select(
        "file",
        F.col("head").isNotNull().alias("headed"),
        cell(station).alias("station"),
        cell("District").alias("district"),
        S.number_or_null(cell("Latitude")).alias("lat"),
        S.number_or_null(cell("Longitude")).alias("lon"),
        F.try_to_timestamp(cell(time), F.lit("d-M-yyyy H:mm")).cast("timestamp_ntz").alias("t"),
        S.number_or_null(F.get("cells", F.size("head") - 1)).alias("value"),
    )


def read_telemetry(spark: SparkSession, path: str | list[str], station: str = "Station", time: str = "Data Acquisition Time", located: bool = False) -> DataFrame:
    """Telemetry files of any layout as (station, t, value); the last column of a file's own header holds the value.

    Columns are found by the header line of each file, blanks around names and case aside, so layouts may differ within a
    folder. Rows with an unreadable time or no value are dropped, and so are files without a header: ``telemetry_account`` counts
    both. ``located`` keeps district, lat and lon.
    """
    rows = _telemetry(spark, path, station, time).filter(F.col("t").isNotNull() & F.col("value").isNotNull())
    return rows.select("station", *(["district", "lat", "lon"] if located else []), "t", "value")


def telemetry_account(spark: SparkSession, path: str | list[str], station: str = "Station", time: str = "Data Acquisition Time") -> DataFrame:
    """One row per file: file, bytes, n_rows (lines below the header), kept, bad_time, no_value, reason.

    A row without a readable time counts there whatever its value. ``reason`` is null for a file that was read, else ``empty``,
    ``no header`` or ``no rows``.
    """
    ok_time, ok_value = F.col("t").isNotNull(), F.col("value").isNotNull()
    counts = _telemetry(spark, path, station, time).groupBy("file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(ok_time & ok_value).alias("kept"),
        F.count_if(F.col("headed") & ~ok_time).alias("bad_time"),
        F.count_if(F.col("headed") & ok_time & ~ok_value).alias("no_value"),
        F.bool_or("headed").alias("headed"),
    )
    j = file_listing(spark, path).join(counts, "file", "left")
    reason = F.when(F.col("bytes") == 0, "empty").when(F.col("n_rows").isNull(), "no rows").when(~F.col("headed"), "no header")
    return j.select("file", "bytes", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "kept", "bad_time", "no_value")], reason.alias("reason"))


def station_cards(rows: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Per station of located telemetry: district, lat, lon (of its first reading), rows, first and last time, and whether the place is in the box.

    ``box`` is (least lat, least lon, greatest lat, greatest lon). A station outside it, or without coordinates, keeps its
    readings, but its position is marked as untrusted.
    """
    first = F.min_by(F.struct("district", "lat", "lon"), F.struct("t", "lat", "lon", "district", "value")).alias("_c")
    cards = rows.groupBy("station").agg(first, F.count(F.lit(1)).alias("n_rows"), F.min("t").alias("first"), F.max("t").alias("last")).select("station", "_c.*", "n_rows", "first", "last")
    return cards.withColumn("position_trusted", F.coalesce(F.col("lat").between(box[0], box[2]) & F.col("lon").between(box[1], box[3]), F.lit(False)))


# fixed values: the numeric columns of a station table
MARK_NUMBERS = ("Latitude", "Longitude", "WarningLevel", "DangerLevel", "HFL", "WIMS_Value")


def read_station_marks(spark: SparkSession, path: str) -> DataFrame:
    """Station table with named leading columns; short rows are skipped, extra trailing fields ignored."""
    names = spark.read.option("header", "true").csv(path).columns
    cells = F.split(F.col("value"), CSV_COMMA)
    rows = spark.read.text(path).select(cells.alias("cells")).filter(F.size("cells") >= len(names))
    at = {n: F.trim(F.regexp_replace(F.get("cells", F.lit(i)), '^"|"$', "")) for i, n in enumerate(names)}
    rows = rows.filter(at[names[0]] != names[0])
    return rows.select(*[(S.number_or_null(c) if n in MARK_NUMBERS else c).alias(n) for n, c in at.items()])


def split_observed_forecast(wide: DataFrame, time: str, observed: str, issued: str) -> tuple[DataFrame, DataFrame]:
    """Observed rows (a reading is there) and forecast rows (after the issue time) of a wide table."""
    return wide.filter(F.col(observed).isNotNull()), wide.filter(F.col(time) > F.col(issued))


def partition_sidecar(df: DataFrame, parts: list[str], time: str, values: list[str], issued: str | None = None) -> DataFrame:
    """One metadata row per partition: rows, first, last, columns, non-null counts, issue dates."""
    cols = [
        F.count(F.lit(1)).alias("n_rows"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
        F.lit(",".join(c for c in df.columns)).alias("columns"),
        *[F.count(v).alias(f"n_{v}") for v in values],
    ]
    if issued:
        cols.append(F.count_distinct(F.col(issued)).alias("n_issued"))
    return df.groupBy(*parts).agg(*cols)


def catalog_diff(have: DataFrame, points: DataFrame, key: str, years: tuple[int, int], per_day: int = 1, share: float = 0.98) -> DataFrame:
    """Point-years that are missing or hold under 98 % of their expected rows."""
    want = points.select(key, F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))).alias("year"))
    expected = F.dayofyear(F.make_date(F.col("year"), F.lit(12), F.lit(31))) * per_day
    j = want.join(have.select(key, "year", "n_rows"), [key, "year"], "left").withColumn("expected", expected)
    return j.withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).filter(F.col("n_rows") < F.col("expected") * share)


def missing_days(have: DataFrame, keys: list[str], day: str, first: Column, last: Column) -> DataFrame:
    """Days from first to last that a key has no row for."""
    want = have.select(*keys).distinct().withColumn(day, F.explode(F.sequence(first, last)))
    return want.join(have.select(*keys, day).distinct(), [*keys, day], "left_anti")
