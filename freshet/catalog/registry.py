"""The registry behind ``__spark_entry__``: one entry per operator, with its oracle text.

Compared columns are brought to one form in both engines: numbers listed under ``num`` become
integers of 1e-4 (floor of x*1e4 plus just over a half, so values on the tie lattice cannot fall
on different sides), dates and timestamps become text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.catalog import fixtures


@dataclass
class Entry:
    name: str
    build: Callable[[fixtures.Inputs], DataFrame]
    sql: str | None
    num: list[str] = field(default_factory=list)
    text: list[str] = field(default_factory=list)


ENTRIES: dict[str, Entry] = {}


def entry(name: str, sql: str | None = None, num: str = "", text: str = ""):
    """Register ``fn(inputs) -> DataFrame``; ``num`` / ``text`` list the columns to normalise."""

    def deco(fn):
        if name in ENTRIES:
            raise ValueError(f"duplicate entry {name}")
        ENTRIES[name] = Entry(name, fn, sql, num.split(), text.split())
        return fn

    return deco


def comparable(df: DataFrame, num: list[str]) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in num:
            c = F.floor(c.cast("double") * 1e4 + 0.500001).cast("bigint")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            raise TypeError(f"column {f.name} must be listed as num")
        out.append(c.alias(f.name))
    return df.select(*out)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ENTRIES[name]
    return comparable(e.build(fixtures.Inputs(spark, sf_dir)), e.num)


def oracle(name: str) -> str | None:
    e = ENTRIES[name]
    if e.sql is None:
        return None
    needed: list[str] = []

    def add(text: str) -> None:
        for view in fixtures.ORACLE_VIEWS:
            if re.search(rf"\b{view}\b", text) and view not in needed:
                add(fixtures.ORACLE_VIEWS[view])
                if view not in needed:
                    needed.append(view)

    add(e.sql)
    ctes = [f"{v} AS ({fixtures.ORACLE_VIEWS[v]})" for v in needed] + [f"answer AS ({e.sql})"]
    swaps = [f"CAST(FLOOR(CAST({c} AS DOUBLE) * 1e4 + 0.500001) AS BIGINT) AS {c}" for c in e.num]
    swaps += [f"CAST({c} AS VARCHAR) AS {c}" for c in e.text]
    replace = f" REPLACE ({', '.join(swaps)})" if swaps else ""
    return f"WITH {', '.join(ctes)} SELECT *{replace} FROM answer"
