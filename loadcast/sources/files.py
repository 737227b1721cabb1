"""File sources and sinks: raw weather cleaning, typed CSV, Parquet, tables.

Strict mode (the default) matches the reference's all-or-nothing behaviour:
under ANSI a bad date or number raises inside the job, the write's commit
never happens, and no output appears.  ``on_error="quarantine"`` instead
returns ``(good, bad)`` so bad rows can be written aside.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.functions.timekeys import format_key
from loadcast.schemas import KEY, WEATHER_MEASURES

log = logging.getLogger(__name__)

PARTS = ["YEAR", "MO", "DY", "HR"]


def read_raw_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw weather CSV with a header; every column read as text (typed later).

    Columns are matched by header name, so extra columns are harmless and
    missing ones can be reported instead of shifting positions.
    """
    return _read_by_header(spark, path)


def _read_by_header(spark: SparkSession, path: str) -> DataFrame:
    """Text columns named by the header of the first file; a file whose header differs raises
    (Spark would otherwise read it by position)."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_by_own_headers(spark: SparkSession, path: str, wanted: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, files set aside): the ``wanted`` columns as text, found in every file by that file's own header.

    Files may have the columns in any order and others besides.  A file that lacks
    a wanted column is set aside whole, as (file, missing); an empty file has no header
    and no rows.  A header's names are split at commas, quotes around them are dropped.  The files
    are read twice, the first time for their first lines.
    """
    file, start = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    lines = spark.read.text(path).select("value", file, start, F.monotonically_increasing_id().alias("place")).where(F.trim("value") != "")
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("start", "place")).alias("line"))
    names = F.transform(F.split(F.regexp_replace("line", "^\ufeff", ""), ","), lambda n: F.regexp_replace(F.trim(n), '^"|"$', ""))
    heads = first.select("file", names.alias("names"))
    missing = F.filter(F.array(*[F.lit(w) for w in wanted]), lambda w: ~F.array_contains(F.col("names"), w))
    heads = heads.withColumn("missing", missing)
    width = heads.agg(F.max(F.size("names"))).first()[0] or 0  # one scalar
    columns = [f"c{i}" for i in range(max(width, 1))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = spark.read.schema(schema).option("header", True).csv(path).select("*", F.col("_metadata.file_path").alias("file"))
    whole = rows.join(heads.where(F.size("missing") == 0).drop("missing"), "file")
    cell = {w: F.get(F.array(*columns), F.array_position("names", w).cast("int") - 1) for w in wanted}
    return whole.select(*[c.alias(w) for w, c in cell.items()]), heads.where(F.size("missing") > 0).select("file", "missing")


def _wanted_measures(df: DataFrame, measures: Sequence[str]) -> list[str]:
    present = [m for m in measures if m in df.columns]
    missing = [m for m in measures if m not in df.columns]
    if missing:
        log.warning("columns missing from the raw weather input: %s", missing)
    return present


def clean_weather(df: DataFrame, on_error: str = "raise", ordered: bool = False):
    """YEAR/MO/DY/HR parts -> ``datetime_ept`` (TIMESTAMP_NTZ) + weather measures.

    ``on_error="raise"``: an impossible date (hour 24, 30 February, text, an
    empty part) fails the job.  ``on_error="quarantine"``: returns ``(good, bad)``, bad
    rows keeping their raw parts.  Missing measure columns are dropped with a
    warning.  Parts are combined arithmetically, never by string padding.
    """
    measures = _wanted_measures(df, WEATHER_MEASURES)
    if on_error == "raise":
        parts = [_not_null_or_fail(p).cast("int") for p in PARTS]
        ts = F.make_timestamp_ntz(*parts, F.lit(0), F.lit(0))
        out = df.select(ts.alias(KEY), *[F.col(m).cast("double").alias(m) for m in measures])
        return out.orderBy(KEY) if ordered else out
    if on_error != "quarantine":
        raise ValueError(f"on_error must be 'raise' or 'quarantine', not {on_error!r}")
    parts = [F.col(p).try_cast("int") for p in PARTS]
    ts = F.try_make_timestamp_ntz(*parts, F.lit(0), F.lit(0))
    vals = {m: F.col(m).try_cast("double") for m in measures}
    bad_measure = F.lit(False)
    for m, v in vals.items():
        bad_measure = bad_measure | (F.col(m).isNotNull() & v.isNull())
    tagged = df.withColumn("_ts", ts).withColumn("_bad", F.col("_ts").isNull() | bad_measure)
    good = tagged.where(~F.col("_bad")).select(
        F.col("_ts").alias(KEY), *[v.alias(m) for m, v in vals.items()]
    )
    bad = tagged.where(F.col("_bad")).drop("_ts", "_bad")
    return (good.orderBy(KEY) if ordered else good), bad


def _not_null_or_fail(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"empty value in column {c}"))).otherwise(F.col(c))


def read_series_csv(spark: SparkSession, path: str, schema: T.StructType, on_error: str = "raise"):
    """Typed series CSV (header, empty lines skipped), columns matched by header name.

    Strict: a non-numeric or empty measure fails the job.  Quarantine:
    returns ``(good, bad)`` with bad rows as raw text.
    """
    raw = _read_by_header(spark, path)
    names = [f.name for f in schema.fields]
    missing = [n for n in names if n not in raw.columns]
    if missing:
        raise ValueError(f"CSV {path} lacks columns {missing}")
    return typed_series(raw, schema, on_error)


def typed_series(raw: DataFrame, schema: T.StructType, on_error: str = "raise"):
    """Text columns to the types of ``schema``, strictly or with bad rows set aside (see ``read_series_csv``)."""
    names = [f.name for f in schema.fields]
    if on_error == "raise":
        typed = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        return typed.select(*[_not_null_or_fail(n) .alias(n) for n in names])
    casts = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    bad_cond = F.lit(False)
    for n, c in casts.items():
        bad_cond = bad_cond | c.isNull()
    tagged = raw.withColumn("_bad", bad_cond)
    good = tagged.where(~F.col("_bad")).select(*[c.alias(n) for n, c in casts.items()])
    bad = tagged.where(F.col("_bad")).drop("_bad")
    return good, bad


def write_series_csv(df: DataFrame, path: str, order: str | None = KEY, mode: str = "errorifexists") -> None:
    """CSV with a header; sorted by ``order`` when given (a range shuffle)."""
    out = df.orderBy(order) if order else df
    if KEY in df.columns and isinstance(df.schema[KEY].dataType, T.TimestampNTZType):
        out = out.withColumn(KEY, format_key(KEY))
    out.write.mode(mode).option("header", True).csv(path)


def write_series_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Snappy Parquet; returns the rows written, counted during the write itself."""
    obs = Observation("rows_written")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.mode(mode).option(
        "compression", "snappy"
    ).parquet(path)
    return int(obs.get["n"])


def external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, temporary: bool = False
) -> DataFrame:
    """Declare a Parquet table over an existing folder (no data moved).

    ``temporary=True`` declares a session-scoped view instead, leaving no
    entry in a shared metastore.
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if temporary:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} ({cols}) USING PARQUET OPTIONS (path '{path}')")
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING PARQUET LOCATION '{path}'")
    return spark.table(name)


def training_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Persist the feature set as a Parquet table; fails if the table exists."""
    df.write.format("parquet").mode("errorifexists").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)

