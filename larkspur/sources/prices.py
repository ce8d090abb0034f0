"""Daily closes from nested chart payloads: parse, check, and replace only with something better."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The range a close may lie in.
LEAST_CLOSE, MOST_CLOSE = 0.01, 10_000.0
CHART = "chart struct<result: array<struct<meta: struct<currency: string>, timestamp: array<double>, indicators: struct<quote: array<struct<close: array<double>>>>>>>"


def parse_chart(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """``symbol, currency, date, close`` of payload rows (``symbol``, JSON text): the two arrays zipped, null closes left
    out, closes rounded to cents. Arrays that are empty or differ in length fail the job."""
    chart = F.from_json(payload, CHART)["chart"]["result"][0]
    stamps, closes = chart["timestamp"], chart["indicators"]["quote"][0]["close"]
    fine = F.coalesce((F.size(stamps) > 0) & (F.size(stamps) == F.size(closes)), F.lit(False))
    pairs = F.when(fine, F.arrays_zip(stamps.alias("t"), closes.alias("c"))).otherwise(F.raise_error(F.concat(F.col("symbol"), F.lit(": malformed chart payload"))))
    rows = payloads.select("symbol", F.coalesce(chart["meta"]["currency"], F.lit("")).alias("currency"), F.explode(pairs).alias("p"))
    kept = rows.filter(F.col("p.t").isNotNull() & F.col("p.c").isNotNull())
    return kept.select("symbol", "currency", F.to_date(F.timestamp_seconds(F.col("p.t").cast("long"))).alias("date"), F.round("p.c", 2).alias("close"))


def problem(rows: Column, least: Column, most: Column, previous_rows: Column) -> Column:
    """Why a series is refused: no rows, a close out of range, or fewer rows than before; NULL if it is fine."""
    return (
        F.when(rows == 0, "no rows").when((least < LEAST_CLOSE) | (most > MOST_CLOSE), "a close out of range")
        .when(rows < previous_rows, F.concat(F.lit("series shrank "), previous_rows.cast("string"), F.lit(" to "), rows.cast("string")))
    )


def checked(series: DataFrame, previous: DataFrame) -> DataFrame:
    """``symbol, rows, problem`` for each symbol of the new series."""
    sums = series.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.min("close").alias("lo"), F.max("close").alias("hi"))
    before = previous.groupBy("symbol").agg(F.count(F.lit(1)).alias("before"))
    return sums.join(before, "symbol", "left").select("symbol", "rows", problem(F.col("rows"), F.col("lo"), F.col("hi"), F.col("before")).alias("problem"))


def accepted(series: DataFrame, previous: DataFrame) -> DataFrame:
    """The series to publish: the new one of symbols that pass, else the previous one."""
    good = checked(series, previous).filter("problem IS NULL").select("symbol")
    return series.join(good, "symbol", "left_semi").unionByName(previous.join(good, "symbol", "left_anti"))


def refresh(fetch, symbols: dict[str, str], folder: str | Path, now: int, spark) -> list[str]:
    """Fetch, parse, check and store each symbol's series; on any failure the stored one stays. Returns a report line each.

    ``fetch(symbol)`` gives (status, payload text).
    """
    said = []
    for symbol, key in symbols.items():
        path = Path(folder) / f"{key}.json"
        held = json.loads(path.read_text()) if path.exists() else None
        status, payload = fetch(symbol)
        if status != 200:
            said.append(f"{symbol}: HTTP {status}, kept")
            continue
        rows = parse_chart(spark.createDataFrame([(symbol, payload)], "symbol string, payload string")).orderBy("date")
        closes = [[str(r["date"]), r["close"]] for r in rows.collect()]  # one symbol's days
        previous = spark.createDataFrame([(symbol, c) for _, c in held["rows"]] if held else [], "symbol string, close double")
        wrong = [r["problem"] for r in checked(rows, previous).collect()] if closes else ["no rows"]
        if wrong[0]:
            said.append(f"{symbol}: refused ({wrong[0]}), kept")
            continue
        currency = rows.select("currency").first()[0]
        path.write_text(json.dumps({"symbol": symbol, "currency": currency, "updated_at": now, "rows": closes}))
        said.append(f"{symbol}: {len(closes)} rows to {closes[-1][0]}")
    return said
