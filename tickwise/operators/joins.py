"""Joins of the app layer (C3, C4, C5) and the requested-ticker list.

Dimension joins carry no broadcast hint: the join side's size is only known
at run time, and AQE turns the join into a broadcast when the shuffled side
is measured under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.functions.columns import parse_ticker_list
from tickwise.schemas import COMPANY_INFO


def requested_tickers(spark: SparkSession, text: str) -> DataFrame:
    """I5: 'nvda, intc,,amd ' -> one row per distinct symbol (upper, trimmed)."""
    df = spark.createDataFrame([(text,)], "tickers string")
    return df.select(F.explode(parse_ticker_list(F.col("tickers"))).alias("ticker")).distinct()


def known_tickers(req: DataFrame, bars: DataFrame) -> DataFrame:
    """C4: requested symbols that have data (left semi)."""
    return req.join(bars.select("ticker"), "ticker", "left_semi")


def missing_tickers(req: DataFrame, bars: DataFrame) -> DataFrame:
    """Requested symbols without data (left anti) - reported, never fatal."""
    return req.join(bars.select("ticker"), "ticker", "left_anti")


def company_info(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, COMPANY_INFO)


def enrich_company(df: DataFrame, info: DataFrame) -> DataFrame:
    """Left join to company info; name defaults to the ticker, sector and
    industry to 'N/A'."""
    j = df.join(info, "ticker", "left")
    return j.withColumns({
        "longName": F.coalesce(F.col("longName"), F.col("ticker")),
        "sector": F.coalesce(F.col("sector"), F.lit("N/A")),
        "industry": F.coalesce(F.col("industry"), F.lit("N/A")),
    })
