"""Market-side tables and processed Parquet tables."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from valora import config
from valora.functions.dates import parse_date
from valora.operators.relational import or_semi_filter, semi_filter

PLAYERS = "player_id BIGINT, name STRING, last_name STRING, date_of_birth DATE"
VALUATIONS = ("player_id BIGINT, date DATE, market_value_in_eur DOUBLE, "
              "player_club_domestic_competition_id STRING")
CLUBS = "club_id BIGINT, domestic_competition_id STRING"
TRANSFERS = ("player_id BIGINT, player_name STRING, transfer_date DATE, transfer_season STRING, "
             "from_club_id BIGINT, to_club_id BIGINT, from_club_name STRING, to_club_name STRING, "
             "transfer_fee STRING, market_value_in_eur STRING")


@dataclass(frozen=True)
class MarketTables:
    players: DataFrame
    valuations: DataFrame
    clubs: DataFrame
    transfers: DataFrame


def _schema(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV scan of the declared columns, found by header name whatever else the file holds.

    Values are read as text and converted: a date or number that does not parse is null.
    """
    wanted = _schema(schema)
    raw = spark.read.csv(path, header=True, multiLine=False, escape='"')

    def convert(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            return parse_date(c).alias(field.name)
        if isinstance(field.dataType, (T.LongType, T.IntegerType)):
            # ids of a nullable column may be written as 12.0
            return c.try_cast("double").try_cast(field.dataType).alias(field.name)
        return c.try_cast(field.dataType).alias(field.name)

    return raw.select(*[convert(f) for f in wanted.fields])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, escape='"')


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("season",)) -> None:
    """Processed table as Parquet; the season directory allows partition pruning."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def from_records(spark: SparkSession, rows: Sequence, schema: str | T.StructType) -> DataFrame:
    """Small in-memory table; the explicit schema also holds for no rows."""
    return spark.createDataFrame(list(rows), schema=schema)


def filter_market(players: DataFrame, valuations: DataFrame, clubs: DataFrame, transfers: DataFrame,
                  competition_ids: Sequence[str] | None = None) -> MarketTables:
    """Restrict the four tables to the competitions: clubs and valuations by competition,
    players by valuation history, transfers by either club."""
    wanted = list(competition_ids or config.DEFAULT_COMPETITIONS)
    clubs = clubs.filter(F.col("domestic_competition_id").isin(wanted))
    valuations = valuations.filter(F.col("player_club_domestic_competition_id").isin(wanted))
    players = semi_filter(players, valuations, {"player_id": "player_id"})
    transfers = or_semi_filter(transfers, ["from_club_id", "to_club_id"], clubs, "club_id")
    return MarketTables(players, valuations, clubs, transfers)


def load_market(spark: SparkSession, directory: str, competition_ids: Sequence[str] | None = None) -> MarketTables:
    """Read and filter ``players, player_valuations, clubs, transfers`` from CSV files."""
    read = {
        name: read_csv(spark, os.path.join(directory, f"{name}.csv"), schema)
        for name, schema in [("players", PLAYERS), ("player_valuations", VALUATIONS),
                             ("clubs", CLUBS), ("transfers", TRANSFERS)]
    }
    return filter_market(read["players"], read["player_valuations"], read["clubs"], read["transfers"],
                         competition_ids)
