"""Trip features and labels, for batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import AVERAGE_SPEED_MPH, PAYMENT_TYPES, RATE_CODES
from tidemark.functions.columns import lookup

_HOUR = 3600


def add_trip_features(trips: DataFrame) -> DataFrame:
    """Add ride time in seconds, its estimate at average speed, and miles per hour.

    A trip whose two times are equal has no ride time and no speed. A ride time may be negative.
    """
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    seconds = F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)
    distance = F.col("trip_distance")
    return trips.withColumns(
        {
            "total_ride_time": F.when(pickup != dropoff, seconds),
            "estimated_ride_time": F.round(distance / AVERAGE_SPEED_MPH * 60 * 60),
        }
    ).withColumn(
        "total_speed",
        F.when(
            F.col("total_ride_time") != 0,
            F.round(distance / F.col("total_ride_time") * _HOUR),
        ),
    )


def add_trip_labels(trips: DataFrame) -> DataFrame:
    """Add the names of the payment type and the rate code."""
    return trips.withColumns(
        {
            "payment_type_name": lookup("payment_type", PAYMENT_TYPES),
            "RateCode_name": lookup("RatecodeID", RATE_CODES),
        }
    )


def enrich_trips(trips: DataFrame) -> DataFrame:
    return add_trip_labels(add_trip_features(trips))
