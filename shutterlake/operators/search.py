"""Search trends counted from a search log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shutterlake.functions import columns as X


def search_trends(log: DataFrame, term: Column | str, searched_at: Column | str) -> DataFrame:
    """Searches per term and day, in the category 'trending'."""
    return (
        log.groupBy(
            X.col(term).alias("search_term"), F.to_date(X.col(searched_at)).alias("trend_date")
        )
        .agg(F.count("*").alias("search_count"))
        .withColumn("category", F.lit("trending"))
    )
