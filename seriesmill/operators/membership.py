"""Membership and lookup joins: symbol universes, existence, catalogue dimensions.

No side is broadcast by hand: lists of symbols and dimensions come from the
caller, so their size is not known here and adaptive execution decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.fixed_values import MACRO_CATALOGUE
from seriesmill.functions.names import squash_symbol
from seriesmill.operators.dedupe import keep_one
from seriesmill.operators.matching import null_safe_join


def supported(df: DataFrame, universe: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose symbol, without its slash, is in the universe."""
    return _squashed(df, key).join(
        _listed(universe, key), "_squashed", "left_semi"
    ).drop("_squashed")


def rejected(df: DataFrame, universe: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows whose symbol, without its slash, is not in the universe."""
    return _squashed(df, key).join(
        _listed(universe, key), "_squashed", "left_anti"
    ).drop("_squashed")


def _squashed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("_squashed", squash_symbol(F.col(key)))


def _listed(universe: DataFrame, key: str) -> DataFrame:
    return universe.select(squash_symbol(F.col(key)).alias("_squashed"))


def exists(requested: DataFrame, stored: DataFrame, series: list[str]) -> DataFrame:
    """Requested series with a boolean column ``present``; a null key is a key like others."""
    found = stored.select(*series).distinct().withColumn("_found", F.lit(True))
    return null_safe_join(requested, found, series, "left").select(
        *requested.columns, F.coalesce("_found", F.lit(False)).alias("present")
    )


def describe(df: DataFrame, catalogue: DataFrame, on: list[str]) -> DataFrame:
    """Attach catalogue columns; series without an entry keep nulls.

    The catalogue has one entry per key; a key listed twice would repeat rows,
    so only its least entry counts.
    """
    rest = [F.col(c).asc() for c in catalogue.columns if c not in on]
    return df.join(keep_one(catalogue, on, rest) if rest else catalogue.distinct(), on, "left")


def macro_catalogue(spark) -> DataFrame:
    """The macro series that can be collected, as a dimension table."""
    return spark.createDataFrame(
        MACRO_CATALOGUE, "kind STRING, freq STRING, key STRING, id STRING, name STRING"
    )


def name_collisions(
    datasets: DataFrame, normalized: str, dataset: str = "dataset"
) -> DataFrame:
    """Datasets that share a normalised name with another dataset.

    One row per dataset with the number sharing its name; nothing is gathered
    into lists, so a name shared by very many datasets stays spread out.
    """
    pairs = datasets.select(normalized, dataset).distinct()
    shared = (
        pairs.groupBy(normalized)
        .agg(F.count("*").alias("n_datasets"))
        .filter("n_datasets > 1")
    )
    return pairs.join(shared, normalized)
