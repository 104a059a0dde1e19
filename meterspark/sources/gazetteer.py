"""Place names and identifiers out of gazetteer triples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterspark import vocabulary as V


def gazetteer_pattern(triples: DataFrame, level: str, name: str = V.GAZETTEER_NAME,
                      feature: str = V.GAZETTEER_LEVEL) -> DataFrame:
    """`(name, geo_id)` of every place of one level; the id is the last path part of its URI.

    A name that occurs more than once in a level keeps its smallest id.
    """
    of_level = (triples.filter((F.col("predicate") == feature) & (F.col("object") == level))
                .select("subject"))
    names = (triples.filter(F.col("predicate") == name)
             .select("subject", F.col("object").alias("name")))
    return (names.join(of_level, "subject", "left_semi")
            .select("name", F.element_at(F.split("subject", "/"), -2).alias("geo_id"))
            .groupBy("name").agg(F.min("geo_id").alias("geo_id")))
