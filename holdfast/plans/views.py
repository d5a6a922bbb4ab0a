"""The tables under their usual names, for those who write SQL."""

from collections.abc import Mapping

from pyspark.sql import DataFrame


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make frames visible to `spark.sql` as temporary views; later ones replace earlier ones.

    Spark SQL reads payloads by path (`v:a::int`), unnests them with
    `LATERAL variant_explode`, and groups with `GROUP BY ALL`.  It has no `QUALIFY`:
    filter on the ranked column one level up.
    """
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
