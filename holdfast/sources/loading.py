"""Loading into a table that already has a layout."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _by_lower_name(df: DataFrame) -> dict[str, str]:
    names: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in names:
            raise ValueError(f"columns {names[name.lower()]!r} and {name!r} differ only in case")
        names[name.lower()] = name
    return names


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def load_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """Match columns by name ignoring case; absent ones are NULL, extra ones are dropped."""
    present = _by_lower_name(df)
    picked = []
    for field in target.fields:
        name = present.get(field.name.lower())
        value = F.lit(None) if name is None else F.col(_quoted(name))
        picked.append(value.cast(field.dataType).alias(field.name))
    return df.select(*picked)


def load_positional(df: DataFrame, target: T.StructType) -> DataFrame:
    """Match columns by place.  Surplus input columns are left out; too few is an error."""
    if len(df.columns) < len(target.fields):
        raise ValueError(f"{len(df.columns)} input columns for {len(target.fields)} table columns")
    places = [f"c{place}" for place in range(len(df.columns))]
    renamed = df.toDF(*places)
    return renamed.select(
        *(F.col(place).cast(field.dataType).alias(field.name)
          for place, field in zip(places, target.fields, strict=False))
    )


def evolve_append(base: DataFrame, new: DataFrame) -> DataFrame:
    """Append by name ignoring case; columns only one side has are NULL on the other.

    The table's own spelling of a name wins.
    """
    known = _by_lower_name(base)
    _by_lower_name(new)
    aligned = new.select(
        *(F.col(_quoted(name)).alias(known.get(name.lower(), name)) for name in new.columns)
    )
    return base.unionByName(aligned, allowMissingColumns=True)
