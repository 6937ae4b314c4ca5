"""Point text, ``POINT (lon lat)``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_POINT = rf"(?i)^\s*POINT\s*\(\s*({_NUMBER})\s+({_NUMBER})\s*\)\s*$"


def parse_point(value: Column, label: str = "point") -> Column:
    """``struct<lon:double, lat:double>``; NULL or empty gives NULL, other text raises."""
    text = F.when(value != "", value)
    bad = F.raise_error(F.concat(F.lit(f"{label}: not a point: '"), text, F.lit("'")))

    def part(group: int) -> Column:
        return F.regexp_extract(text, _POINT, group).try_cast("double")

    point = F.struct(part(1).alias("lon"), part(2).alias("lat"))
    return F.when(F.rlike(text, F.lit(_POINT)), point).when(text.isNotNull(), bad)
