"""What to do with a page's orientation class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The correction in degrees of each class, and the page rotation that a logical correction sets.
CORRECTIONS = (0, 270, 180, 90)
LOGICAL = {90: 270, 180: 180, 270: 90}


def correction(cls: Column, confidence: Column, least: float = 0.5) -> Column:
    """Degrees to turn by; 0 where the classifier isn't sure, null where it failed."""
    known = F.element_at(F.array(*(F.lit(c) for c in CORRECTIONS)), cls + 1)
    return F.when(cls.isNull(), F.lit(None)).when(confidence > least, known).otherwise(F.lit(0)).cast("int")


def page_rotation(angle: Column) -> Column:
    out = F.lit(0)
    for turned, said in LOGICAL.items():
        out = F.when(angle == turned, said).otherwise(out)
    return out.cast("int")


def upside_down(conf_normal: Column, conf_turned: Column) -> Column:
    return conf_turned > conf_normal
