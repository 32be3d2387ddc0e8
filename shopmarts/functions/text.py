"""Display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sentence_case(code: Column) -> Column:
    """``mobile_app`` becomes ``Mobile app``: one capital in front, underscores as spaces."""
    words = F.replace(F.lower(code), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))
