"""Short category codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_CODE = "NA"


def norm_code(name: str) -> Column:
    """Upper case without outer blanks; '' becomes 'NA'; NULL stays NULL."""
    code = F.upper(F.trim(F.col(name).cast("string")))
    return F.when(code == "", NO_CODE).otherwise(code)
