"""Small fixed row sets (lookup values, audit records) as JVM-side frames.

``spark.createDataFrame(list)`` goes through a Python-backed RDD scan and
starts Python workers; a frame parsed from one JSON literal stays in the JVM
and is planned like any other expression.  Only for small, fixed row sets.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """``rows`` (tuples in the order of ``schema``) as a frame of that schema.

    The rows travel as one JSON array literal, expanded with ``from_json`` and
    ``inline``: a handful of calls into the JVM whatever the row count, and
    JSON escaping keeps any text (error messages, quotes) intact.
    """
    names = [f.name for f in schema.fields]
    text = json.dumps([dict(zip(names, row)) for row in rows], default=str)
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), ArrayType(schema))))
