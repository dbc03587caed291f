"""Category roll-up over a parent/child edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_top_category(edges: DataFrame, id_col: str = "cat_id",
                         child_col: str = "child", parent_col: str = "parent") -> DataFrame:
    """Each category with its parent one level up, or itself at a root.

    Returns ``cat_id`` (int), ``category_name``, ``top_category``.  Exactly one
    hop, as in the source pipeline: a grandparent is not followed.  The parent
    side is reduced to distinct names first, so a repeated category name can
    not multiply rows.
    """
    names = edges.select(F.col(child_col).alias("_parent_name")).distinct()
    return (edges.join(names, F.col(parent_col) == F.col("_parent_name"), "left")
                 .select(F.col(id_col).try_cast("int").alias("cat_id"),
                         F.col(child_col).alias("category_name"),
                         F.coalesce(F.col("_parent_name"), F.col(child_col))
                          .alias("top_category")))
