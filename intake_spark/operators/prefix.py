"""Path-prefix join (J5) and the sub-path predicate (P5).

"Which roots enclose this path" is a theta join (``startswith``). Each path
is exploded into its enclosing prefixes (bounded by path depth) and joined on
equality, so the join is a hash/broadcast equi-join instead of a nested loop.
All enclosing roots are returned, not only the longest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import ancestors

def enclosing_roots(paths: DataFrame, roots: DataFrame, path_col: str = "path") -> DataFrame:
    """``paths`` x ``roots`` where the path equals or lies below the root.

    Roots are normalised (trailing '/' removed). The root table is broadcast
    when its measured size allows (AQE); a path has at most depth-many
    prefixes, so the exploded side stays proportional to the input.
    """
    r = roots.select("root", F.regexp_replace("root", "/+$", "").alias("_key")).distinct()
    ex = paths.select("*", F.explode(ancestors(F.col(path_col))).alias("_key"))
    return ex.join(r, "_key").drop("_key")
