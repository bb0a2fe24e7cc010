"""Vector helpers on ``array<float|double>`` columns (F10, F11), JVM-side HOFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    """sum of element-wise products, as double."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(a) -> Column:
    """divide by the L2 norm (a zero vector stays as it is).

    The norm is computed once by ``aggregate`` and used in its finish lambda
    (an outer expression inside ``transform`` would be re-evaluated per element).
    """
    arr = _c(a)
    return F.aggregate(
        arr, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"),
        lambda s: F.transform(arr, lambda x: F.when(s > 0, x.cast("double") / F.sqrt(s)).otherwise(x.cast("double"))))
