"""Registration of volume functions for SQL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import FWHM
from tessera.operators.compare import FIT, fit_profile


class Voxels:
    """``voxels(z0, y0, x0, nz, ny, nx, dtype, data)``: the values of one block as rows."""

    def eval(self, z0: int, y0: int, x0: int, nz: int, ny: int, nx: int, dtype: str, data: bytes) -> Iterator[tuple]:
        a = np.frombuffer(data, np.dtype(dtype)).reshape(nz, ny, nx)
        for (z, y, x), v in np.ndenumerate(a):
            yield z0 + z, y0 + y, x0 + x, float(v)


def _fit(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([fit_profile(np.arange(len(v), dtype=float), np.asarray(v, float)) for v in values])


def register(spark: SparkSession) -> None:
    """``voxels`` (table function), ``volume_fwhm(sigma)`` and ``fit_profile(array)``."""
    spark.udtf.register("voxels", F.udtf(Voxels, returnType="z long, y long, x long, v double"))
    spark.udf.register("fit_profile", F.pandas_udf(_fit, FIT))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION volume_fwhm(sigma DOUBLE) RETURNS DOUBLE RETURN sigma * {FWHM!r}D")
