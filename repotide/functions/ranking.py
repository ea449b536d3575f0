"""Top rows per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this setting's k Spark cuts every task's rows to k per group before the shuffle.
_EARLY_CUT_SETTING, _EARLY_CUT_DEFAULT = "spark.sql.optimizer.windowGroupLimitThreshold", "1000"
_SALTS = 256


def with_rank(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, numbered in ``rank``.

    ``order`` must be total within a group. No group travels whole to one task: Spark's
    early cut leaves k rows per task, and beyond its limit the cut is made per salt first.
    """
    if k > int(df.sparkSession.conf.get(_EARLY_CUT_SETTING, _EARLY_CUT_DEFAULT)):
        salted = df.withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.lit(_SALTS)))
        df = _cut(salted, [*group, "salt"], order, k).drop("salt", "rank")
    return _cut(df, group, order, k)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return with_rank(df, group, order, k).drop("rank")


def _cut(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
