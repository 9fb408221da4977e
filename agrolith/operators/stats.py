"""Correlations and lines from means, variances and covariances, which Spark merges without cancellation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two predictors count as collinear where their determinant is below this share of the product of their variances.
COLLINEAR = 1e-12


def correlation(cov: Column, var_x: Column, var_y: Column) -> Column:
    """Null where either side is constant."""
    ok = (var_x > 0) & (var_y > 0)
    return F.when(ok, cov / F.when(ok, F.sqrt(var_x) * F.sqrt(var_y)))


def slope(cov: Column, var_x: Column) -> Column:
    return F.when(var_x > 0, cov / F.when(var_x > 0, var_x))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b, n, r`` of each pair of columns, over rows that have both; one pass for all pairs."""
    pairs = list(combinations(columns, 2))

    def moments(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
        return F.struct(F.count(x).alias("n"), F.covar_pop(x, y).alias("xy"), F.var_pop(x).alias("xx"), F.var_pop(y).alias("yy"))

    row = df.agg(*[moments(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    each = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("m")) for i, (a, b) in enumerate(pairs)])
    m = row.select(F.explode(each).alias("p")).select("p.a", "p.b", "p.m.*")
    return m.select("a", "b", "n", correlation(F.col("xy"), F.col("xx"), F.col("yy")).alias("r"))


def least_squares(df: DataFrame, y: str, x1: str, x2: str) -> DataFrame:
    """``n, intercept, b1, b2`` of y on two predictors, from one pass; null where they are collinear."""
    d = df.where(F.col(y).isNotNull() & F.col(x1).isNotNull() & F.col(x2).isNotNull())
    c = {"y": y, "a": x1, "b": x2}
    m = d.agg(F.count(F.lit(1)).alias("n"), *[F.avg(v).alias(f"m{k}") for k, v in c.items()], *[F.covar_pop(c[p], c[q]).alias(f"{p}{q}") for p, q in ("aa", "bb", "ab", "ay", "by")])
    det = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    safe = F.when(det > COLLINEAR * F.col("aa") * F.col("bb"), det)
    b1 = (F.col("ay") * F.col("bb") - F.col("by") * F.col("ab")) / safe
    b2 = (F.col("by") * F.col("aa") - F.col("ay") * F.col("ab")) / safe
    return m.select("n", (F.col("my") - b1 * F.col("ma") - b2 * F.col("mb")).alias("intercept"), b1.alias("b1"), b2.alias("b2"))
