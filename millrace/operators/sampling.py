"""Quotas, slots, deterministic shuffles and strata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import joined
from ..plans.dims import DECISIONS, RELATIONS


def decision_quotas(n: int, weights: dict[str, float] | None = None) -> dict[str, int]:
    """How many of n records get each decision.

    Everyone starts from half an even share times its weight, at least 1. What is left goes out by weight, leftovers one each to
    the heaviest first. If the start is too much already, decisions of weight up to 1 give back by size, then one each, the
    largest first, but never their last.
    """
    weight = {d: (weights or {}).get(d, 1.0) for d in DECISIONS}
    quota = {d: max(1, int(max(1, n // (2 * len(weight))) * w)) for d, w in weight.items()}
    spare = n - sum(quota.values())
    if spare > 0:
        whole = sum(weight.values())
        extra = {d: int(spare * (w / whole)) for d, w in weight.items()}
        heaviest = sorted(weight, key=lambda d: -weight[d])
        left = spare - sum(extra.values())
        for place, d in enumerate(heaviest):
            extra[d] += left // len(heaviest) + (place < left % len(heaviest))
        quota = {d: quota[d] + extra[d] for d in quota}
    elif spare < 0:
        light, due = [d for d in weight if weight[d] <= 1], -spare
        size = sum(quota[d] for d in light)
        for d in light:
            if due <= 0:
                break
            back = min(int(-spare * (quota[d] / size)), quota[d] - 1)
            quota[d] -= back
            due -= back
        for d in sorted(light, key=lambda d: -quota[d]):
            if due > 0 and quota[d] > 1:
                quota[d] -= 1
                due -= 1
    return quota


def label_quotas(n: int) -> dict[str, int]:
    """An even share for each sampled relation label, the first ones one more; at least 1 each."""
    labels = [names[-1] for names, *_ in RELATIONS.values() if names]
    return {label: max(1, n // len(labels) + (i < n % len(labels))) for i, label in enumerate(labels)}


def slots(spark: SparkSession, quota: dict[str, int], kind: str, seed: int) -> DataFrame:
    """(value, k, key): each value as often as its quota, with the digest by which slots are shuffled."""
    rows = spark.createDataFrame([(v, q) for v, q in quota.items() if q > 0], "value string, quota int")
    return rows.select("value", F.explode(F.sequence(F.lit(1), F.col("quota"))).alias("k")).withColumn("key", F.sha2(joined(seed, kind, F.col("value"), F.col("k")), 256))


def shuffled(df: DataFrame, key: Column, seed: int = 42) -> list[Column]:
    """The order of a deterministic shuffle by a unique key."""
    return [F.sha2(joined(seed, key), 256), key]


def shuffled_limit(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """The first n rows of a deterministic shuffle: a top-k, not a sort of all rows."""
    return df.orderBy(*shuffled(df, key, seed)).limit(n)


def per_stratum(df: DataFrame, strata: list[str], key: Column, n: Column | int, seed: int = 42) -> DataFrame:
    """Up to n rows of each stratum, the first by a deterministic shuffle. The rank limit is pushed below the shuffle by Spark."""
    rank = F.row_number().over(Window.partitionBy(*strata).orderBy(*shuffled(df, key, seed)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def by_quota(df: DataFrame, stratum: str, quota: dict[str, int], key: Column, seed: int = 42) -> DataFrame:
    """Of each stratum as many rows as its quota, or all if there are fewer, the first by a deterministic shuffle; others none."""
    most = F.create_map(*[x for k, n in quota.items() for x in (F.lit(k), F.lit(n))])[F.col(stratum)]
    return per_stratum(df.where(F.col(stratum).isin(*quota)), [stratum], key, most, seed)


def phase_quotas(n: int, shares: dict[str, float]) -> dict[str, int]:
    """n rows by shares: whole parts first, then one each by largest rest, ties in the order given."""
    whole = sum(shares.values())
    exact = {k: n * v / whole for k, v in shares.items()}
    quota = {k: int(x) for k, x in exact.items()}
    rest = sorted(exact, key=lambda k: quota[k] - exact[k])[: n - sum(quota.values())]
    return {k: q + (k in rest) for k, q in quota.items()}
