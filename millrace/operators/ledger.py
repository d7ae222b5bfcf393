"""Resume and failure accounting: what is pending, what failed how often, what is given up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pending(requested: DataFrame, done: DataFrame, keys: list[str], dead: DataFrame | None = None) -> DataFrame:
    """Requested rows whose key is neither done nor given up; null keys are always pending."""
    out = requested.join(done.select(*keys), keys, "left_anti")
    return out if dead is None else out.join(dead.select(*keys), keys, "left_anti")


def missing_rows(new: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """New rows to append to a ledger, one for each key that it lacks (the first by the row's digest, so a rerun agrees)."""
    fresh = new.join(ledger.select(key), key, "left_anti")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*fresh.columns)))
    return fresh.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def attempts(failures: DataFrame, item: list[str], order: list[str], most: int = 3) -> DataFrame:
    """The log with attempt (1 to most, then from 1 again as a resumed item starts anew) and action: retry, or dead_letter at the last."""
    most = max(1, most)
    n = F.row_number().over(Window.partitionBy(*item).orderBy(*order))
    attempt = ((n - 1) % most + 1).cast("int")
    return failures.withColumns({"attempt": attempt, "max_attempts": F.lit(most), "action": F.when(attempt >= most, "dead_letter").otherwise("retry")})


def latest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of the largest order of each key: one aggregation with partial results, no sort."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")


def dead_letter_summary(dead: DataFrame, by: str, stages: list[str]) -> DataFrame:
    """Dead letters of each stage for each group that has any."""
    counts = dead.groupBy(by).agg(*[F.count_if(F.col("stage") == s).cast("long").alias(f"{s}_dead_letters") for s in stages])
    return counts.where(sum((F.col(f"{s}_dead_letters") for s in stages), F.lit(0)) > 0)


def with_feedback(tries: DataFrame, item: list[str], attempt: str, issues: str) -> DataFrame:
    """Each try with the issues of the last earlier try that had any."""
    before = Window.partitionBy(*item).orderBy(attempt).rowsBetween(Window.unboundedPreceding, -1)
    return tries.withColumn("feedback", F.last(F.when(F.size(issues) > 0, F.col(issues)), ignorenulls=True).over(before))


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """Successes, failures and rejections over worker outcomes (ok, rejections)."""
    return outcomes.agg(F.count_if("ok").cast("long").alias("completed_count"), F.count_if(~F.col("ok")).cast("long").alias("failed_count"), F.coalesce(F.sum("rejections"), F.lit(0)).cast("long").alias("rejections"))


def integrity(left: DataFrame, right: DataFrame, dead: DataFrame, key: str) -> DataFrame:
    """left with status: ok if right has its key, skipped if it is given up, else error."""
    marked = left.join(right.select(key).distinct().withColumn("_right", F.lit(True)), key, "left").join(dead.select(key).distinct().withColumn("_dead", F.lit(True)), key, "left")
    return marked.withColumn("status", F.when(F.col("_right"), "ok").when(F.col("_dead"), "skipped").otherwise("error")).drop("_right", "_dead")


def source_mismatches(rows: DataFrame, source: DataFrame, key: str, same: dict[str, str]) -> DataFrame:
    """rows with issues: that the source row is missing, and each pair of columns (here: there) that differ."""
    there = source.select(F.col(key), F.struct(*same.values()).alias("_source"))
    found = rows.join(there, key, "left")
    issues = [F.when(F.col("_source").isNull(), F.lit("missing_source"))]
    issues += [F.when(F.col("_source").isNotNull() & ~F.col(a).eqNullSafe(F.col(f"_source.{b}")), F.lit(f"{a}_differs")) for a, b in same.items()]
    return found.withColumn("issues", F.array_compact(F.array(*issues))).drop("_source")


def require_none(bad: DataFrame, what: str, columns: list[str], shown: int = 3) -> None:
    """An error with the first bad rows and the number of all, if there are any."""
    rows = bad.select(*columns).limit(shown + 1).collect()
    if rows:
        more = bad.count() - min(len(rows), shown)
        raise ValueError(f"{what}: " + "; ".join(str(tuple(r)) for r in rows[:shown]) + (f" (+{more} more)" if more > 0 else ""))
