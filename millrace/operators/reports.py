"""Distributions and roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bar


def distribution(df: DataFrame, key: str, pos: str) -> DataFrame:
    """(value, n, first): how often each value occurs and where first; the report's order is n descending, then first."""
    return df.groupBy(F.col(key).alias("value")).agg(F.count("*").alias("n"), F.min(pos).alias("first"))


def distributions(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """(dimension, value, n, first) of several keys in one pass, by grouping sets."""
    sets = df.groupingSets([[k] for k in keys], *keys).agg(F.grouping_id().alias("_set"), F.count("*").alias("n"), F.min(pos).alias("first"))
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    all_bits = (1 << len(keys)) - 1
    dimension, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k in keys:
        here = F.col("_set") == all_bits - bit[k]
        dimension, value = F.when(here, F.lit(k)).otherwise(dimension), F.when(here, F.col(k).cast("string")).otherwise(value)
    return sets.select(dimension.alias("dimension"), value.alias("value"), "n", "first")


def rollup_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows of each key, and of all with a null key and is_total."""
    return df.rollup(key).agg(F.count("*").alias("records"), F.grouping(key).cast("int").alias("is_total"))


def histogram(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Counts with shares in percent and a bar, known values in their order, then others by name."""
    known = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(order)], f"{key} string, place int")
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    percent = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
    rows = n.withColumn("percent", percent).join(F.broadcast(known), key, "left")
    return rows.select(key, "n", "percent", bar(F.col("percent")).alias("bar"), F.coalesce("place", F.lit(len(order))).alias("place"))


def readiness(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts of both sides, and whether there is anything to pair."""
    both = left.agg(F.count("*").alias("payloads")).crossJoin(right.agg(F.count("*").alias("texts")))
    return both.withColumn("readiness", F.when((F.col("payloads") > 0) & (F.col("texts") > 0), "ready").otherwise("blocked"))


def diversity(df: DataFrame, domain: str, level: str) -> DataFrame:
    """Distinct domains (the empty one counts), distinct levels (it doesn't), and a warning below three levels."""
    out = df.agg(F.count_distinct(domain).alias("domains"), F.count_distinct(F.nullif(F.col(level), F.lit(""))).alias("levels"))
    return out.withColumn("few_levels", F.col("levels") < 3)


def calibration(df: DataFrame, by: list[str], confidence: Column, correct: Column) -> DataFrame:
    """Share of confident misses, and the correlation of confidence and success, by group and over all."""
    own = df.select(*by, confidence.cast("double").alias("_c"), correct.cast("double").alias("_y"))
    return own.rollup(*by).agg(F.count("*").alias("n"), F.avg(F.when((F.col("_c") >= 0.5) & (F.col("_y") < 0.5), 1.0).otherwise(0.0)).alias("overconfident"), F.corr("_c", "_y").alias("agreement"))


def stage_status(items: DataFrame, by: str, done: Column, failed: Column) -> DataFrame:
    """For each group: items, finished and failed ones, and the status of the whole."""
    n = items.groupBy(by).agg(F.count("*").alias("total"), F.count_if(done).alias("completed"), F.count_if(failed).alias("failed"))
    status = F.when(F.col("completed") + F.col("failed") < F.col("total"), "running").when(F.col("failed") == 0, "completed").when(F.col("completed") == 0, "failed").otherwise("completed_with_failures")
    return n.withColumn("status", status)


def folded_state(deltas: DataFrame, key: str, order: str, layer: str, block: str, value: str, authority: dict[str, list[str]]) -> DataFrame:
    """The last value of each block of each key, from ordered changes that their layer may make."""
    rows = [(k, b) for k, blocks in authority.items() for b in blocks]
    may = deltas.sparkSession.createDataFrame(rows, f"{layer} string, {block} string")
    allowed = deltas.join(F.broadcast(may), [layer, block], "left_semi")
    return allowed.groupBy(key, block).agg(F.max_by(value, order).alias(value), F.count("*").alias("changes"))


def failure_events(log: DataFrame, line: str = "value") -> DataFrame:
    """One row: the lines of a failure log that aren't blank."""
    return log.agg(F.count_if(F.trim(line) != "").alias("failures"))


def preflight(payloads: DataFrame, texts: DataFrame, samples: tuple[int, int] = (5, 3)) -> dict:
    """The report before a composition: totals, distributions of both sides, first samples, readiness and warnings."""
    sides = {}
    for name, rows, keys, order, shown, columns in (
        ("payloads", payloads, ["domain_slug", "bloom_level"], "payload_id", samples[0], ["payload_id", "domain_slug", "bloom_level", F.left("request_text", F.lit(80)).alias("request_preview")]),
        ("texts", texts, ["will_help_now", "response_intent"], "record_id", samples[1], ["record_id", "policy_decision", "response_intent"]),
    ):
        found = distributions(rows, keys, order).collect()
        ordered = lambda k, found=found: {r.value: r.n for r in sorted((r for r in found if r.dimension == k), key=lambda r: (-r.n, r.first))}
        total = sum(r.n for r in found if r.dimension == keys[0])
        sides[name] = {"total": total, **{k: ordered(k) for k in keys}, "sample": [r.asDict() for r in rows.orderBy(order).limit(shown).select(*columns).collect()]}
    ready = sides["payloads"]["total"] > 0 and sides["texts"]["total"] > 0
    levels = [x for x in sides["payloads"]["bloom_level"] if x]
    warnings = ["no payloads"] * (not sides["payloads"]["total"]) + ["no texts"] * (not sides["texts"]["total"]) + ["fewer than three levels"] * (len(levels) < 3)
    return sides | {"estimated_samples": sides["payloads"]["total"] if ready else 0, "readiness": "ready" if ready else "blocked", "warnings": warnings}
