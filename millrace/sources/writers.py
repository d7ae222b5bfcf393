"""Sinks: views by domain with a manifest, ledgers, shards of a byte budget with offset indexes, run documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import missing_rows
from ..operators.qa import VIEW, merge_counts, merged, name_conflicts
from .readers import MANIFEST
from .scratch import stored


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written aside and renamed, through Spark's file systems."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, aside = hadoop.Path(path), hadoop.Path(f"{path}.tmp")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(aside, target):
        raise OSError(f"{path} can't be replaced")


def write_json(spark: SparkSession, path: str, doc: dict) -> None:
    write_text(spark, path, json.dumps(doc, ensure_ascii=False, indent=2, default=str))


def append_log(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def write_view(rows: DataFrame, path: str, run_id: str, language: str, refresh: list[str] | None = None) -> dict:
    """Export rows by domain, and their manifest. refresh: only these domains are written anew, the others stay as they are."""
    spark = rows.sparkSession
    if refresh is not None:
        rows = rows.where(F.col("domain_slug").isin(*refresh))
    rows.repartition("domain_slug").write.partitionBy("domain_slug").option("partitionOverwriteMode", "dynamic" if refresh is not None else "static").mode("overwrite").json(f"{path}/data")
    written = spark.read.schema(rows.schema).json(f"{path}/data")
    counts = written.groupBy("domain_slug").agg(F.min("domain").alias("domain"), F.count("*").alias("records")).orderBy("domain_slug").collect()
    manifest = MANIFEST | {
        "run_id": run_id, "language": language, "view_id": VIEW, "total_records": sum(r.records for r in counts), "fields": rows.columns,
        "domains": [{"slug": r.domain_slug, "domain": r.domain, "records": r.records, "file": f"data/domain_slug={r.domain_slug}"} for r in counts],
    }
    write_json(spark, f"{path}/manifest.json", manifest)
    return manifest


def append_missing(new: DataFrame, path: str, key: str) -> DataFrame:
    """Appends the rows whose key a ledger of Parquet lacks; a rerun appends nothing."""
    spark = new.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        new = missing_rows(new, spark.read.schema(new.schema).parquet(path), key)
    new.write.mode("append").parquet(path)
    return spark.read.schema(new.schema).parquet(path)


def shard_numbers(lengths: Column, most: int) -> Column:
    """The shard of each of the ordered lengths: a new one starts where a record would pass the budget, however large it is."""
    start = F.struct(F.lit(0).alias("shard"), F.lit(0).cast("long").alias("size"), F.array().cast("array<int>").alias("out"))

    def step(s, n):
        over = (s["size"] > 0) & (s["size"] + n > most)
        shard = s["shard"] + F.when(over, 1).otherwise(0)
        return F.struct(shard.alias("shard"), F.when(over, n).otherwise(s["size"] + n).cast("long").alias("size"), F.concat(s["out"], F.array(shard)).alias("out"))

    return F.aggregate(lengths, start, step, lambda s: s["out"])


def greedy_shards(rows: DataFrame, group: str, order: str, length: str, most: int) -> DataFrame:
    """rows with shard_index, by greedy rollover within each group. A group's rows stream through one task in order, with only
    the open shard's size held; groups are few and large by nature, so spread_shards is the form for one that outgrows a task."""
    import pandas as pd

    names = [f.name for f in rows.schema]

    def f(batches):
        shard, size, now = 0, 0, None
        for b in batches:
            out = []
            for g, n in zip(b[group], b[length]):
                if g != now:
                    shard, size, now = 0, 0, g
                if size and size + n > most:
                    shard, size = shard + 1, 0
                size += n
                out.append(shard)
            yield b[names].assign(shard_index=pd.Series(out, index=b.index, dtype="int32"))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", shard_index int"
    return rows.repartition(group).sortWithinPartitions(group, order).mapInPandas(f, schema)


def spread_shards(rows: DataFrame, group: str, order: str, length: str, most: int, index: DataFrame | None = None) -> DataFrame:
    """rows with shard_index = floor(bytes before / budget) and offset within the shard, by running sums.

    Ranges of (group, order) spread a large group over partitions; sums run within a range, and what is before it comes from one
    sum for each range and group by a broadcast. index: (group, shard_index, before, length) of records that are there already,
    after which the new ones go.
    """
    from pyspark.sql import Window

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(rows.repartitionByRange(parts, group, order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part", group).agg(F.sum(length).cast("long").alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_part", F.col(group).alias("_group"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    own = Window.partitionBy("_part", group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(F.broadcast(before), (ranged["_part"] == before["_part"]) & F.col(group).eqNullSafe(F.col("_group"))).drop(before["_part"]).drop("_group")
    if index is not None:
        ends = index.groupBy(F.col(group).alias("_group")).agg(F.max(F.col("before") + F.col("length")).alias("_end"))
        placed = placed.join(F.broadcast(ends), F.col(group).eqNullSafe(F.col("_group")), "left").withColumn("_base", F.col("_base") + F.coalesce("_end", F.lit(0))).drop("_group", "_end")
    placed = placed.withColumn("_before", (F.col("_base") + F.coalesce(F.sum(length).over(own), F.lit(0))).cast("long"))
    placed = stored(placed.withColumn("shard_index", F.floor(F.col("_before") / most).cast("int")).drop("_base", "_part"))
    starts = placed.select(group, "shard_index", "_before")
    starts = starts if index is None else starts.unionByName(index.select(group, "shard_index", F.col("before").alias("_before")))
    first = starts.groupBy(group, "shard_index").agg(F.min("_before").alias("_first")).withColumnRenamed(group, "_group")
    out = placed.join(first, placed[group].eqNullSafe(first["_group"]) & (placed["shard_index"] == first["shard_index"])).drop(first["shard_index"])
    return out.withColumn("offset", F.col("_before") - F.col("_first")).withColumnRenamed("_before", "before").drop("_first", "_group")


def shard_stats(rows: DataFrame, group: str, length: str) -> DataFrame:
    """Records, data bytes and index bytes of each shard."""
    return rows.groupBy(group, "shard_index").agg(F.count("*").alias("sample_count"), F.sum(length).cast("long").alias("data_bytes"), (F.count("*") * 8).alias("offsets_bytes"))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def append_shards(rows: DataFrame, path: str, most: int, group: str = "bloom_level", order: str = "sample_id") -> DataFrame:
    """Appends rows (group, order, line) to sharded text and to its offset index, and gives the index: group, order, shard_index,
    before (the group's bytes before), offset, length. Offsets count a shard's lines in the order of the index, with line ends."""
    spark = rows.sparkSession
    index = f"{path}/offsets"
    old = spark.read.parquet(index) if _exists(spark, index) else None
    sized = rows.select(group, order, "line", (F.octet_length("line") + 1).cast("long").alias("length"))
    placed = stored(spread_shards(sized, group, order, "length", most, old))
    placed.select(group, "shard_index", order, "line").repartition(group, "shard_index").sortWithinPartitions(group, "shard_index", order).drop(order).write.partitionBy(group, "shard_index").mode("append").text(f"{path}/data")
    placed.select(group, order, "shard_index", "before", "offset", "length").write.mode("append").parquet(index)
    return spark.read.parquet(index)


def write_dataset(rows: DataFrame, path: str, order: list[str]) -> dict:
    """All domains as one dataset in the order of (domain_slug, order), and its manifest of counts."""
    rows.repartitionByRange("domain_slug", *order).sortWithinPartitions("domain_slug", *order).write.mode("overwrite").json(f"{path}/dataset")
    counts = rows.groupBy("domain_slug").agg(F.count("*").alias("records")).orderBy("domain_slug").collect()
    manifest = {"total_records": sum(r.records for r in counts), "domains": [{"slug": r.domain_slug, "records": r.records} for r in counts]}
    write_json(rows.sparkSession, f"{path}/manifest.json", manifest)
    return manifest


def write_merged(sources: list[DataFrame], columns: list[str], path: str, run_id: str, language: str, dedupe: bool = True) -> dict:
    """Several views as one by domain, with a manifest that has each source's rows and those kept."""
    rows = stored(merged(sources, columns, dedupe))
    if name_conflicts(rows, "domain_slug", "domain").count():
        raise ValueError("a domain has several names")
    manifest = write_view(rows.where("kept").select(*columns), path, run_id, language)
    counts = {r.src_ord: r for r in merge_counts(rows).collect()}
    manifest = manifest | {"sources": [{"place": i, "records": counts[i].records if i in counts else 0, "kept": counts[i].kept if i in counts else 0} for i in range(len(sources))]}
    write_json(sources[0].sparkSession, f"{path}/manifest.json", manifest)
    return manifest


def merged_outputs(base: dict, *more: dict | None) -> dict:
    """Output maps {section: {name: fields}} merged field by field, later ones first; the given ones stay as they are."""
    out: dict = {}
    for outputs in (base, *more):
        for section, values in (outputs or {}).items():
            for name, fields in values.items():
                out.setdefault(section, {}).setdefault(name, {}).update(fields)
    return out


def write_shards(rows: DataFrame, path: str, group: str = "bloom_level") -> None:
    """Rows (group, shard_index, line) as text, one folder for each group and shard."""
    rows.select(group, "shard_index", "line").repartition(group, "shard_index").write.partitionBy(group, "shard_index").mode("overwrite").text(path)
