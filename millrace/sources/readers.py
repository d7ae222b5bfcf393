"""Sources: JSON lines, views with manifests, item folders, sharded text, and payload adapters."""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import percent_decode
from ..operators.qa import payloads as payload_rows

BAD = "_corrupt_record"


def json_lines(spark: SparkSession, path, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Rows of JSON lines; blank lines drop out. A bad line is an error, or is skipped if not strict."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def rejected_lines(spark: SparkSession, path, schema: T.StructType | str) -> DataFrame:
    """The lines that don't parse, with their file."""
    own = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = F.from_json("value", T.StructType([*own.fields, T.StructField(BAD, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    rows = spark.read.text(path).where(F.trim("value") != "").select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), parsed[BAD].alias("bad"))
    return rows.where("bad is not null").drop("bad")


def read_json(spark: SparkSession, path: str) -> dict | None:
    """One small JSON document, through Spark's file systems; None if there is none."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


MANIFEST = {"format": "qa_view", "format_version": 1, "export_schema_version": 2, "task_family": "qa_corpus", "view_id": "qa_export_sft_v1"}


def manifest_issues(manifest: dict) -> list[str]:
    """The contract's fields that differ."""
    return [k for k, v in MANIFEST.items() if manifest.get(k) != v]


def view(spark: SparkSession, path: str, schema: T.StructType | str, domain: str | None = None) -> DataFrame:
    """A partitioned view: manifest first, then only the listed domains, or the one asked for (its partition alone is read)."""
    manifest = read_json(spark, f"{path}/manifest.json")
    if manifest is None:
        raise FileNotFoundError(f"{path} has no manifest")
    if bad := manifest_issues(manifest):
        raise ValueError(f"the manifest of {path} differs in {', '.join(bad)}")
    slugs = sorted(d["slug"] for d in manifest["domains"])
    rows = spark.read.schema(schema).option("basePath", f"{path}/data").json(f"{path}/data", mode="FAILFAST")
    rows = rows.where(F.col("domain_slug") == domain) if domain is not None else rows.where(F.col("domain_slug").isin(*slugs) if slugs else F.lit(False))
    if domain is None:
        there = {r[0] for r in spark.read.schema(schema).json(f"{path}/data").select("domain_slug").distinct().collect()} if slugs else set()
        if lost := sorted({d["slug"] for d in manifest["domains"] if d["records"]} - there):
            raise ValueError(f"listed but not there: {', '.join(lost)}")
    return rows


def items(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """One JSON document a file, with its key from the file's name. Spark's name column is encoded once more than the name."""
    name = F.regexp_replace("_metadata.file_name", r"\.json$", "")
    rows = spark.read.schema(schema).option("multiLine", True).json(folder)
    return rows.select("*", percent_decode(percent_decode(name)).alias("item_key"))


def shard_names(names: DataFrame, column: str = "name") -> DataFrame:
    """(bloom_level, shard_index) of names `level--NNNN`, split at the last `--`; other names drop out."""
    name = F.col(column)
    own = names.where(name.rlike(r"^.+--[0-9]{4,}$"))
    return own.select("*", F.regexp_extract(name, r"^(.+)--([0-9]{4,})$", 1).alias("bloom_level"), F.regexp_extract(name, r"^(.+)--([0-9]{4,})$", 2).cast("int").alias("shard_index"))


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, offset, length) of binary indexes: two unsigned 32-bit little-endian numbers for each record. A torn tail is ignored."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")
    n = F.floor(F.length("content") / 8).cast("int")
    rows = files.where(n > 0).select("file", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.hex(F.substr("content", i * 8 + 1, F.lit(8))))).alias("pos", "h"))

    def number(at):
        pairs = F.concat(*[F.substr("h", F.lit(at + 2 * k + 1), F.lit(2)) for k in (3, 2, 1, 0)])
        return F.conv(pairs, 16, 10).cast("long")

    return rows.select("file", "pos", number(0).alias("offset"), number(8).alias("length"))


def records_at(shard: DataFrame, requests: DataFrame) -> DataFrame:
    """Records of a shard (pos, ...) at requested indices (req_ord, pos), in the order of the requests, repeats included.

    A negative index counts from the end; one out of bounds is an error.
    """
    size = shard.agg(F.count("*").alias("_n"))
    asked = requests.crossJoin(F.broadcast(size)).withColumn("pos", F.when(F.col("pos") < 0, F.col("pos") + F.col("_n")).otherwise(F.col("pos")))
    bounds = F.when((F.col("pos") < 0) | (F.col("pos") >= F.col("_n")), F.raise_error(F.lit("index out of bounds"))).otherwise(F.col("pos"))
    return shard.join(asked.select("req_ord", bounds.alias("pos")), "pos").orderBy("req_ord")


def checkpoints(spark: SparkSession, pattern: str) -> tuple[DataFrame, DataFrame]:
    """(slug, name, phase, complete) of readable checkpoints, one JSON document in each domain's folder, and (file, line) of the
    others. Folders that begin with a dot are no domains; a domain without name has its folder's."""
    raw = spark.read.text(pattern, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    slug = F.element_at(F.split("file", "/"), -2)
    doc = F.try_parse_json("value")
    rows = raw.select("file", "value", percent_decode(slug).alias("slug"), doc.alias("doc")).where(~F.startswith("slug", F.lit(".")))
    good = F.startswith(F.schema_of_variant("doc"), F.lit("OBJECT"))
    name = F.coalesce(F.nullif(F.try_variant_get("doc", "$.knowledge_tree.domain", "string"), F.lit("")), "slug")
    phase = F.try_variant_get("doc", "$.phase", "string")
    read = rows.where(F.coalesce(good, F.lit(False))).select("slug", name.alias("name"), phase.alias("phase"), F.coalesce(phase == "complete", F.lit(False)).alias("complete"))
    return read, rows.where(~F.coalesce(good, F.lit(False))).select("file", F.left("value", F.lit(80)).alias("line"))


def meta_domains(text: Column) -> Column:
    """The saved domains (array of name, slug, description) of a document that is a list of them or has one under `domains`."""
    doc = F.try_parse_json(text)
    whole = F.when(F.startswith(F.schema_of_variant(doc), F.lit("ARRAY")), doc).otherwise(F.try_variant_get(doc, "$.domains", "variant"))
    own = F.coalesce(F.try_variant_get(whole, "$", "array<variant>"), F.array().cast("array<variant>"))
    field = lambda d, n: F.coalesce(F.try_variant_get(d, f"$.{n}", "string"), F.lit(""))
    return F.transform(own, lambda d: F.struct(*[field(d, n).alias(n) for n in ("name", "slug", "description")]))


class PayloadSource(Protocol):
    """Anything that gives payload rows."""

    def payloads(self, spark: SparkSession) -> DataFrame: ...


class ViewPayloads:
    """Payloads of a question/answer view."""

    def __init__(self, path: str, schema: T.StructType | str):
        self.path, self.schema = path, schema

    def payloads(self, spark: SparkSession) -> DataFrame:
        return payload_rows(view(spark, self.path, self.schema), self.path)
