"""Question/answer corpora: trees as adjacency tables, questions within leaves, export rows, merges of several corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import joined, question_id
from ..functions.text import slugify, strip_text
from ..sources.scratch import stored
from .ordinals import with_ordinals

VIEW, FAMILY = "qa_export_sft_v1", "qa_corpus"


def tree_paths(nodes: DataFrame, max_depth: int = 8) -> DataFrame:
    """(id, parent, slug, ord) to the same with path (array of slugs below the root), depth and is_leaf.

    One join a level, at most max_depth, each level stored once; the root (no parent) has an empty path. Nodes that the root doesn't reach are left out.
    """
    level = nodes.where("parent is null").select("*", F.array().cast("array<string>").alias("path"), F.lit(0).alias("depth"))
    out = level
    for depth in range(1, max_depth + 1):
        up = level.select(F.col("id").alias("parent"), F.col("path").alias("_up"))
        level = stored(nodes.join(up, "parent").select(*nodes.columns, F.concat("_up", F.array("slug")).alias("path"), F.lit(depth).alias("depth")))
        out = out.unionByName(level)
    inner = nodes.where("parent is not null").select(F.col("parent").alias("id")).distinct().withColumn("_inner", F.lit(True))
    return out.join(inner, "id", "left").withColumn("is_leaf", F.col("_inner").isNull()).drop("_inner")


def find_path(tree: DataFrame, path: list[str]) -> DataFrame:
    """The node of a path; of siblings with one slug the first."""
    return tree.where(F.col("path") == F.array(*[F.lit(p) for p in path]).cast("array<string>")).orderBy("ord", "id").limit(1)


def leaf_frontier(tree: DataFrame, max_depth: int) -> DataFrame:
    """Leaves that may still be expanded."""
    return tree.where(F.col("is_leaf") & (F.col("depth") < max_depth))


def expand_level(frontier: DataFrame, children: DataFrame) -> DataFrame:
    """Child rows (parent, name, slug, description) of frontier nodes, with empty slugs made from names and siblings numbered."""
    slug = F.coalesce(F.nullif(F.col("slug"), F.lit("")), slugify(F.col("name")))
    own = children.join(frontier.select(F.col("id").alias("parent")), "parent", "left_semi").withColumn("slug", slug)
    return own.withColumn("ord", F.row_number().over(Window.partitionBy("parent").orderBy("pos")))


def kept_questions(candidates: DataFrame, leaf: str = "node_path", text: str = "text", pos: str = "pos") -> DataFrame:
    """Within each leaf: stripped texts without blanks and repeats, numbered over those kept, with ids."""
    clean = candidates.withColumn("text", strip_text(F.col(text))).where(F.length("text") > 0)
    first = clean.groupBy(leaf, "text").agg(F.min_by(F.struct(*clean.columns), pos).alias("_r")).select("_r.*")
    numbered = first.withColumn("ordinal", F.row_number().over(Window.partitionBy(leaf).orderBy(pos)))
    return numbered.withColumn("id", question_id(F.col(leaf), F.col("ordinal")))


def export_rows(answered: DataFrame, run_id: str, language: str) -> DataFrame:
    """The 13 columns of an export from (question_id, question, answer, domain, domain_slug, node_path, bloom_level)."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), F.col(text).alias("content"))
    return answered.select(
        F.concat_ws(":", F.lit(FAMILY), F.lit(run_id), F.lit(VIEW), "domain_slug", "question_id").alias("id"), F.lit(run_id).alias("run_id"), F.lit(FAMILY).alias("task_family"),
        F.lit(VIEW).alias("view_id"), "question_id", F.array(message("user", "question"), message("assistant", "answer")).alias("messages"), "question", "answer",
        F.lit(language).alias("language"), "domain", "domain_slug", "node_path", "bloom_level",
    )


def payloads(export: DataFrame, source_path: str = "") -> DataFrame:
    """Payload rows of an export; a missing id is made from run, domain and question, missing texts are empty."""
    made = F.concat_ws(":", F.lit(FAMILY), "run_id", F.lit(VIEW), "domain_slug", "question_id")
    text = lambda n: F.coalesce(F.col(n), F.lit("")).alias(n)
    return export.select(
        F.lit("qa").alias("payload_type"), F.coalesce(F.nullif(F.col("id"), F.lit("")), made).alias("payload_id"), F.col("question_id").alias("derived_from_question_id"),
        F.coalesce("question", F.lit("")).alias("request_text"), F.coalesce("answer", F.lit("")).alias("fulfillment_content"), text("domain_slug"), text("node_path"), text("bloom_level"),
        F.lit(source_path).alias("source_path"),
    )


def filtered_payloads(rows: DataFrame, domains: list[str] | None = None, blooms: list[str] | None = None, most: int | None = None, order: str = "payload_id") -> DataFrame:
    """Payloads of the listed domains, in the list's order, and of the listed levels; most: a budget over all domains together.

    An unknown domain gives nothing. The budget is a top-k by (place of the domain, order).
    """
    if blooms is not None:
        rows = rows.where(F.col("bloom_level").isin(*blooms))
    if domains is not None:
        places = rows.sparkSession.createDataFrame([(d, i) for i, d in enumerate(dict.fromkeys(domains))], "domain_slug string, _place int")
        rows = rows.join(F.broadcast(places), "domain_slug")
    else:
        rows = rows.withColumn("_place", F.lit(0))
    if most is not None:
        rows = rows.orderBy("_place", order).limit(most)
    return rows.drop("_place")


def find_payload(rows: DataFrame, key: str) -> DataFrame:
    """The first payload whose id or question id is the key."""
    return rows.where((F.col("payload_id") == key) | (F.col("derived_from_question_id") == key)).orderBy("payload_id").limit(1)


def resolve_domain(domains: DataFrame, key: str) -> DataFrame:
    """The first domain whose name, slug or slug of the name is the key."""
    return domains.where((F.col("name") == key) | (F.col("slug") == key) | (slugify(F.col("name")) == key)).orderBy("ord").limit(1)


def canonical(columns: list[str]):
    """A digest of a whole row, its columns by name."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def merged(sources: list[DataFrame], columns: list[str], dedupe: bool = True) -> DataFrame:
    """All sources one after another with src_ord, their pos, and kept: of equal rows only the first is.

    Rows are compared by digest and the first is the least (src_ord, pos), so the shuffle carries keys and one row each.
    """
    out = None
    for i, s in enumerate(sources):
        own = s.select("pos", *columns).withColumn("src_ord", F.lit(i))
        out = own if out is None else out.unionByName(own)
    out = out.withColumn("_key", canonical(columns))
    if not dedupe:
        return out.withColumn("kept", F.lit(True)).drop("_key")
    first = out.groupBy("_key").agg(F.min(F.struct("src_ord", "pos")).alias("_first"))
    return out.join(first, "_key").withColumn("kept", F.struct("src_ord", "pos") == F.col("_first")).drop("_key", "_first")


def merge_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("src_ord").agg(F.count("*").alias("records"), F.count_if("kept").alias("kept"))


def name_conflicts(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Keys that have more than one non-empty name, with the names."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(F.nullif(F.col(name), F.lit("")))).alias("names")).where(F.size("names") > 1)


def languages(rows: DataFrame, column: str = "language") -> DataFrame:
    return rows.agg(F.count_distinct(column).alias("languages"))


def normalized_bloom(levels):
    """A list of levels as one text; kept as it is, so it matches no single level."""
    return F.array_join(levels, ", ")


def lower_level_targets(questions: DataFrame, lower: dict[str, list[str]]) -> DataFrame:
    """One row for each lower level that a question can be turned into."""
    targets = F.create_map(*[x for k, v in lower.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return questions.withColumn("target_level", F.explode(F.try_element_at(targets, F.col("bloom_level"))))


def ordered_leaves(tree: DataFrame) -> DataFrame:
    """Leaves with their ordinal in the order of the paths' segments."""
    return with_ordinals(tree.where("is_leaf"), ["path", "id"], "ordinal")


def record_key(*parts):
    return F.sha2(joined(*parts), 256)
