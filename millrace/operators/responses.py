"""Chat requests and responses as columns: prompts from templates, message texts, structured answers, tool calls.

A raw response is a variant; what it lacks, or what has another shape, gives null and a reason instead of an error, so that one bad
response is one failed row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import parsed_object, slugify, strip_text

REASON_SHOWN = 200
#: Prompts of the stages by language; names in braces are filled in.
TEMPLATES = {
    ("catalog", "en"): "List the subtopics of {topic} that a careful textbook would have. Path so far: {path}.",
    ("catalog", "zh"): "请列出{topic}在严谨教材中应有的子主题。当前路径：{path}。",
    ("question", "en"): "Write {n} questions about {topic} ({path}), each at a different level of understanding.",
    ("question", "zh"): "请就{topic}（{path}）写出{n}个问题，每个问题对应不同的认知层次。",
    ("answer", "en"): "Answer the question completely and correctly: {question}",
    ("answer", "zh"): "请完整、正确地回答下面的问题：{question}",
}


def rendered(stage: str, language: Column, values: dict[str, Column]) -> Column:
    """A stage's prompt in a language, its names filled in; null for a language without template. Filled-in texts are not filled again."""
    out = F.lit(None).cast("string")
    for (name, own), template in TEMPLATES.items():
        if name == stage:
            parts, rest = [], template
            while "{" in rest:
                before, _, rest = rest.partition("{")
                key, _, rest = rest.partition("}")
                parts += [F.lit(before), F.coalesce(values[key].cast("string"), F.lit(""))]
            out = F.when(language == own, F.concat(*parts, F.lit(rest))).otherwise(out)
    return out


def messages(system: Column, user: Column) -> Column:
    return F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in (("system", system), ("user", user))])


def with_guidance(messages_: Column, tool: str) -> Column:
    """Messages with what to do with a tool after the system messages that come first."""
    lead = F.coalesce(F.array_min(F.transform(messages_, lambda m, i: F.when(m["role"] != "system", i))), F.size(messages_))
    guidance = F.array(F.struct(F.lit("system").alias("role"), F.lit(f"Give the result by calling `{tool}` once, and not as text.").alias("content")))
    return F.concat(F.slice(messages_, F.lit(1), lead), guidance, F.slice(messages_, lead + 1, F.size(messages_) - lead))


def tool_schema(name: str, description: str, parameters: dict) -> dict:
    """A function tool as requests have it."""
    return {"type": "function", "function": {"name": name, "description": description, "parameters": parameters}}


def _texts(value: Column) -> Column:
    """A list of texts, or of objects with a text or content, as an array of stripped texts that are not empty."""
    parts = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array().cast("array<variant>"))
    shown = F.transform(parts, lambda p: strip_text(F.coalesce(
        F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")), F.nullif(F.try_variant_get(p, "$.text", "string"), F.lit("")), F.try_variant_get(p, "$.content", "string"), F.lit(""),
    )))
    return F.filter(shown, lambda t: t != "")


def content_text(value: Column) -> Column:
    """A message's content, a text or a list, as one stripped text; empty if there is none."""
    kind = F.schema_of_variant(value)
    return F.when(F.startswith(kind, F.lit("ARRAY")), F.array_join(_texts(value), "\n")).otherwise(strip_text(F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(""))))


def _message(response: Column, name: str) -> Column:
    return F.try_variant_get(response, f"$.choices[0].message.{name}", "variant")


def response_columns(rows: DataFrame, response: str = "response", tool: str | None = None) -> DataFrame:
    """rows with content, reasoning, object (a variant), reason, of raw responses as JSON texts.

    object is the arguments of the first call of tool, or without tool the JSON object of the content, else of the reasoning. reason
    says why there is none: no_message, empty, no_tool_call, other_tools, not_an_object.
    """
    raw = F.try_parse_json(F.col(response))
    rows = rows.withColumns({"_raw": raw})
    rows = rows.withColumns({"content": content_text(_message(F.col("_raw"), "content")), "reasoning": content_text(_message(F.col("_raw"), "reasoning_content"))})
    there = F.try_variant_get(F.col("_raw"), "$.choices[0].message", "variant").isNotNull()
    if tool is None:
        rows = rows.withColumn("object", F.coalesce(parsed_object(F.col("content")), parsed_object(F.col("reasoning"))))
        reason = F.when(~there, "no_message").when((F.col("content") == "") & (F.col("reasoning") == ""), "empty").when(F.col("object").isNull(), "not_an_object")
    else:
        calls = F.coalesce(F.try_variant_get(_message(F.col("_raw"), "tool_calls"), "$", "array<variant>"), F.array().cast("array<variant>"))
        named = F.filter(calls, lambda c: F.try_variant_get(c, "$.function.name", "string") == tool)
        rows = rows.withColumns({"_calls": F.size(calls), "_named": F.size(named), "object": parsed_object(content_text(F.try_variant_get(F.get(named, F.lit(0)), "$.function.arguments", "variant")))})
        reason = F.when(~there, "no_message").when(F.col("_calls") == 0, "no_tool_call").when(F.col("_named") == 0, "other_tools").when(F.col("object").isNull(), "not_an_object")
    return rows.withColumn("reason", reason).drop("_raw", "_calls", "_named")


def failure_text(rows: DataFrame) -> Column:
    """What a failed response's log says: the reason, and how content and reasoning begin."""
    return F.when(F.col("reason").isNotNull(), F.format_string("%s; content %s; reasoning %s", F.col("reason"), F.left("content", F.lit(REASON_SHOWN)), F.left("reasoning", F.lit(REASON_SHOWN))))


def categories(rows: DataFrame, parent: str, object_: str = "object") -> DataFrame:
    """(parent, pos, name, slug, description) of the categories of structured answers: slugs that are missing come from names."""
    listed = F.coalesce(F.try_variant_get(F.col(object_), "$.categories", "array<variant>"), F.array().cast("array<variant>"))
    own = rows.select(F.col(parent).alias("parent"), F.posexplode(listed).alias("pos", "c"))
    text = lambda n: F.coalesce(F.try_variant_get("c", f"$.{n}", "string"), F.lit(""))
    return own.select("parent", "pos", text("name").alias("name"), F.coalesce(F.nullif(text("slug"), F.lit("")), slugify(text("name"))).alias("slug"), text("description").alias("description"))


def questions(rows: DataFrame, leaf: str, object_: str = "object") -> DataFrame:
    """(leaf, pos, text, bloom_level) of the questions of structured answers; a list of levels is one text."""
    listed = F.coalesce(F.try_variant_get(F.col(object_), "$.questions", "array<variant>"), F.array().cast("array<variant>"))
    own = rows.select(leaf, F.posexplode(listed).alias("pos", "q"))
    level = F.try_variant_get("q", "$.bloom_level", "variant")
    several = F.array_join(F.try_variant_get(level, "$", "array<string>"), ", ")
    return own.select(leaf, "pos", F.coalesce(F.try_variant_get("q", "$.text", "string"), F.lit("")).alias("text"), F.coalesce(F.when(F.startswith(F.schema_of_variant(level), F.lit("ARRAY")), several), F.try_variant_get(level, "$", "string"), F.lit("")).alias("bloom_level"))
