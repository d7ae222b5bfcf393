"""Composition: payloads are paired with texts by a modulo join, composed into documents, rendered, read back and validated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import first_mention, person_id, pool_pick, rendered_person_id, sample_id, sample_person_id
from ..functions.text import strip_text
from ..plans.dims import ASKING, DECISIONS, OBSERVED, PRELUDES, REPLY_TOOLS
from .ordinals import with_ordinals
from .policy import person_name

COMPOSITION_VERSION, TASK, DIALECT, REGISTRY = "1.8", "help_gate_acml_v1", "csharp-v0", "known_people_json:"


def modulo_pairs(left: DataFrame, right: DataFrame, left_order: list, right_order: list) -> DataFrame:
    """Each left row with right row (ordinal - 1) mod n: columns index, left, right. No right rows, no pairs.

    Ordinals come without a global sort, and n is one row; the join is an equi-join on the computed key.
    """
    a = with_ordinals(left.select(F.struct("*").alias("left"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(left_order)]), [f"_o{i}" for i in range(len(left_order))], "index").select("index", "left")
    b = with_ordinals(right.select(F.struct("*").alias("right"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(right_order)]), [f"_o{i}" for i in range(len(right_order))], "_at").select("_at", "right")
    n = b.agg(F.coalesce(F.max("_at"), F.lit(0)).alias("_n"))
    keyed = a.crossJoin(F.broadcast(n)).where("_n > 0").withColumn("_at", (F.col("index") - 1) % F.col("_n") + 1)
    return keyed.join(b, "_at").select("index", "left", "right")


def _by_language(language: Column, make) -> Column:
    return F.when(language == "zh", make("zh")).when(language == "en", make("en")).otherwise(F.raise_error(F.concat(F.lit("no texts for language "), F.coalesce(language, F.lit("null")))))


def observation_wrapper(language: Column, kind: Column, mention: Column) -> Column:
    asks = kind.isin(*ASKING)
    return F.concat(mention, _by_language(language, lambda k: F.when(asks, OBSERVED[k][True]).otherwise(OBSERVED[k][False])))


def composed(pairs: DataFrame, *, qa_run: str, qa_view: str, text_run: str) -> DataFrame:
    """The composition of pairs (payload, text, language), as flat columns.

    payload: payload_id, request_text, fulfillment_content, domain_slug, bloom_level. text: record_id, source_policy_record_id,
    relation_kind, policy_decision, belief, thinking.
    """
    c = F.col
    decision = c("text.policy_decision")
    intent = F.create_map(*[x for d, i in DECISIONS.items() for x in (F.lit(d), F.lit(i))])[decision]
    rows = pairs.withColumns({
        "sample_id": sample_id(F.lit(qa_run), F.lit(qa_view), c("payload.payload_id"), F.lit(text_run), c("text.record_id"), c("language")),
        "response_intent": intent, "will_help_now": decision == "engage_now",
        "source_counterparty_entity_id": person_id(c("text.source_policy_record_id")), "counterparty_canonical_name": person_name(c("text.source_policy_record_id")),
    })
    rows = rows.withColumns({
        "sample_counterparty_entity_id": sample_person_id(c("sample_id"), c("source_counterparty_entity_id")),
        "rendered_counterparty_entity_id": rendered_person_id(c("sample_id"), c("source_counterparty_entity_id")),
        "counterparty_first_mention_name": first_mention(c("counterparty_canonical_name"), c("text.relation_kind")),
        "reply_tool_name": pool_pick(c("sample_id"), "reply_tool_name", REPLY_TOOLS),
        "belief_runtime_affordance_variant_id": _by_language(c("language"), lambda k: pool_pick(c("sample_id"), f"belief_runtime_affordance:{k}", list(PRELUDES[k]))),
    })
    person = F.struct(
        c("rendered_counterparty_entity_id").alias("entity_id"), F.lit("person").alias("entity_type"), c("text.relation_kind").alias("relation"), c("counterparty_canonical_name").alias("name"),
        c("counterparty_first_mention_name").alias("mention"),
    )
    prelude = _by_language(c("language"), lambda k: F.create_map(*[x for v, t in PRELUDES[k].items() for x in (F.lit(v), F.lit(t))])[c("belief_runtime_affordance_variant_id")])
    prototype = F.concat(prelude, F.lit("\nvoid "), c("reply_tool_name"), F.lit("(string target_entity_id, string message);"))
    belief = strip_text(c("text.belief"))
    return rows.withColumns({
        "belief_entity_registry_text": F.concat(F.lit(REGISTRY + "\n"), F.to_json(F.array(person)), F.lit("\n\n")),
        "belief_text": F.when(belief == "", prototype).otherwise(F.concat(prototype, F.lit("\n\n"), belief)),
        "observation_wrapper": observation_wrapper(c("language"), c("text.relation_kind"), c("counterparty_first_mention_name")),
        "me_reasoning_text": strip_text(c("text.thinking")),
        "reply_action_text": F.when(c("response_intent") == "help_now", strip_text(c("payload.fulfillment_content"))).otherwise(""),
        "composition_version": F.lit(COMPOSITION_VERSION),
    })


def _escaped(text: Column) -> Column:
    for raw, out in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        text = F.replace(text, F.lit(raw), F.lit(out))
    return text


def _element(name: str, attributes: dict[str, Column], *content: Column) -> Column:
    parts = [F.lit(f"<{name}")]
    for k, v in attributes.items():
        parts += [F.lit(f' {k}="'), _escaped(v), F.lit('"')]
    return F.concat(*parts, F.lit(">"), *content, F.lit(f"</{name}>"))


def document(rows: DataFrame) -> DataFrame:
    """Compositions with their document as structs (`document`) and as markup (`markup`)."""
    c = F.col
    action = c("reply_action_text") != ""
    prefix = F.concat(c("reply_tool_name"), F.lit('(target_entity_id: "'), c("rendered_counterparty_entity_id"), F.lit('", message: '))
    reasoning = F.when(action & (c("me_reasoning_text") != ""), F.concat(c("me_reasoning_text"), F.lit("\n"))).otherwise(c("me_reasoning_text"))
    help_now = F.when(c("will_help_now"), "true").otherwise("false")
    observed = {"kind": F.lit("observation"), "source": F.lit("qa"), "relation": c("text.relation_kind"), "entity_id": c("rendered_counterparty_entity_id"), "entity_name": c("counterparty_canonical_name"), "entity_mention": c("counterparty_first_mention_name")}
    me = {"kind": F.lit("me"), "source": F.lit("policy_text+qa"), "will_help_now": help_now, "response_intent": c("response_intent"), "policy_decision": c("text.policy_decision")}
    acts = _element("action", {"tool": c("reply_tool_name"), "dialect": F.lit(DIALECT), "target_entity_id": c("rendered_counterparty_entity_id")}, _escaped(prefix), _element("payload", {}, _escaped(c("reply_action_text"))), F.lit(")"))
    entries = (
        _element("entry", observed, _escaped(c("observation_wrapper")), _element("payload", {}, _escaped(c("payload.request_text")))),
        _element("entry", {"kind": F.lit("belief"), "source": F.lit("policy_text+runtime")}, _escaped(F.concat("belief_entity_registry_text", "belief_text"))),
        _element("entry", me, _escaped(reasoning), F.when(action, acts).otherwise("")),
    )
    head = {"version": F.lit("0"), "task": F.lit(TASK), "composition_version": F.lit(COMPOSITION_VERSION), "language": c("language"), "sample_id": c("sample_id")}
    entry = lambda kind, text, payload: F.struct(F.lit(kind).alias("kind"), text.alias("text"), payload.alias("payload"))
    nested = F.array(
        entry("observation", c("observation_wrapper"), c("payload.request_text")), entry("belief", F.concat("belief_entity_registry_text", "belief_text"), F.lit(None).cast("string")),
        entry("me", reasoning, F.when(action, c("reply_action_text"))),
    )
    return rows.withColumns({"document": nested, "markup": _element("document", head, *entries)})


#: The markup's grammar as one pattern; its groups are FIELDS.
_ATTRIBUTES = (
    r'<document version="([^"]*)" task="([^"]*)" composition_version="[^"]*" language="([^"]*)" sample_id="([^"]*)">'
    r'<entry kind="([^"]*)" source="qa" relation="([^"]*)" entity_id="([^"]*)" entity_name="[^"]*" entity_mention="[^"]*">([^<]*)<payload>([^<]*)</payload></entry>'
    r'<entry kind="([^"]*)" source="[^"]*">([^<]*)</entry>'
    r'<entry kind="([^"]*)" source="[^"]*" will_help_now="[^"]*" response_intent="([^"]*)" policy_decision="[^"]*">([^<]*)'
    r'(<action tool="([^"]*)" dialect="[^"]*" target_entity_id="([^"]*)">[^<]*<payload>([^<]*)</payload>\)</action>)?</entry></document>'
)
FIELDS = (
    "version", "task", "language", "sample_id", "observation_kind", "relation", "entity_id", "observation_text", "observation_payload", "belief_kind", "belief_text", "me_kind", "intent", "reasoning", "action", "tool",
    "target", "action_payload",
)


def _unescaped(text: Column) -> Column:
    for out, raw in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#13;", "\r"), ("&amp;", "&")):
        text = F.replace(text, F.lit(out), F.lit(raw))
    return text


def parsed(markup: Column) -> Column:
    """The fields of a document's markup as a struct; null if it is not of the grammar. A text has no bare `<`, so one pass finds all."""
    fields = [F.regexp_extract(markup, f"^{_ATTRIBUTES}$", i + 1) for i in range(len(FIELDS))]
    own = F.struct(*[(f if n == "action" else _unescaped(f)).alias(n) for n, f in zip(FIELDS, fields)])
    return F.when(markup.rlike(f"^{_ATTRIBUTES}$"), own)


def round_trip_issues(rows: DataFrame) -> DataFrame:
    """Documents with the array `issues` of what their markup, read back, does not give as it was composed."""
    c, get = F.col, lambda n: F.col(f"_parsed.{n}")
    action = F.coalesce(c("reply_action_text"), F.lit("")) != ""
    checks = {
        "version": get("version") != "0",
        "task": get("task") != TASK,
        "language": get("language") != c("language"),
        "sample_id": get("sample_id") != c("sample_id"),
        "observation_kind": get("observation_kind") != "observation",
        "observation_relation": get("relation") != c("text.relation_kind"),
        "observation_payload": get("observation_payload") != c("payload.request_text"),
        "observation_text": get("observation_text") != c("observation_wrapper"),
        "belief_kind": get("belief_kind") != "belief",
        "belief_text": get("belief_text") != F.concat("belief_entity_registry_text", "belief_text"),
        "me_kind": get("me_kind") != "me",
        "me_intent": get("intent") != c("response_intent"),
        "action_count": (get("action") != "") != action,
        "action_payload": action & (get("action_payload") != c("reply_action_text")),
        "action_target": action & (get("target") != c("rendered_counterparty_entity_id")),
        "answer_leak": (c("response_intent") != "help_now") & (c("reply_action_text") != ""),
        "help_without_action": c("will_help_now") & ~action,
        "rendered_id": F.length("rendered_counterparty_entity_id") != 11,
        "registry": ~F.contains(c("belief_entity_registry_text"), c("rendered_counterparty_entity_id")),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(k)) for k, bad in checks.items()]))
    rows = rows.withColumn("_parsed", parsed(c("markup")))
    return rows.withColumn("issues", F.when(c("_parsed").isNull(), F.array(F.lit("entries"))).otherwise(found)).drop("_parsed")


DERIVED = (
    "sample_id", "response_intent", "will_help_now", "source_counterparty_entity_id", "sample_counterparty_entity_id", "rendered_counterparty_entity_id", "counterparty_canonical_name",
    "counterparty_first_mention_name", "reply_tool_name", "belief_runtime_affordance_variant_id", "belief_entity_registry_text", "belief_text", "observation_wrapper", "me_reasoning_text",
    "reply_action_text", "composition_version",
)


def composition_issues(rows: DataFrame, *, qa_run: str, qa_view: str, text_run: str) -> DataFrame:
    """Stored compositions with `issues`: each derived column that differs when it is computed again from payload and text."""
    fresh = composed(rows.withColumns({f"_{n}": F.col(n) for n in DERIVED}).drop(*DERIVED), qa_run=qa_run, qa_view=qa_view, text_run=text_run)
    found = F.array_compact(F.array(*[F.when(~F.col(n).eqNullSafe(F.col(f"_{n}")), F.lit(n)) for n in DERIVED]))
    return fresh.withColumn("issues", found).withColumns({n: F.col(f"_{n}") for n in DERIVED}).drop(*[f"_{n}" for n in DERIVED])


def valid_and_failed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without issues, and failure rows (sample_id, error_type, error) of the others."""
    failed = rows.where(F.size("issues") > 0).select("sample_id", F.lit("validation").alias("error_type"), F.array_join("issues", "; ").alias("error"))
    return rows.where(F.size("issues") == 0), failed
