"""More queries over the driver's tables, with DuckDB SQL for the same rows: responses, derived rows, planted faults, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import compose, derived, ledger, policy, qa, reports, responses, text_rules
from ..sources.readers import shard_names
from . import dims
from .queries import PAIR_SQL, QA_SQL, SEED, SLOT_SQL, WEIGHTS, _customers, _failures, _list, exported, flagship, query, realized, table

STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _stripped(sql: str) -> str:
    return STRIP.format(sql)


# chat responses


def _responses(spark, sf_dir) -> DataFrame:
    """Raw responses of five shapes, whose texts are those of the conversations."""
    c = F.col
    item = lambda name: F.struct(c("text").alias(name))  # noqa: E731
    choice = lambda message: F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices")))  # noqa: E731
    shapes = [
        choice(F.struct(F.concat(F.lit(" "), c("text"), F.lit("\n")).alias("content"))),
        choice(F.struct(F.array(item("text"), item("text")).alias("content"))),
        choice(F.struct(F.array(item("content")).alias("content"), F.lit("thought").alias("reasoning_content"))),
        choice(F.struct(F.lit("").alias("content"), F.concat(F.lit("So: ```json\n"), F.to_json(F.struct(c("turn").alias("k"))), F.lit("\n```")).alias("reasoning_content"))),
        F.lit('{"choices": []}'),
    ]
    raw = F.lit("no JSON")
    for i, shape in enumerate(shapes):
        raw = F.when((c("conv_id") + c("turn")) % 6 == i, shape).otherwise(raw)
    return table(spark, sf_dir, "conversations").withColumn("response", raw)


@query(rf"""SELECT conv_id, turn, CASE shape WHEN 0 THEN t WHEN 1 THEN CASE WHEN t = '' THEN '' ELSE t || chr(10) || t END WHEN 2 THEN t ELSE '' END AS content,
  CASE shape WHEN 2 THEN 'thought' WHEN 3 THEN 'So: ```json' || chr(10) || '{{"k":' || turn || '}}' || chr(10) || '```' ELSE '' END AS reasoning, CASE WHEN shape = 3 THEN turn::VARCHAR END AS k,
  CASE WHEN shape > 3 THEN 'no_message' WHEN shape < 2 AND t = '' THEN 'empty' WHEN shape < 3 THEN 'not_an_object' END AS reason
FROM (SELECT conv_id, turn, (conv_id + turn) % 6 AS shape, {_stripped('text')} AS t FROM conversations)""")
def chat_responses(spark, sf_dir):
    found = responses.response_columns(_responses(spark, sf_dir))
    return found.select("conv_id", "turn", "content", "reasoning", F.try_variant_get("object", "$.k", "string").alias("k"), "reason")


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN n_name END AS city, CASE n_nationkey % 4 WHEN 1 THEN 'other_tools' WHEN 2 THEN 'no_tool_call' WHEN 3 THEN 'not_an_object' END AS reason FROM nation""")
def tool_calls(spark, sf_dir):
    c = F.col
    call = lambda name, arguments: F.to_json(F.struct(F.array(F.struct(F.struct(F.lit("ok").alias("content"), F.array(F.struct(F.struct(F.lit(name).alias("name"), arguments.alias("arguments")).alias("function"))).alias("tool_calls")).alias("message"))).alias("choices")))  # noqa: E731
    arguments = F.to_json(F.struct(c("n_name").alias("city")))
    raw = F.when(c("n_nationkey") % 4 == 0, call("place", arguments)).when(c("n_nationkey") % 4 == 1, call("weather", arguments)).when(c("n_nationkey") % 4 == 3, call("place", F.lit("[1]")))
    rows = table(spark, sf_dir, "nation").withColumn("response", F.coalesce(raw, F.lit('{"choices": [{"message": {"content": "no call"}}]}')))
    return responses.response_columns(rows, tool="place").select("n_nationkey", F.try_variant_get("object", "$.city", "string").alias("city"), "reason")


@query("""SELECT n_regionkey AS parent, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'own_' || n_nationkey ELSE replace(lower(n_name), ' ', '_') END AS slug, 'd' || n_nationkey AS description FROM nation""")
def category_rows(spark, sf_dir):
    c = F.col
    own = F.struct(c("n_nationkey").alias("place"), c("n_name").alias("name"), F.when(c("n_nationkey") % 2 == 0, F.concat(F.lit("own_"), "n_nationkey")).otherwise("").alias("slug"), F.concat(F.lit("d"), "n_nationkey").alias("description"))
    rows = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(own)).alias("categories"))
    answers = rows.select("n_regionkey", F.try_parse_json(F.to_json(F.struct("categories"))).alias("object"))
    return responses.categories(answers, "n_regionkey").select("parent", "name", "slug", "description")


@query("""SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'Write 5 questions about ' || n_name || ' (r/' || n_regionkey || '), each at a different level of understanding.'
  WHEN 1 THEN '请就' || n_name || '（r/' || n_regionkey || '）写出5个问题，每个问题对应不同的认知层次。' END AS prompt FROM nation""")
def prompts(spark, sf_dir):
    language = F.when(F.col("n_nationkey") % 3 == 0, "en").when(F.col("n_nationkey") % 3 == 1, "zh").otherwise("xx")
    prompt = responses.rendered("question", language, {"n": F.lit(5), "topic": F.col("n_name"), "path": F.concat(F.lit("r/"), "n_regionkey")})
    return table(spark, sf_dir, "nation").select("n_nationkey", prompt.alias("prompt"))


@query("""SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'system,system,user' WHEN 1 THEN 'system,user' ELSE 'system,user,system' END AS roles, CASE n_nationkey % 3 WHEN 0 THEN 2 ELSE 1 END AS place FROM nation""")
def guided_messages(spark, sf_dir):
    m = lambda role: F.struct(F.lit(role).alias("role"), F.col("n_name").alias("content"))  # noqa: E731
    kind = F.col("n_nationkey") % 3
    given = F.when(kind == 0, F.array(m("system"), m("user"))).when(kind == 1, F.array(m("user"))).otherwise(F.array(m("user"), m("system")))
    told = responses.with_guidance(given, "place")
    place = F.array_position(F.transform(told, lambda x: F.contains(x["content"], F.lit("`place`"))), True)
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(F.transform(told, lambda x: x["role"]), ",").alias("roles"), place.cast("int").alias("place"))


# runs, resumes, reports


@query("""SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS requested, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)) AS retained,
  NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey < 10 AND c_custkey NOT IN (SELECT o_custkey FROM orders)) AS is_subset""")
def retained_requests(spark, sf_dir):
    done = table(spark, sf_dir, "customer").where("c_nationkey < 10").select(F.col("c_custkey").alias("key"))
    return derived.overlap(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), done, ["key"])


@query("""SELECT 'orders' AS family, o_orderkey AS run_id, 'customer' AS source_family, o_custkey AS source_run_id, CASE WHEN c_custkey IS NULL THEN 'missing' ELSE c_mktsegment END AS source_status
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 3) ON c_custkey = o_custkey""")
def lineage(spark, sf_dir):
    edges = table(spark, sf_dir, "orders").select(F.lit("orders").alias("family"), F.col("o_orderkey").alias("run_id"), F.lit("customer").alias("source_family"), F.col("o_custkey").alias("source_run_id"))
    runs = table(spark, sf_dir, "customer").where("c_nationkey <> 3").select(F.lit("customer").alias("family"), F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("status"))
    return derived.lineage_edges(edges, runs)


@query("""SELECT 'saved' AS case_, n_name AS name, 'n' || n_nationkey AS slug, 'd' AS description, n_nationkey < 5 AS done, 'saved' AS plan FROM nation
UNION ALL SELECT 'scanned', CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'n' || n_nationkey END, 'n' || n_nationkey, '', n_nationkey < 5, 'scanned' FROM nation WHERE n_nationkey < 10""")
def resume_plans(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").withColumn("slug", F.concat(F.lit("n"), "n_nationkey"))
    saved = nation.select(F.col("n_name").alias("name"), "slug", F.lit("d").alias("description"), "n_nationkey")
    scan = nation.where("n_nationkey < 10").select("slug", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("").alias("name"), (F.col("n_nationkey") < 5).alias("complete"))
    own = ["name", "slug", "description"]
    plans = [derived.resume_plan(meta.select(*own), scan).withColumn("case_", F.lit(case)) for case, meta in (("saved", saved), ("scanned", saved.where("n_nationkey > 4")))]
    return plans[0].unionByName(plans[1]).select("case_", *own, "done", "plan")


@query("""SELECT c_custkey, CASE WHEN leaves = 0 THEN 'catalog' WHEN asked < leaves THEN 'questions' WHEN answered < questions THEN 'answers' ELSE 'complete' END AS phase FROM (SELECT c_custkey, count(o_orderkey) AS leaves,
  count(*) FILTER (o_orderpriority <> '1-URGENT') AS asked, count(*) FILTER (o_orderstatus <> 'P') AS questions, count(*) FILTER (o_orderstatus = 'F') AS answered FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)""")
def domain_phases(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    n = lambda bad: F.count_if(F.coalesce(bad, F.lit(False)))  # noqa: E731
    c = F.col
    state = rows.groupBy("c_custkey").agg(F.count("o_orderkey").alias("leaves"), n(c("o_orderpriority") != "1-URGENT").alias("asked"), n(c("o_orderstatus") != "P").alias("questions"), n(c("o_orderstatus") == "F").alias("answered"))
    return derived.next_phase(state).select("c_custkey", "phase")


@query("SELECT count(*) FILTER (trim(text) <> '') AS failures FROM documents")
def failure_events(spark, sf_dir):
    return reports.failure_events(table(spark, sf_dir, "documents"), "text")


@query(f"""SELECT 'payloads' AS side, 'domain_slug' AS dimension, domain_slug AS value, count(*) AS n FROM ({QA_SQL}) GROUP BY ALL UNION ALL SELECT 'payloads', 'bloom_level', bloom_level, count(*) FROM ({QA_SQL}) GROUP BY ALL
UNION ALL SELECT 'texts', 'will_help_now', (lang = 'en')::VARCHAR, count(*) FROM documents GROUP BY ALL UNION ALL SELECT 'texts', 'response_intent', source, count(*) FROM documents GROUP BY ALL
UNION ALL SELECT 'readiness', 'ready', NULL, (SELECT count(*) FROM ({QA_SQL}))""")
def preflight(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), (F.col("lang") == "en").cast("string").alias("will_help_now"), F.col("source").alias("response_intent"), F.col("lang").alias("policy_decision"))
    doc = reports.preflight(qa.payloads(exported(spark, sf_dir)), texts)
    rows = [(side, k, value, n) for side in ("payloads", "texts") for k, counts in doc[side].items() if isinstance(counts, dict) for value, n in counts.items()]
    return spark.createDataFrame([*rows, ("readiness", doc["readiness"], None, doc["estimated_samples"])], "side string, dimension string, value string, n long")


# planted faults


def _cases(cases) -> str:
    return ", ".join("(" + ", ".join("'" + str(x).replace("'", "''") + "'" if not isinstance(x, int) else str(x) for x in c) + ")" for c in cases)


#: (case, language, decision, belief, thinking, codes of the broken rules); @ is the name.
TEXT_CASES = [
    (0, "en", "engage_now", "I know @ well.", "@ asks, so I take this on now.", ""),
    (1, "en", "defer", "", "About @: later.", "belief_empty"),
    (2, "en", "decline", "I know @ well.", "", "thinking_empty,intent_missing_cue"),
    (3, "en", "decline", "I know that one.", "@: have to decline.", "missing_counterparty_name"),
    (4, "en", "defer", "I know @, and he is tired.", "About @: later.", "counterparty_pronoun"),
    (5, "en", "defer", "I know @. Let me see.", "About @: later.", "belief_decision_leak"),
    (6, "en", "defer", "@ is near.", "About @: later.", "belief_not_first_person"),
    (7, "en", "defer", "I know @: time_pressure is high.", "About @: later.", "schema_jargon"),
    (8, "en", "defer", "I know @ and this person.", "About @: later, take this on now.", "counterparty_generic_placeholder,intent_immediate_help_mismatch,intent_conflicting_cue"),
    (9, "zh", "defer", "我认识@。", "@的事，晚点再说。", ""),
    (10, "zh", "defer", "我认识@，他在。", "@的事，晚点再说。", "counterparty_pronoun"),
    (11, "zh", "set_boundary", "我认识@。我决定帮。", "@，你好。", "belief_decision_leak,counterparty_direct_address,intent_missing_cue"),
    (12, "xx", "defer", "I know @.", "@ later", ""),
    (13, "en", "defer", "I know @ " + "x" * 220, "About @: later " + "y" * 120, "belief_too_long,thinking_too_long"),
    (14, "en", "decline", "I know @ well.", "@: have to decline, maybe later.", "intent_conflicting_cue"),
    (15, "en", "defer", "I know @ well.", "About @: later; I will not take this on now.", ""),
]


def _text_faults(spark, sf_dir) -> DataFrame:
    """Each customer as the counterparty of one case."""
    cases = spark.createDataFrame([c[:5] for c in TEXT_CASES], "place int, language string, policy_decision string, belief string, thinking string")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.concat("c_name", F.lit("[x]")).alias("mention"), (F.col("c_custkey") % len(TEXT_CASES)).cast("int").alias("place"))
    own = rows.join(F.broadcast(cases), "place")
    return own.withColumns({k: F.replace(k, F.lit("@"), F.col("name")) for k in ("belief", "thinking")})


@query(f"SELECT c_custkey, codes FROM customer JOIN (VALUES {_cases([(c[0], c[5]) for c in TEXT_CASES])}) t(place, codes) ON place = c_custkey % {len(TEXT_CASES)}")
def text_rule_codes(spark, sf_dir):
    found = text_rules.with_issues(_text_faults(spark, sf_dir))
    return found.select("c_custkey", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))


#: (case, field that is changed, the change as SQL, issue of the contract)
RECORD_CASES = [
    (0, "record_id", "record_id", ""),
    (1, "schema_version", "'0'", "schema_version"),
    (2, "generator_version", "'9'", "generator_version"),
    (3, "counterparty", "named_struct('entity_id', 'x', 'entity_type', counterparty.entity_type, 'name_key', counterparty.name_key)", "counterparty.entity_id"),
    (4, "counterparty", "named_struct('entity_id', counterparty.entity_id, 'entity_type', counterparty.entity_type, 'name_key', 'x')", "counterparty.name_key"),
    (5, "policy", "named_struct('decision', policy.decision, 'strategy', 'x', 'reason_tags', policy.reason_tags)", "policy.strategy"),
    (6, "relation", "struct('x' AS relation_label, relation.relation_direction, relation.relation_closeness, relation.trust_in_target, relation.role_obligation, relation.power_asymmetry, relation.unfinished_tension, relation.reciprocity_history)", "relation.relation_label"),
    (7, "policy", "named_struct('decision', 'x', 'strategy', policy.strategy, 'reason_tags', policy.reason_tags)", "policy.decision,policy.strategy"),
]


@query(f"SELECT format('policy_rec__{{:06d}}', slot) AS record_id, issues FROM ({SLOT_SQL}) JOIN (VALUES {_cases([(c[0], c[3]) for c in RECORD_CASES])}) t(place, issues) ON place = slot % {len(RECORD_CASES)}")
def policy_contract(spark, sf_dir):
    slots = policy.policy_records(spark, _customers(spark, sf_dir), SEED, WEIGHTS)
    rows = policy.as_documents(slots).withColumn("place", F.substring("record_id", -6, 6).cast("int") % len(RECORD_CASES))
    rows = rows.withColumn("_id", F.col("record_id"))
    for place, field, change, _ in RECORD_CASES[1:]:
        rows = rows.withColumn(field, F.when(F.col("place") == place, F.expr(change).cast(rows.schema[field].dataType)).otherwise(F.col(field)))
    return policy.record_issues(rows).select(F.col("_id").alias("record_id"), F.array_join("issues", ",").alias("issues"))


@query(f"""SELECT 'policy_text__' || format('policy_rec__{{:06d}}', slot) || '__r01' AS record_id, CASE slot % 5 WHEN 0 THEN 'belief_empty' WHEN 1 THEN 'thinking_too_long' WHEN 2 THEN 'schema_jargon' WHEN 3 THEN 'belief_too_long' ELSE '' END AS codes FROM ({SLOT_SQL})""")
def realized_texts(spark, sf_dir):
    rows = realized(spark, sf_dir).withColumn("place", F.regexp_extract("record_id", "rec__([0-9]+)__", 1).cast("int") % 5)
    belief = F.when(F.col("place") == 0, " ").when(F.col("place") == 3, F.concat("belief", F.lit("z" * 220))).otherwise(F.col("belief"))
    thinking = F.when(F.col("place") == 1, F.concat("thinking", F.lit("z" * 120))).when(F.col("place") == 2, F.concat("thinking", F.lit(" reason_tags"))).otherwise(F.col("thinking"))
    found = text_rules.with_issues(rows.withColumns({"belief": belief, "thinking": thinking}))
    return found.select("record_id", F.array_join(F.transform("issues", lambda i: i["code"]), ",").alias("codes"))


#: Which fault a sample gets, by its id.
PLACE = "instr('0123456789abcdef', substr(sample_id, 7, 1)) % 6"


@query(f"""SELECT sample_id, CASE {PLACE} WHEN 0 THEN 'reply_tool_name' WHEN 1 THEN 'me_reasoning_text' WHEN 2 THEN 'composition_version' WHEN 3 THEN 'counterparty_canonical_name' ELSE '' END AS changed,
  CASE {PLACE} WHEN 4 THEN 'observation_text' WHEN 5 THEN 'entries' ELSE '' END AS lost FROM {PAIR_SQL}""")
def composition_faults(spark, sf_dir):
    rows = flagship(spark, sf_dir).withColumn("place", F.expr(PLACE))
    c = F.col
    for place, name in enumerate(("reply_tool_name", "me_reasoning_text", "composition_version", "counterparty_canonical_name")):
        rows = rows.withColumn(name, F.when(c("place") == place, "other").otherwise(c(name)))
    markup = F.when(c("place") == 4, F.regexp_replace("markup", "(entity_mention=\"[^\"]*\">)", "$1not ")).when(c("place") == 5, F.regexp_replace("markup", "</entry></document>$", "</entry><entry></entry></document>")).otherwise(c("markup"))
    rows = compose.round_trip_issues(rows.withColumn("markup", markup)).withColumnRenamed("issues", "lost")
    found = compose.composition_issues(rows, qa_run="run1", qa_view=qa.VIEW, text_run="pt1")
    return found.select("sample_id", F.array_join("issues", ",").alias("changed"), F.array_join("lost", ",").alias("lost"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'semantic_invented_details' WHEN 1 THEN 'semantic_alignment' WHEN 2 THEN 'semantic_other' ELSE 'semantic_alignment' END AS code,
  CASE c_custkey % 4 WHEN 3 THEN 'Keep the intent' WHEN 0 THEN 'It made up a room' WHEN 1 THEN 'Not aligned' ELSE 'Flat' END AS message, c_custkey % 4 = 1 AS needs_name FROM customer""")
def judged_texts(spark, sf_dir):
    place = F.col("c_custkey") % 4
    remark = F.when(place == 0, "It made up a room").when(place == 1, "Not aligned").when(place == 2, "Flat")
    issues = text_rules.judge_issues(F.array(remark), F.array(F.when(place == 3, "Keep the intent")))
    own = F.array(F.struct(F.when(place == 1, "counterparty_pronoun").otherwise("belief_empty").alias("code")))
    return table(spark, sf_dir, "customer").select("c_custkey", issues[0]["code"].alias("code"), issues[0]["message"].alias("message"), text_rules.needs_name(own).alias("needs_name"))


@query("""SELECT user_id, event_id, coalesce(last_value(CASE WHEN event_type = 'error' THEN event_id::VARCHAR END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS feedback FROM events""")
def retry_feedback(spark, sf_dir):
    issues = F.when(F.col("event_type") == "error", F.array(F.col("event_id").cast("string"))).otherwise(F.array().cast("array<string>"))
    tries = table(spark, sf_dir, "events").select("user_id", "event_id", issues.alias("issues"))
    return ledger.with_feedback(tries, ["user_id"], "event_id", "issues").select("user_id", "event_id", F.coalesce(F.array_join("feedback", ","), F.lit("")).alias("feedback"))


# derived rows


@query(f"""SELECT sample_id, payload_id AS qa_record_id, record_id AS policy_text_record_id, relation_kind, decision = 'engage_now' AS will_help_now, decision AS policy_decision, domain_slug, bloom_level, 'now' AS created_at, '1.8' AS composition_version,
  person AS source_counterparty_entity_id, name AS counterparty_canonical_name, name || '[' || relation_kind || ']' AS counterparty_first_mention_name, 18 AS columns FROM {PAIR_SQL}""")
def item_rows(spark, sf_dir):
    rows = derived.item_rows(flagship(spark, sf_dir).drop("markup"), F.lit("now"))
    return rows.withColumn("columns", F.lit(len(rows.columns))).drop("response_intent", "sample_counterparty_entity_id", "rendered_counterparty_entity_id", "reply_tool_name", "belief_runtime_affordance_variant_id")


FACTS_SQL = r"list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?。！？])\s+', '\1' || chr(10), 'g'), chr(10)), lambda s: trim(s)), lambda s: s <> '')[1:5]".replace(chr(92) * 2, chr(92))


@query(f"""SELECT doc_id, len(f) AS facts, concat_ws(',', CASE WHEN len(f) < 2 THEN 'too_few_facts' END, CASE WHEN len(list_filter(f, lambda s: s = trim(text))) > 0 THEN 'copies_answer' END,
  CASE WHEN len(list_filter(f, lambda s: length(s) >= length(text))) > 0 THEN 'not_shorter' END) AS issues FROM (SELECT doc_id, text, {FACTS_SQL} AS f FROM documents)""")
def recall_facts(spark, sf_dir):
    found = derived.recall_facts(table(spark, sf_dir, "documents"), "text")
    return found.select("doc_id", F.size("facts").cast("long").alias("facts"), F.array_join("issues", ",").alias("issues"))


@query("""SELECT user_id, CASE WHEN w > 0 THEN 'repair_path' ELSE 'clean_path' END AS record_kind, array_to_string(CASE WHEN w > 0 THEN steps[greatest(w - 1, 1):greatest(w - 1, 1) + 2] ELSE steps[1:3] END, '>') AS path
FROM (SELECT *, coalesce(list_position(steps, 'error'), 0) AS w FROM (SELECT user_id, list(event_type ORDER BY event_id) AS steps FROM events GROUP BY user_id))""")
def reasoning_paths(spark, sf_dir):
    steps = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda s: s["event_type"])
    rows = table(spark, sf_dir, "events").groupBy("user_id").agg(steps.alias("steps"))
    found = derived.compressed_reasoning(rows.withColumn("wrong", F.array_position("steps", "error")), "steps", "wrong")
    return found.select("user_id", "record_kind", F.array_join("path", ">").alias("path"))


RUNS_SQL = "list_distinct(CASE WHEN len({w}) >= 3 THEN list_transform(range(1, len({w}) - 1), lambda i: array_to_string({w}[i:i + 2], ' ')) WHEN len({w}) > 0 THEN [array_to_string({w}, ' ')] ELSE [] END)"


@query(rf"""SELECT conv_id, turn, round(o, 9) AS overlap, o >= 0.5 AS leaks FROM (SELECT conv_id, turn, CASE WHEN len(x) = 0 THEN 0 ELSE len(list_intersect(x, y)) / len(x) END AS o FROM (
  SELECT conv_id, turn, {RUNS_SQL.format(w='a')} AS x, {RUNS_SQL.format(w='b')} AS y FROM (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(text), '[ 	

]+'), lambda w: w <> '') AS a,
    list_filter(regexp_split_to_array(lower(coalesce(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '')), '[ 	

]+'), lambda w: w <> '') AS b FROM conversations)))""")
def answer_leaks(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("next", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return derived.answer_leaks(rows, "text", "next").select("conv_id", "turn", (F.round(F.col("overlap") * 1e9) / 1e9).alias("overlap"), "leaks")


@query(f"SELECT payload_id FROM ({QA_SQL}) WHERE domain_slug IN ('d1', 'd4') AND bloom_level IN ('apply', 'analyze') AND length(fulfillment_content) > 100")
def selected_sources(spark, sf_dir):
    rows = qa.payloads(exported(spark, sf_dir)).withColumns({"run_id": F.lit("run1"), "complete": F.length("fulfillment_content") > 100})
    return derived.selected_sources(rows, ["d1", "d4"], ["apply", "analyze"], ["run1"], True).select("payload_id")


@query("""SELECT c_nationkey, count(*) AS people, string_agg(c_custkey || ':' || c_name, ',' ORDER BY c_custkey) AS entities FROM (SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) <= 4) GROUP BY c_nationkey""")
def scenes(spark, sf_dir):
    rows = derived.scenes(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", ["c_name"])
    listed = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e["c_custkey"], e["c_name"])), ",")
    return rows.select("c_nationkey", F.size("entities").cast("long").alias("people"), listed.alias("entities"))


@query("""SELECT c_custkey, c_mktsegment || '(actor: "' || c_name || '", content: ["' || c_nationkey || '"])' AS protocol, c_name || ' (' || c_mktsegment || '): ' || c_nationkey AS text FROM customer""")
def projections(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("said", F.col("c_nationkey").cast("string"))
    return derived.projections(rows, "c_name", "c_mktsegment", "said").select("c_custkey", "protocol", "text")


@query("SELECT r_name AS place, level, help FROM region, (SELECT unnest(['low', 'high']) AS level), (SELECT unnest(['yes', 'no']) AS help) WHERE NOT (level = 'low' AND help = 'yes')")
def stimulus_cards(spark, sf_dir):
    places = [r.r_name for r in table(spark, sf_dir, "region").select("r_name").collect()]
    return derived.stimulus_cards({"place": places, "level": ["low", "high"], "help": ["yes", "no"]}, spark, [{"level": "low", "help": "yes"}])


# lookups and small functions


@query(f"""SELECT c_custkey, array_to_string(CASE WHEN len(strong) > 0 THEN strong ELSE list_filter(tags, lambda t: NOT list_contains({_list(dims.NEUTRAL_TAGS)}, t)) END[1:4], ',') AS tags
FROM (SELECT *, list_filter(tags, lambda t: list_contains({_list(dims.SIGNAL_TAGS)}, t)) AS strong FROM (SELECT c_custkey, ({_list([*dims.SIGNAL_TAGS, *dims.NEUTRAL_TAGS, 'other'])})[(c_custkey % 19 + 1)::INT:(c_custkey % 19 + 7)::INT] AS tags FROM customer))""")
def signal_tags(spark, sf_dir):
    every = F.array(*map(F.lit, [*dims.SIGNAL_TAGS, *dims.NEUTRAL_TAGS, "other"]))
    tags = F.slice(every, (F.col("c_custkey") % 19 + 1).cast("int"), F.lit(7))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(policy.signal_tags(tags), ",").alias("tags"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 6 > 3 THEN 'e0; e1; e2 (+' || (c_custkey % 6 - 3) || ' more)' ELSE array_to_string(list_transform(range(c_custkey % 6), lambda i: 'e' || i), '; ') END AS summary FROM customer""")
def error_summaries(spark, sf_dir):
    errors = F.transform(F.slice(F.array(*map(F.lit, range(6))), F.lit(1), (F.col("c_custkey") % 6).cast("int")), lambda i: F.concat(F.lit("e"), i))
    return table(spark, sf_dir, "customer").select("c_custkey", text.error_summary(errors).alias("summary"))


@query("""SELECT 'payload' AS what, min(payload_id) AS found FROM (""" + QA_SQL + """) WHERE derived_from_question_id = (SELECT min(derived_from_question_id) FROM (""" + QA_SQL + """))
UNION ALL SELECT 'domain', 'n' || min(n_nationkey) FROM nation WHERE n_name = (SELECT max(n_name) FROM nation) UNION ALL SELECT 'nothing', NULL""")
def point_lookups(spark, sf_dir):
    rows = qa.payloads(exported(spark, sf_dir))
    key = rows.agg(F.min("derived_from_question_id").alias("k")).first().k
    domains = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.concat(F.lit("n"), "n_nationkey").alias("slug"), F.col("n_nationkey").alias("ord"))
    found = qa.find_payload(rows, key).select(F.lit("payload").alias("what"), F.col("payload_id").alias("found")).unionByName(qa.resolve_domain(domains, domains.agg(F.max("name").alias("k")).first().k).select(F.lit("domain").alias("what"), F.col("slug").alias("found")))
    none = qa.resolve_domain(domains, "nowhere").agg(F.max("slug").alias("found")).select(F.lit("nothing").alias("what"), "found")
    return found.unionByName(none)


@query("SELECT n_nationkey, n_name AS bloom_level, n_nationkey AS shard_index, row_number() OVER (ORDER BY n_name, n_nationkey) AS place FROM nation")
def shard_order(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select("n_nationkey", F.concat("n_name", F.lit("--"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("name"))
    odd = spark.createDataFrame([(99, "no index"), (98, "x--12")], "n_nationkey int, name string")
    rows = shard_names(names.withColumn("n_nationkey", F.col("n_nationkey").cast("int")).unionByName(odd))
    return rows.select("n_nationkey", "bloom_level", "shard_index", F.row_number().over(Window.orderBy("bloom_level", "shard_index")).cast("long").alias("place"))


@query("SELECT doc_id, lang || ', ' || source AS bloom_level, (SELECT count(DISTINCT lang) FROM documents) AS languages FROM documents")
def joined_levels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", qa.normalized_bloom(F.array("lang", "source")).alias("bloom_level")).crossJoin(F.broadcast(qa.languages(docs, "lang")))
