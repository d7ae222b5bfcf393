"""Queries over the driver's tables, one for each group of operators, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators import compose, ledger, policy, qa, reports, sampling
from ..operators.ordinals import with_ordinals
from ..operators.provider import template
from ..sources.writers import shard_stats, spread_shards
from ..streaming.failures import windowed
from . import dims

RUN, TEXT_RUN, SEED, WEIGHTS = "run1", "pt1", 42, {"engage_now": 9.0}
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query by its function's name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _u32(expression: str) -> str:
    return f"('0x' || substr(sha256({expression}), 1, 8))::UBIGINT"


def _pool(key: str, salt: str, pool) -> str:
    return f"{_list(pool)}[({_u32(f'{key} || chr(31) || ' + repr(salt))} % {len(pool)})::INT + 1]"


def _slot(key: str) -> str:
    return f"(('0x' || substr(sha256({key}), 1, 16))::UBIGINT % 10000)::INT"


def _name(slot: str) -> str:
    return f"{_list(dims.SURNAMES)}[{slot} // 320 + 1] || {_list(dims.GIVEN_PREFIXES)}[({slot} % 320) // 16 + 1] || {_list(dims.GIVEN_SUFFIXES)}[{slot} % 16 + 1]"


def _base64(key: str) -> str:
    return f"rtrim(translate(base64(unhex(substr(sha256({key}), 1, 16))), '+/', '-_'), '=')"


# question/answer payloads

QA_SQL = f"""SELECT 'qa' AS payload_type, concat_ws(':', 'qa_corpus', '{RUN}', 'qa_export_sft_v1', domain_slug, question_id) AS payload_id, question_id AS derived_from_question_id,
  text AS request_text, answer AS fulfillment_content, domain_slug, node_path, {_pool('question_id', 'bloom', dims.BLOOM)} AS bloom_level
FROM (SELECT *, 'd' || (conv_id % 7) AS domain_slug, 'c' || conv_id AS node_path, 'c' || conv_id || '__q' || lpad(turn::VARCHAR, 4, '0') AS question_id FROM
  (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""


def exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answered questions of the conversations as export rows."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("answer"))
    pairs = turns.where("role = 'user' and next_role = 'assistant'")
    path = F.concat(F.lit("c"), F.col("conv_id"))
    rows = pairs.select(
        keys.question_id(path, F.col("turn")).alias("question_id"), F.col("text").alias("question"), "answer", F.concat(F.lit("Domain "), F.col("conv_id") % 7).alias("domain"),
        F.concat(F.lit("d"), F.col("conv_id") % 7).alias("domain_slug"), path.alias("node_path"),
    )
    return qa.export_rows(rows.withColumn("bloom_level", keys.pool_pick(F.col("question_id"), "bloom", dims.BLOOM)), RUN, "en")


@query(QA_SQL)
def qa_payloads(spark, sf_dir):
    return qa.payloads(exported(spark, sf_dir)).drop("source_path")


@query(f"""SELECT id, question_id, messages[1].role AS first_role, messages[1].content AS question, messages[2].content AS answer, domain, bloom_level FROM (
  SELECT payload_id AS id, derived_from_question_id AS question_id, [{{'role': 'user', 'content': request_text}}, {{'role': 'assistant', 'content': fulfillment_content}}] AS messages,
    'Domain ' || substr(domain_slug, 2) AS domain, bloom_level FROM ({QA_SQL}))""")
def export_projection(spark, sf_dir):
    m = F.col("messages")
    return exported(spark, sf_dir).select("id", "question_id", m[0]["role"].alias("first_role"), m[0]["content"].alias("question"), m[1]["content"].alias("answer"), "domain", "bloom_level")


@query(f"""SELECT payload_id, domain_slug, bloom_level FROM ({QA_SQL}) JOIN (VALUES ('d5', 0), ('d2', 1), ('nowhere', 2)) f(slug, place) ON slug = domain_slug
WHERE bloom_level IN ('apply', 'create') ORDER BY place, payload_id LIMIT 12""")
def filtered_payloads(spark, sf_dir):
    rows = qa.filtered_payloads(qa.payloads(exported(spark, sf_dir)), ["d5", "d2", "nowhere"], ["apply", "create"], 12)
    return rows.select("payload_id", "domain_slug", "bloom_level")


@query(f"""SELECT payload_id, target_level FROM (SELECT payload_id, unnest(CASE bloom_level {' '.join(f"WHEN '{k}' THEN {_list(v)}" for k, v in dims.LOWER_BLOOM.items())} ELSE []::VARCHAR[] END) AS target_level FROM ({QA_SQL}))""")
def bloom_targets(spark, sf_dir):
    return qa.lower_level_targets(qa.payloads(exported(spark, sf_dir)), dims.LOWER_BLOOM).select("payload_id", "target_level")


# distributions and roll-ups


@query("SELECT source AS value, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY source")
def domain_distribution(spark, sf_dir):
    return reports.distribution(table(spark, sf_dir, "documents"), "source", "doc_id")


@query("""SELECT CASE WHEN grouping(lang) = 0 THEN 'lang' WHEN grouping(source) = 0 THEN 'source' ELSE 'short' END AS dimension,
  CASE WHEN grouping(lang) = 0 THEN lang WHEN grouping(source) = 0 THEN source ELSE short END AS value, count(*) AS n, min(doc_id) AS first
FROM (SELECT *, CASE WHEN n_chars < 1000 THEN 'true' ELSE 'false' END AS short FROM documents) GROUP BY GROUPING SETS ((lang), (source), (short))""")
def multi_distribution(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("short", (F.col("n_chars") < 1000).cast("string"))
    return reports.distributions(docs, ["lang", "source", "short"], "doc_id")


@query("SELECT source, count(*) AS records, grouping(source)::INT AS is_total FROM documents GROUP BY ROLLUP (source)")
def manifest_rollup(spark, sf_dir):
    return reports.rollup_counts(table(spark, sf_dir, "documents"), "source")


@query("""SELECT event_type, n, round(n * 100.0 / sum(n) OVER (), 6) AS percent, repeat('█', greatest(1, floor(n * 100.0 / sum(n) OVER ())::INT)) AS bar,
  CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS place FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""")
def event_histogram(spark, sf_dir):
    return reports.histogram(table(spark, sf_dir, "events"), "event_type", ["view", "click"]).withColumn("percent", F.round("percent", 6))


@query("SELECT count(DISTINCT source) AS domains, count(DISTINCT nullif(lang, '')) AS levels, count(DISTINCT nullif(lang, '')) < 3 AS few_levels FROM documents")
def diversity(spark, sf_dir):
    return reports.diversity(table(spark, sf_dir, "documents"), "source", "lang")


@query("""SELECT lang, count(*) AS n, round(avg(CASE WHEN quality >= 0.5 AND 1 - toxic < 0.5 THEN 1.0 ELSE 0.0 END), 9) AS overconfident FROM labels JOIN documents USING (doc_id) GROUP BY ROLLUP (lang)""")
def calibration(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return reports.calibration(rows, ["lang"], F.col("quality"), 1 - F.col("toxic")).select("lang", "n", F.round("overconfident", 9).alias("overconfident"))


@query("""SELECT payloads, texts, CASE WHEN payloads > 0 AND texts > 0 THEN 'ready' ELSE 'blocked' END AS readiness
FROM (SELECT count(*) AS payloads FROM conversations), (SELECT count(*) AS texts FROM documents WHERE lang = 'xx')""")
def readiness(spark, sf_dir):
    return reports.readiness(table(spark, sf_dir, "conversations"), table(spark, sf_dir, "documents").where("lang = 'xx'"))


@query("""SELECT *, CASE WHEN completed + failed < total THEN 'running' WHEN failed = 0 THEN 'completed' WHEN completed = 0 THEN 'failed' ELSE 'completed_with_failures' END AS status FROM (
  SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS completed, count(*) FILTER (o_orderstatus = 'O' AND o_orderkey % 2 = 0) AS failed FROM orders GROUP BY o_orderpriority)""")
def stage_status(spark, sf_dir):
    return reports.stage_status(table(spark, sf_dir, "orders"), "o_orderpriority", F.col("o_orderstatus") == "F", (F.col("o_orderstatus") == "O") & (F.col("o_orderkey") % 2 == 0))


# joins


@query(f"""WITH p AS (SELECT *, row_number() OVER (ORDER BY payload_id) AS i FROM ({QA_SQL})), t AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS j FROM documents WHERE lang = 'fr')
SELECT p.i AS index, payload_id, doc_id FROM p JOIN t ON (p.i - 1) % (SELECT count(*) FROM t) + 1 = t.j""")
def modulo_pairing(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").where("lang = 'fr'").select("doc_id")
    pairs = compose.modulo_pairs(qa.payloads(exported(spark, sf_dir)).select("payload_id"), texts, ["payload_id"], ["doc_id"])
    return pairs.select("index", "left.payload_id", "right.doc_id")


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority LIKE '1%')")
def resume_pending(spark, sf_dir):
    orders, done = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return ledger.pending(orders.select("o_orderkey"), done, ["o_orderkey"], orders.where("o_orderpriority like '1%'"))


@query("""SELECT status, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NOT NULL THEN 'ok' WHEN d.n_chars < 1500 THEN 'skipped' ELSE 'error' END AS status FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) GROUP BY status""")
def answer_integrity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return ledger.integrity(docs, table(spark, sf_dir, "labels"), docs.where("n_chars < 1500"), "doc_id").groupBy("status").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, concat_ws('; ', CASE WHEN o_orderkey IS NULL THEN 'missing_source' END, CASE WHEN o_orderkey IS NOT NULL AND status IS DISTINCT FROM o_orderstatus THEN 'status_differs' END) AS issues
FROM (SELECT *, CASE l_linestatus WHEN 'F' THEN 'F' ELSE 'O' END AS status FROM lineitem) LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 10 <> 0) ON l_orderkey = o_orderkey""")
def fk_integrity(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.when(F.col("l_linestatus") == "F", "F").otherwise("O").alias("status"))
    found = ledger.source_mismatches(rows, table(spark, sf_dir, "orders").where("o_orderkey % 10 <> 0"), "o_orderkey", {"status": "o_orderstatus"})
    return found.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", F.array_join("issues", "; ").alias("issues"))


# keys


@query(f"""SELECT c_custkey, slot, format('name_slot_{{:04d}}', slot) AS name_key, {_name('slot')} AS canonical_name, {_pool('c_name', 'reply_tool_name', dims.REPLY_TOOLS)} AS tool,
  {_base64("c_name || chr(31) || 'p' || chr(31) || 'rendered_entity_id'")} AS rendered_id, 'person__sample__' || trim(regexp_replace(c_name, '[^A-Za-z0-9_]+', '_', 'g'), '_') || '__' || substr(sha256(c_name || chr(31) || 'p'), 1, 12) || '__primary' AS sample_person,
  'acml__' || substr(sha256(c_name || chr(31) || 'x'), 1, 20) AS sample_id FROM (SELECT *, {_slot('c_name')} AS slot FROM customer)""")
def identity_keys(spark, sf_dir):
    name = F.col("c_name")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", keys.stable_slot(name).alias("slot"))
    return rows.select(
        "c_custkey", "slot", keys.name_key(name).alias("name_key"), keys.canonical_name(F.col("slot"), dims.SURNAMES, dims.GIVEN_PREFIXES, dims.GIVEN_SUFFIXES).alias("canonical_name"),
        keys.pool_pick(name, "reply_tool_name", dims.REPLY_TOOLS).alias("tool"), keys.rendered_person_id(name, F.lit("p")).alias("rendered_id"), keys.sample_person_id(name, F.lit("p")).alias("sample_person"),
        keys.sample_id(name, "x").alias("sample_id"),
    )


@query("SELECT doc_id, row_number() OVER (ORDER BY sha256('42' || chr(31) || doc_id), doc_id) AS place FROM documents QUALIFY place <= 100")
def hash_shuffle_limit(spark, sf_dir):
    top = sampling.shuffled_limit(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"), 100)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*sampling.shuffled(top, F.col("doc_id")))).cast("long"))


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256('42' || chr(31) || doc_id), doc_id) <= 5")
def balanced_sample(spark, sf_dir):
    return sampling.per_stratum(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], F.col("doc_id"), 5)


PHASE = {"remember": 0.4, "understand": 0.3, "apply": 0.2, "analyze": 0.1}


@query(f"""SELECT payload_id, bloom_level FROM ({QA_SQL}) JOIN (VALUES ('remember', 16), ('understand', 12), ('apply', 8), ('analyze', 4)) q(level, n) ON level = bloom_level
QUALIFY row_number() OVER (PARTITION BY bloom_level ORDER BY sha256('42' || chr(31) || payload_id), payload_id) <= n""")
def curriculum_mix(spark, sf_dir):
    rows = qa.payloads(exported(spark, sf_dir)).select("payload_id", "bloom_level")
    return sampling.by_quota(rows, "bloom_level", sampling.phase_quotas(40, PHASE), F.col("payload_id"))


@query("SELECT count(*) FILTER (quality = 1) AS completed_count, count(*) FILTER (quality <> 1) AS failed_count, coalesce(sum(toxic), 0)::BIGINT AS rejections FROM labels")
def outcome_totals(spark, sf_dir):
    return ledger.outcome_totals(table(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("ok"), F.col("toxic").alias("rejections")))


@query("SELECT doc_id, row_number() OVER (ORDER BY source, n_chars, doc_id) AS ordinal FROM documents")
def global_ordinals(spark, sf_dir):
    return with_ordinals(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), ["source", "n_chars", "doc_id"]).select("doc_id", "ordinal")


# quotas and rule-generated records

QUOTA_SQL = f"""SELECT d.*, CASE WHEN spare >= 0 THEN start + floor(spare * w / 15)::BIGINT + (i < spare - floor(spare * 9 / 15.0)::BIGINT - 6 * floor(spare / 15.0)::BIGINT)::INT
    WHEN i = 0 THEN start ELSE start - floor(-spare / 6.0)::BIGINT - (i <= -spare - 6 * floor(-spare / 6.0)::BIGINT)::INT END AS quota
FROM (SELECT *, n - (15 * greatest(1, n // 14)) AS spare, (greatest(1, n // 14) * w)::BIGINT AS start FROM
  (SELECT unnest({_list(dims.DECISIONS)}) AS decision, unnest(range(7)) AS i, unnest([9, 1, 1, 1, 1, 1, 1]) AS w), (SELECT count(*) AS n FROM customer)) d"""


def _customers(spark, sf_dir) -> int:
    return table(spark, sf_dir, "customer").count()


@query(f"SELECT decision, quota::BIGINT AS quota FROM ({QUOTA_SQL})")
def decision_quota(spark, sf_dir):
    return spark.createDataFrame(list(sampling.decision_quotas(_customers(spark, sf_dir), WEIGHTS).items()), "decision string, quota long")


LABELS = [names[-1] for names, *_ in dims.RELATIONS.values() if names]
LABEL_SQL = f"SELECT unnest({_list(LABELS)}) AS label, unnest(range(15)) AS i, (SELECT count(*) FROM customer) AS n"
SLOT_SQL = f"""SELECT d.slot, decision, label FROM
  (SELECT decision, row_number() OVER (ORDER BY sha256(concat_ws(chr(31), '{SEED}', 'decision', decision, k))) AS slot FROM (SELECT decision, unnest(range(1, quota::BIGINT + 1)) AS k FROM ({QUOTA_SQL}))) d
  JOIN (SELECT label, row_number() OVER (ORDER BY sha256(concat_ws(chr(31), '{SEED}', 'label', label, k))) AS slot FROM (SELECT label, unnest(range(1, greatest(1, n // 15 + (i < n % 15)::INT)::BIGINT + 1)) AS k FROM ({LABEL_SQL}))) l ON d.slot = l.slot"""


@query(SLOT_SQL)
def policy_slots(spark, sf_dir):
    return policy.policy_slots(spark, _customers(spark, sf_dir), SEED, WEIGHTS)


def _candidate_sql(attempts: str, slots: str) -> str:
    relation = ", ".join(f"('{names[-1]}', '{k}', '{d}', '{t}')" for k, (names, d, t) in dims.RELATIONS.items() if names)
    sql = f"SELECT {SEED} AS seed, s.slot, a.attempt, decision, s.label, relation_kind, direction, typical FROM ({slots}) s JOIN (VALUES {relation}) r(label, relation_kind, direction, typical) ON r.label = s.label, (SELECT unnest(range({attempts})) AS attempt) a"
    for level in policy.LEVELS:
        sql = f"SELECT *, {', '.join(f'{policy.drawn(e, policy.DUCKDB_DRAW)} AS {n}' for n, e in level.items())} FROM ({sql})"
    return sql


@query(f"SELECT slot, attempt::INT AS attempt, implausible, soft_issues::INT AS soft_issues, reason_tags FROM ({_candidate_sql('3', SLOT_SQL)})")
def policy_candidates(spark, sf_dir):
    slots = policy.with_relation(policy.policy_slots(spark, _customers(spark, sf_dir), SEED, WEIGHTS)).withColumn("seed", F.lit(SEED)).withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(2))))
    return policy.candidates(slots).select("slot", "attempt", "implausible", "soft_issues", "reason_tags")


RECORD_SQL = f"""SELECT * FROM ({_candidate_sql(str(policy.ATTEMPTS), SLOT_SQL)}) WHERE NOT implausible AND soft_issues <= 2 QUALIFY row_number() OVER (PARTITION BY slot ORDER BY attempt) = 1"""
RECORD_COLUMNS = ["decision", "label", "relation_kind", "strategy", *policy.RELATION_FIELDS, *policy.STATE_FIELDS, *policy.COST_FIELDS]


@query(f"SELECT format('policy_rec__{{:06d}}', slot) AS record_id, attempt::INT AS attempt, {', '.join(RECORD_COLUMNS)}, reason_tags FROM ({RECORD_SQL})")
def policy_records(spark, sf_dir):
    rows = policy.policy_records(spark, _customers(spark, sf_dir), SEED, WEIGHTS)
    return rows.select("record_id", "attempt", *RECORD_COLUMNS, F.array_join("reason_tags", "|").alias("reason_tags"))


# realization, composition, validation


def realized(spark, sf_dir) -> DataFrame:
    """Records with texts of the template provider, every other one in the other language."""
    rows = policy.policy_records(spark, _customers(spark, sf_dir), SEED, WEIGHTS)
    name = policy.person_name(F.col("record_id"))
    inputs = rows.select(
        F.col("record_id").alias("source_policy_record_id"), keys.policy_text_id(F.col("record_id")).alias("record_id"), "relation_kind", F.col("decision").alias("policy_decision"),
        F.when(F.col("slot") % 2 == 0, "zh").otherwise("en").alias("language"), name.alias("name"), keys.first_mention(name, F.col("relation_kind")).alias("mention"),
    )
    return template(inputs)


def flagship(spark, sf_dir) -> DataFrame:
    """Payloads by the modulo join with English texts, composed, rendered, read back and checked."""
    texts = realized(spark, sf_dir).where("language = 'en'")
    pairs = compose.modulo_pairs(qa.payloads(exported(spark, sf_dir)), texts, ["payload_id"], ["record_id"]).select(F.col("left").alias("payload"), F.col("right").alias("text"), F.lit("en").alias("language"))
    return compose.round_trip_issues(compose.document(compose.composed(pairs, qa_run=RUN, qa_view=qa.VIEW, text_run=TEXT_RUN)))


PAIR_SQL = f"""(WITH t AS (SELECT *, row_number() OVER (ORDER BY record_id) AS j FROM (SELECT format('policy_rec__{{:06d}}', slot) AS source_id, 'policy_text__' || format('policy_rec__{{:06d}}', slot) || '__r01' AS record_id, relation_kind, decision
    FROM ({SLOT_SQL}) s JOIN (VALUES {", ".join(f"('{names[-1]}', '{k}')" for k, (names, *_) in dims.RELATIONS.items() if names)}) r(l, relation_kind) ON r.l = s.label WHERE slot % 2 = 1)),
  p AS (SELECT *, row_number() OVER (ORDER BY payload_id) AS i FROM ({QA_SQL}))
  SELECT p.*, t.*, 'acml__' || substr(sha256(concat_ws(chr(31), '{RUN}', 'qa_export_sft_v1', payload_id, '{TEXT_RUN}', record_id, 'en')), 1, 20) AS sample_id, 'person__' || source_id || '__primary' AS person,
    {_name(_slot('source_id'))} AS name FROM p JOIN t ON (p.i - 1) % (SELECT count(*) FROM t) + 1 = t.j)"""


@query(f"""SELECT sample_id, payload_id, record_id, relation_kind, decision = 'engage_now' AS will_help_now, {_base64("concat_ws(chr(31), sample_id, person, 'rendered_entity_id')")} AS rendered_id,
  {_pool('sample_id', 'reply_tool_name', dims.REPLY_TOOLS)} AS reply_tool_name, {_pool('sample_id', 'belief_runtime_affordance:en', list(dims.PRELUDES['en']))} AS variant,
  name || '[' || relation_kind || ']' || CASE WHEN relation_kind IN ('stranger', 'partner') THEN ' asks me: ' ELSE ' says to me: ' END AS observation_wrapper,
  CASE WHEN decision = 'engage_now' THEN regexp_replace(fulfillment_content, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') ELSE '' END AS reply_action_text, 0 AS n_issues FROM {PAIR_SQL}""")
def compose_messages(spark, sf_dir):
    c = F.col
    return flagship(spark, sf_dir).select(
        "sample_id", c("payload.payload_id"), c("text.record_id"), c("text.relation_kind"), "will_help_now", c("rendered_counterparty_entity_id").alias("rendered_id"), "reply_tool_name",
        c("belief_runtime_affordance_variant_id").alias("variant"), "observation_wrapper", "reply_action_text", F.size("issues").alias("n_issues"),
    )


def _escaped(text: str) -> str:
    for raw, out in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = f"replace({text}, '{raw}', '{out}')"
    return f"replace({text}, chr(13), '&#13;')"


_CUE = "CASE decision " + " ".join(f"WHEN '{d}' THEN '{must['en'][0].replace(chr(39), chr(39) * 2)}'" for d, (must, _) in dims.CUES.items()) + " END"
_PRELUDE = f"CASE {_pool('sample_id', 'belief_runtime_affordance:en', list(dims.PRELUDES['en']))} " + " ".join(f"WHEN '{v}' THEN '{t.replace(chr(39), chr(39) * 2)}'" for v, t in dims.PRELUDES["en"].items()) + " END"
_INTENT = "CASE decision " + " ".join(f"WHEN '{d}' THEN '{i}'" for d, i in dims.DECISIONS.items()) + " END"
DOCUMENT_SQL = f"""WITH c AS (SELECT *, {_base64("concat_ws(chr(31), sample_id, person, 'rendered_entity_id')")} AS rid, {_pool('sample_id', 'reply_tool_name', dims.REPLY_TOOLS)} AS tool, name || '[' || relation_kind || ']' AS mention, {_PRELUDE} AS prelude, {_INTENT} AS intent,
    'About ' || name || ': ' || {_CUE} || '.' AS thinking, CASE WHEN decision = 'engage_now' THEN regexp_replace(fulfillment_content, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g') ELSE '' END AS reply FROM {PAIR_SQL}),
  t AS (SELECT *, prelude || chr(10) || 'void ' || tool || '(string target_entity_id, string message);' || chr(10) || chr(10) || 'I know ' || name || ' and my day is rather full.' AS belief_text,
    'known_people_json:' || chr(10) || '[{{"entity_id":"' || rid || '","entity_type":"person","relation":"' || relation_kind || '","name":"' || name || '","mention":"' || mention || '"}}]' || chr(10) || chr(10) AS registry FROM c)
SELECT sample_id, belief_text, 0 AS n_issues, '<document version="0" task="help_gate_acml_v1" composition_version="1.8" language="en" sample_id="' || sample_id || '"><entry kind="observation" source="qa" relation="' || relation_kind || '" entity_id="' || rid
  || '" entity_name="' || name || '" entity_mention="' || mention || '">' || mention || CASE WHEN relation_kind IN ('stranger', 'partner') THEN ' asks me: ' ELSE ' says to me: ' END || '<payload>' || {_escaped('request_text')} || '</payload></entry>'
  || '<entry kind="belief" source="policy_text+runtime">' || {_escaped('registry || belief_text')} || '</entry><entry kind="me" source="policy_text+qa" will_help_now="' || (decision = 'engage_now')::VARCHAR || '" response_intent="' || intent || '" policy_decision="' || decision || '">'
  || {_escaped('thinking')} || CASE WHEN reply = '' THEN '' ELSE chr(10) || '<action tool="' || tool || '" dialect="csharp-v0" target_entity_id="' || rid || '">' || {_escaped("tool || '(target_entity_id: ' || chr(34) || rid || chr(34) || ', message: '")}
  || '<payload>' || {_escaped('reply')} || '</payload>)</action>' END || '</entry></document>' AS markup FROM t"""


@query(DOCUMENT_SQL)
def composed_documents(spark, sf_dir):
    return flagship(spark, sf_dir).select("sample_id", "markup", "belief_text", F.size("issues").alias("n_issues"))


@query("""SELECT doc_id, len(list_filter(range(1, len(parts)), lambda i: NOT contains(right(array_to_string(parts[1:i], 'and'), 24), ' not ') AND NOT contains(right(array_to_string(parts[1:i], 'and'), 24), 'never '))) > 0 AS affirmative
FROM (SELECT doc_id, string_split(lower(replace(text, ' of ', ' not ')), 'and') AS parts FROM documents)""")
def negation_match(spark, sf_dir):
    own = F.replace(F.col("text"), F.lit(" of "), F.lit(" not "))
    return table(spark, sf_dir, "documents").select("doc_id", text.affirmative(own, "and", "en").alias("affirmative"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark, sf_dir):
    fenced = F.concat(F.lit("Here it is: "), F.col("props"), F.lit(' and {"k": 0} too'))
    rows = table(spark, sf_dir, "events").select("event_id", text.parsed_object(fenced).alias("v"))
    return rows.select("event_id", F.try_variant_get("v", "$.k", "string").alias("k"))


@query(r"""SELECT p_partkey, coalesce(nullif(trim(regexp_replace(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9\x{4e00}-\x{9fff}\s_-]', '', 'g'), '[\s-]+', '_', 'g'), '_'), ''), 'untitled') AS slug FROM part""")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.slugify(F.concat("p_name", F.lit(" / "), "p_type")).alias("slug"))


@query(r"""SELECT doc_id, CASE WHEN length(flat) <= 80 THEN flat ELSE rtrim(substr(flat, 1, 77)) || '...' END AS preview FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '[\s\p{Z}]+', ' ', 'g'), '^ | $', '', 'g') AS flat FROM documents)""")
def previews(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.preview(F.col("text"), 80).alias("preview"))


@query("SELECT page_id, url AS decoded, strlen(url_encode(url)) AS size FROM pages")
def item_names(spark, sf_dir):
    name = text.percent_encode(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", text.percent_decode(name).alias("decoded"), F.length(name).cast("long").alias("size"))


# merges, trees, logs, shards


@query("""WITH a AS (SELECT 0 AS src_ord, doc_id AS pos, text, lang FROM documents WHERE n_chars < 3000 UNION ALL SELECT 1, doc_id, text, lang FROM documents)
SELECT src_ord, count(*) AS records, count(*) FILTER (rn = 1) AS kept FROM (SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY src_ord, pos) AS rn FROM a) GROUP BY src_ord""")
def merge_union(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "text", "lang", "n_chars")
    return qa.merge_counts(qa.merged([docs.where("n_chars < 3000"), docs], ["text", "lang"]))


@query("SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1")
def exact_dedupe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), "text", "lang")
    return qa.merged([docs], ["text", "lang"]).where("kept").select(F.col("pos").alias("doc_id"))


@query("SELECT source, to_json(list_sort(list(DISTINCT lang)))::VARCHAR AS names FROM documents WHERE lang <> '' GROUP BY source HAVING count(DISTINCT lang) > 1")
def name_conflicts(spark, sf_dir):
    return qa.name_conflicts(table(spark, sf_dir, "documents"), "source", "lang").select("source", F.to_json("names").alias("names"))


@query(r"""SELECT node_path, format('{}__q{:04d}', node_path, row_number() OVER (PARTITION BY node_path ORDER BY pos)) AS id, pos FROM (
  SELECT source AS node_path, min(doc_id) AS pos FROM (SELECT *, regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS t FROM documents) WHERE t <> '' GROUP BY source, t)""")
def question_dedupe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("node_path"), "text", F.col("doc_id").alias("pos"))
    return qa.kept_questions(docs).select("node_path", "id", "pos")


TREE_SQL = """(SELECT 'root' AS id, NULL AS parent, '' AS slug UNION ALL SELECT 'r' || r_regionkey, 'root', lower(r_name) FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, lower(n_name) FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, lower(c_name) FROM customer)"""


@query(f"""WITH RECURSIVE t AS (SELECT id, []::VARCHAR[] AS path, 0 AS depth FROM {TREE_SQL} WHERE parent IS NULL UNION ALL SELECT n.id, list_append(t.path, n.slug), t.depth + 1 FROM {TREE_SQL} n JOIN t ON n.parent = t.id)
SELECT id, array_to_string(path, '/') AS path, depth, row_number() OVER (ORDER BY path, id) AS ordinal FROM t WHERE id NOT IN (SELECT parent FROM {TREE_SQL} WHERE parent IS NOT NULL)""")
def leaf_paths(spark, sf_dir):
    node = lambda df, i, parent, name: df.select(F.concat(F.lit(i[0]), F.col(i[1:])).alias("id"), parent.alias("parent"), F.lower(name).alias("slug"))
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    nodes = spark.createDataFrame([("root", None, "")], "id string, parent string, slug string")
    nodes = nodes.unionByName(node(region, "rr_regionkey", F.lit("root"), "r_name")).unionByName(node(nation, "nn_nationkey", F.concat(F.lit("r"), "n_regionkey"), "n_name"))
    nodes = nodes.unionByName(node(customer, "cc_custkey", F.concat(F.lit("n"), "c_nationkey"), "c_name"))
    return qa.ordered_leaves(qa.tree_paths(nodes, 3)).select("id", F.array_join("path", "/").alias("path"), "depth", "ordinal")


ATTEMPT_SQL = """(SELECT user_id, event_id, ((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) % 3 + 1)::INT AS attempt FROM events WHERE event_type = 'error')"""


def _failures(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'error'").select("user_id", "event_id", "ts")


@query(f"SELECT user_id, event_id, attempt, CASE WHEN attempt = 3 THEN 'dead_letter' ELSE 'retry' END AS action FROM {ATTEMPT_SQL}")
def failure_attempts(spark, sf_dir):
    return ledger.attempts(_failures(spark, sf_dir), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "attempt", "action")


@query(f"""SELECT bucket, count(*) FILTER (stage = 'question') AS question_dead_letters, count(*) FILTER (stage = 'answer') AS answer_dead_letters FROM (
  SELECT user_id % 10 AS bucket, CASE WHEN user_id % 2 = 0 THEN 'question' ELSE 'answer' END AS stage FROM {ATTEMPT_SQL} WHERE attempt = 3 GROUP BY user_id) GROUP BY bucket""")
def dead_letters(spark, sf_dir):
    dead = ledger.attempts(_failures(spark, sf_dir), ["user_id"], ["ts", "event_id"]).where("action = 'dead_letter'")
    last = ledger.latest(dead, ["user_id"], F.struct("ts", "event_id")).withColumns({"bucket": F.col("user_id") % 10, "stage": F.when(F.col("user_id") % 2 == 0, "question").otherwise("answer")})
    return ledger.dead_letter_summary(last, "bucket", ["question", "answer"])


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def failure_windows(spark, sf_dir):
    return windowed(table(spark, sf_dir, "events"), "ts", "1 hour", ["event_type"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, count(*) AS changes FROM events WHERE (user_id % 3 = 0 AND event_type IN ('view', 'click')) OR (user_id % 3 = 1 AND event_type = 'purchase') OR (user_id % 3 = 2 AND event_type NOT IN ('view', 'purchase')) GROUP BY user_id, event_type""")
def folded_state(spark, sf_dir):
    layer = F.when(F.col("user_id") % 3 == 0, "fast").when(F.col("user_id") % 3 == 1, "goal").otherwise("slow")
    events = table(spark, sf_dir, "events").withColumns({"layer": layer, "at": F.struct("ts", "event_id")})
    return reports.folded_state(events, "user_id", "at", "layer", "event_type", "event_id", {"fast": ["view", "click"], "goal": ["purchase"], "slow": ["click", "error", "signup"]})


SHARD = 200_000
SHARD_SQL = f"""(SELECT *, (before // {SHARD})::INT AS shard_index FROM (SELECT doc_id, lang, strlen(text) AS length, coalesce(sum(strlen(text)) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM documents))"""


def _shards(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.octet_length("text").cast("long").alias("length"))
    return spread_shards(docs, "lang", "doc_id", "length", SHARD)


@query(f"SELECT doc_id, shard_index, before - min(before) OVER (PARTITION BY lang, shard_index) AS \"offset\" FROM {SHARD_SQL}")
def shard_assign(spark, sf_dir):
    return _shards(spark, sf_dir).select("doc_id", "shard_index", "offset")


@query(f"SELECT lang, shard_index, count(*) AS sample_count, sum(length)::BIGINT AS data_bytes, count(*) * 8 AS offsets_bytes FROM {SHARD_SQL} GROUP BY lang, shard_index")
def shards(spark, sf_dir):
    return shard_stats(_shards(spark, sf_dir), "lang", "length")
