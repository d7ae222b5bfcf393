"""Rule-generated decision records: quotas give each slot its decision and relation, hashed draws the rest, filters accept.

The rules are SQL expressions in a dialect that Spark and DuckDB share, level by level, as each level reads the one before.
`{u:stage}` stands for a draw from [0, 1) by seed, slot, attempt and stage.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import canonical_name, name_key, person_id, policy_record_id, stable_slot
from ..plans.dims import GIVEN_PREFIXES, GIVEN_SUFFIXES, NEUTRAL_TAGS, RELATIONS, SIGNAL_TAGS, STRATEGIES, SURNAMES
from ..sources.scratch import stored
from .ordinals import with_ordinals
from .sampling import decision_quotas, label_quotas, slots

VERSION, ATTEMPTS, SOFT_LIMIT = "1.1", 128, 2
#: Attempts that are drawn at once, for slots that no earlier one fits.
PASSES = (1, 4, 16, ATTEMPTS)
LOW_HIGH = ("low", "medium", "high")


def _pick(stage: str, values) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE CAST(floor({{u:{stage}}} * {len(values)}) AS INT) {cases} END)"


def _bias(p: float, stage: str, values, otherwise: str) -> str:
    """With probability p one of the values."""
    return f"(CASE WHEN {{u:{stage}?}} < {p} THEN {_pick(stage + '!', values)} ELSE {otherwise} END)"


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


ENGAGED = "decision IN ('engage_now', 'engage_briefly')"
KIN = _in("label", ("家人", "长辈"))
# Values, probabilities, labels and tags of the rules. Columns by level, from (decision, label, direction, typical).
LEVELS: list[dict[str, str]] = [
    {
        "relation_closeness": f"CASE WHEN {{u:closeness_typical}} < 0.5 THEN typical ELSE {_pick('closeness', LOW_HIGH)} END",
        "trust_any": _pick("trust", LOW_HIGH),
        "role_obligation": f"CASE WHEN {_in('label', ('导师', '上司', '家人', '长辈', '客户', '老师'))} THEN {_pick('obligation', ('medium', 'high'))} WHEN {_in('label', ('陌生人', '邻居'))} THEN {_pick('obligation', ('low', 'medium'))} ELSE {_pick('obligation', LOW_HIGH)} END",
        "power_asymmetry": f"CASE direction WHEN 'target_is_my_relation' THEN CASE WHEN {_in('label', ('上司', '导师', '长辈', '老师', '客户'))} THEN 'target_higher' ELSE {_pick('power', ('target_higher', 'equal'))} END WHEN 'i_am_targets_relation' THEN 'target_higher' ELSE 'equal' END",
        "tension_any": _pick("tension", LOW_HIGH),
        "reciprocity_history": _pick("reciprocity", ("negative", "neutral", "positive")),
        "energy": f"CASE WHEN {ENGAGED} THEN {_bias(0.6, 'energy', ('medium', 'high'), _pick('energy', LOW_HIGH))} WHEN decision IN ('decline', 'minimal_acknowledgment') THEN {_bias(0.5, 'energy', ('low', 'medium'), _pick('energy', LOW_HIGH))} ELSE {_pick('energy', LOW_HIGH)} END",
        "time_pressure": f"CASE WHEN decision = 'defer' THEN {_bias(0.6, 'time', ('medium', 'high'), _pick('time', LOW_HIGH))} ELSE {_pick('time', LOW_HIGH)} END",
        "cognitive_clarity": _pick("clarity", ("low", "partial", "high")),
        "emotional_activation": _pick("emotion", LOW_HIGH),
        "social_any": _pick("social", ("guarded", "neutral", "open")),
        "confidence_in_doing_the_action": _pick("confidence", LOW_HIGH),
        "local_cost": "'low'",
        "local_risk": "'low'",
        "expected_regret_if_declined": _pick("regret", LOW_HIGH),
        "strategy": "CASE decision " + " ".join(f"WHEN '{d}' THEN {_pick('strategy', v)}" for d, v in STRATEGIES.items()) + " END",
    },
    {
        "trust_in_target": f"CASE relation_closeness WHEN 'high' THEN {_bias(0.6, 'trust', ('medium', 'high'), 'trust_any')} WHEN 'low' THEN {_bias(0.6, 'trust', ('low', 'medium'), 'trust_any')} ELSE trust_any END",
        "unfinished_tension": f"CASE WHEN decision IN ('decline', 'set_boundary') AND tension_any = 'low' THEN {_bias(0.4, 'tension', ('medium', 'high'), 'tension_any')} ELSE tension_any END",
        "social_readiness": f"CASE WHEN {ENGAGED} AND social_any = 'guarded' THEN {_bias(0.4, 'social', ('neutral', 'open'), 'social_any')} ELSE social_any END",
    },
    {
        "implausible": f"({KIN} AND relation_closeness IN ('medium', 'high') AND decision = 'set_boundary') OR (label = '陌生人' AND role_obligation = 'high') OR (trust_in_target = 'high' AND unfinished_tension = 'high' AND reciprocity_history = 'positive')",
        "soft_issues": " + ".join(
            f"(CASE WHEN {rule} THEN 1 ELSE 0 END)"
            for rule in (
                "label = '陌生人' AND relation_closeness = 'high'",
                f"{KIN} AND relation_closeness = 'low'",
                "unfinished_tension = 'high' AND reciprocity_history = 'positive'",
                "role_obligation = 'high' AND decision IN ('minimal_acknowledgment', 'decline') AND time_pressure <> 'high' AND energy <> 'low'",
                "relation_closeness = 'high' AND decision IN ('decline', 'set_boundary') AND unfinished_tension = 'low' AND reciprocity_history <> 'negative'",
                "energy = 'low' AND decision = 'engage_now'",
                "time_pressure = 'low' AND decision = 'defer'",
                "trust_in_target = 'low' AND decision = 'engage_now'",
            )
        ),
        "reason_tags": "concat_ws('|', "
        + ", ".join(
            f"CASE WHEN {rule} THEN '{tag}' {('ELSE ' + repr(other) + ' ') if other else ''}END"
            for rule, tag, other in (
                ("decision = 'defer'", "can_do_later", None),
                (ENGAGED, "can_do_now", None),
                ("time_pressure = 'high'", "time_pressure_high", None),
                ("time_pressure = 'low'", "time_pressure_low", None),
                ("energy = 'low'", "energy_low", None),
                ("energy = 'high'", "energy_high", None),
                ("social_readiness = 'guarded'", "socially_guarded", None),
                ("social_readiness = 'open'", "socially_ready", None),
                ("cognitive_clarity IN ('partial', 'high')", "clarity_enables", "clarity_constrains"),
                ("trust_in_target IN ('medium', 'high')", "trust_enables_engagement", "trust_constrains_engagement"),
                ("relation_closeness IN ('medium', 'high')", "closeness_enables_engagement", None),
                ("unfinished_tension IN ('medium', 'high')", "tension_inhibits_engagement", None),
                ("role_obligation IN ('medium', 'high')", "obligation_preserved", "obligation_overridden"),
                ("local_cost = 'low'", "cost_acceptable", None),
                ("local_risk = 'low'", "risk_acceptable", None),
                ("expected_regret_if_declined = 'high'", "regret_high", None),
                ("expected_regret_if_declined = 'low'", "regret_low", None),
            )
        )
        + ")",
    },
]
RELATION_FIELDS = ("relation_closeness", "trust_in_target", "role_obligation", "power_asymmetry", "unfinished_tension", "reciprocity_history")
STATE_FIELDS = ("energy", "time_pressure", "cognitive_clarity", "emotional_activation", "social_readiness", "confidence_in_doing_the_action")
COST_FIELDS = ("local_cost", "local_risk", "expected_regret_if_declined")
SPARK_DRAW = "(cast(conv(substring(sha2(concat_ws('\\u001f', cast(seed as string), cast(slot as string), cast(attempt as string), '{stage}'), 256), 1, 8), 16, 10) as bigint) / 4294967296D)"
DUCKDB_DRAW = "(('0x' || substr(sha256(concat_ws(chr(31), seed, slot, attempt, '{stage}')), 1, 8))::UBIGINT / 4294967296.0)"


def drawn(expression: str, draw: str) -> str:
    """An expression of LEVELS with draws in a dialect."""
    return re.sub(r"\{u:([^}]*)\}", lambda m: draw.replace("{stage}", m[1]), expression)


def candidates(slots_: DataFrame) -> DataFrame:
    """All columns of LEVELS for (seed, slot, attempt, decision, label, direction, typical).

    inline() of one struct is a fence: filters on a later level are not rewritten in terms of an earlier one's expressions.
    """
    for level in LEVELS:
        slots_ = slots_.selectExpr("*", f"inline(array(struct({', '.join(f'{drawn(e, SPARK_DRAW)} AS {name}' for name, e in level.items())})))")
    return slots_


def policy_slots(spark: SparkSession, n: int, seed: int = 42, weights: dict[str, float] | None = None) -> DataFrame:
    """(slot, decision, label): both quotas, each shuffled by digest, zipped by rank; slots start at 1.

    If quotas are more than n in all (few records, a large weight), the first n slots are taken.
    """
    decision = with_ordinals(slots(spark, decision_quotas(n, weights), "decision", seed), ["key"], "slot").select("slot", F.col("value").alias("decision"))
    label = with_ordinals(slots(spark, label_quotas(n), "label", seed), ["key"], "slot").select("slot", F.col("value").alias("label"))
    return decision.where(F.col("slot") <= n).join(label, "slot")


def with_relation(slots_: DataFrame) -> DataFrame:
    rows = [(names[-1], k, d, t) for k, (names, d, t) in RELATIONS.items() if names]
    dim = slots_.sparkSession.createDataFrame(rows, "label string, relation_kind string, direction string, typical string")
    return slots_.join(F.broadcast(dim), "label")


def accepted(slots_: DataFrame, passes: tuple[int, ...] = PASSES) -> DataFrame:
    """For each slot its first attempt without a hard and with at most two soft issues.

    One attempt is drawn for all slots, and more in each pass for slots still open; a slot that no attempt fits is an error.
    """

    def tried(df, lo, hi):
        drawn_ = candidates(df.withColumn("attempt", F.explode(F.sequence(F.lit(lo), F.lit(hi - 1)))))
        fits = drawn_.where(~F.col("implausible") & (F.col("soft_issues") <= SOFT_LIMIT))
        return fits.groupBy("slot").agg(F.min_by(F.struct(*drawn_.columns), "attempt").alias("r")).select("r.*")

    slots_ = stored(slots_)
    left, lo, found = slots_, 0, None
    for hi in passes:
        own = stored(tried(left, lo, hi))
        found = own if found is None else found.unionByName(own)
        left, lo = slots_.join(found.select("slot"), "slot", "left_anti"), hi
    whole = slots_.select("slot").join(found, "slot", "left")
    check = F.when(F.col("decision").isNull(), F.raise_error(F.concat(F.lit("no attempt fits slot "), F.col("slot").cast("string")))).otherwise(F.col("decision"))
    return whole.withColumn("decision", check)


def policy_records(spark: SparkSession, n: int, seed: int = 42, weights: dict[str, float] | None = None) -> DataFrame:
    """n records: slot, record_id, counterparty, and the columns of LEVELS. Both histograms equal their quotas exactly."""
    rows = accepted(with_relation(policy_slots(spark, n, seed, weights)).withColumn("seed", F.lit(seed)))
    record = policy_record_id(F.col("slot"))
    return rows.withColumns({"record_id": record, "entity_id": person_id(record), "name_key": name_key(record), "reason_tags": F.array_distinct(F.split("reason_tags", r"\|"))})


def as_documents(records: DataFrame) -> DataFrame:
    """Records nested as they are stored."""
    pack = lambda names: F.struct(*[F.col(n) for n in names])
    return records.select(
        F.lit(VERSION).alias("schema_version"), F.lit(VERSION).alias("generator_version"), "record_id", F.lit("policy_records").alias("task_family"), F.col("seed").cast("long").alias("seed"),
        F.struct("entity_id", F.lit("person").alias("entity_type"), "name_key").alias("counterparty"),
        F.struct(*[F.lit(True).alias(x) for x in ("is_doable_now", "is_low_cost_nonzero", "is_formally_permissible")]).alias("request_contract"),
        F.struct(F.col("label").alias("relation_label"), F.col("direction").alias("relation_direction"), *RELATION_FIELDS).alias("relation"),
        pack(STATE_FIELDS).alias("state"), pack(COST_FIELDS).alias("cost_risk"), F.struct("decision", "strategy", "reason_tags").alias("policy"),
    )


def record_issues(records: DataFrame) -> DataFrame:
    """Nested records with the array `issues` of what breaks their contract."""
    r = F.col
    checks = {
        "schema_version": r("schema_version") != VERSION,
        "generator_version": r("generator_version") != VERSION,
        "record_id": F.coalesce(r("record_id"), F.lit("")) == "",
        "counterparty.entity_id": r("counterparty.entity_id") != person_id(r("record_id")),
        "counterparty.name_key": r("counterparty.name_key") != name_key(r("record_id")),
        "policy.decision": ~r("policy.decision").isin(*STRATEGIES),
        "policy.strategy": ~F.coalesce(F.array_contains(F.create_map(*[x for d, v in STRATEGIES.items() for x in (F.lit(d), F.array(*map(F.lit, v)))])[r("policy.decision")], r("policy.strategy")), F.lit(False)),
        "relation.relation_label": ~r("relation.relation_label").isin(*[label for names, *_ in RELATIONS.values() for label in names]),
    }
    return records.withColumn("issues", F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])))


def signal_tags(tags, most: int = 4):
    """The tags that say most, in their order; if there are none, all but the neutral ones."""
    strong = F.filter(tags, lambda t: t.isin(*SIGNAL_TAGS))
    return F.slice(F.when(F.size(strong) > 0, strong).otherwise(F.filter(tags, lambda t: ~t.isin(*NEUTRAL_TAGS))), 1, most)


def person_name(record_id):
    return canonical_name(stable_slot(record_id), SURNAMES, GIVEN_PREFIXES, GIVEN_SUFFIXES)


def realization_inputs(records: DataFrame) -> DataFrame:
    """What a text provider gets of each flat record."""
    return records.select(
        "record_id", person_name(F.col("record_id")).alias("counterparty_name"), F.struct("relation_kind", "direction", *RELATION_FIELDS[:5]).alias("relation"), F.struct(*STATE_FIELDS).alias("state"),
        F.struct("decision", "strategy").alias("decision"), signal_tags(F.col("reason_tags")).alias("reason_tags"),
    )
