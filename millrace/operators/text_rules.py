"""Rules for realized texts: each broken rule is one issue (code, origin, field, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import affirmative_any, contains_any, strip_text
from ..plans.dims import CUES, DECISIONS, HELP_NOW, LATER

BELIEF_MOST, THINKING_MOST = 220, 120
# Field names that must not show in a text.
JARGON = (
    "relation_closeness", "trust_in_target", "role_obligation", "power_asymmetry", "unfinished_tension", "reciprocity_history", "time_pressure", "cognitive_clarity",
    "reason_tags", "counterparty_mention", "counterparty_entity_id", "counterparty_canonical_name", "counterparty_first_mention_name", "canonical_name", "first_mention_name",
)
# Words for a person that must be the name instead, and what gives a decision away in a belief.
GENERIC = {"zh": ("对方", "这个人", "那个人"), "en": ("the other person", "this person", "that person")}
PRONOUN = {"zh": "(?:他们|她们|(?<![其吉])他|她)|(?i:(?<![A-Za-z])ta(?![A-Za-z]))", "en": r"(?iU)\b(?:you|your|he|she|him|his|her|hers|himself|herself|they|them|their|theirs|themself|themselves)\b"}
ADDRESS = {"zh": "[你您]", "en": r"(?iU)\b(?:you|your)\b"}
FIRST_PERSON = {"zh": "我", "en": r"(?iU)\b(i|i'm|i’ve|i'd|i'll|me|my)\b"}
LEAK = {
    "zh": "|".join((
        "我(?:现在)?决定", "还是先", "我(?:得|要|需要|必须)先", "我(?:得|要|需要|必须)(?:跟|和).{0,12}(?:说清|讲清|说明|明确)", "先(?:跟|和).{0,12}(?:说清|讲清|说明|明确)",
        "我来处理|这就处理|现在接下|马上处理|立刻处理", "不接这个请求|现在不接|先不接", "(?:晚点|之后|回头|稍后|改天|等我).{0,8}(?:处理|再说|再聊|再帮|再回)", "收到|知道了|先回应|先答一句|先说一声",
    )),
    "en": "(?iU)" + "|".join((
        r"\bi (?:decide|decided|am deciding)\b", r"\b(?:first )?i(?:'ll| will)\b", r"\blet me\b", r"\bi (?:need|have) to (?:reply|respond|tell|say no|set|handle|take)\b",
        r"\b(?:got it|noted|message received)\b", r"\b(?:later|tomorrow|tonight|after this)\b.{0,16}\b(?:handle|reply|help|deal with|get back to)\b",
    )),
}


def _issue(bad: Column, code: str, message: str, field: str | None = None) -> Column:
    return F.when(bad, F.struct(F.lit(code).alias("code"), F.lit("rule_validator").alias("origin"), F.lit(field).cast("string").alias("field"), F.lit(message).alias("message")))


def _of(language: Column, make) -> Column:
    """A condition that differs by language; false for a language without rules."""
    return F.when(language == "zh", make("zh")).when(language == "en", make("en")).otherwise(F.lit(False))


def text_issues(belief: Column, thinking: Column, decision: Column, language: Column, name: Column, mention: Column) -> Column:
    """All issues of a text, in the order of the rules. Null texts count as empty."""
    belief, thinking = strip_text(F.coalesce(belief, F.lit(""))), strip_text(F.coalesce(thinking, F.lit("")))
    both = F.concat(belief, F.lit("\n"), thinking)
    named = lambda t: F.contains(t, mention) | F.contains(t, name)
    helps = _of(language, lambda k: affirmative_any(thinking, HELP_NOW[k], k))
    now = decision == "engage_now"
    missing, conflict = F.lit(False), F.lit(False)
    for d, (must, not_later) in CUES.items():
        missing = F.when(decision == d, _of(language, lambda k, must=must: ~contains_any(thinking, must[k]))).otherwise(missing)
        if d != "engage_now":
            clash = _of(language, lambda k, late=not_later: affirmative_any(thinking, HELP_NOW[k], k) | (contains_any(thinking, LATER[k]) if late else F.lit(False)))
            conflict = F.when(decision == d, clash).otherwise(conflict)
    issues = [
        _issue(belief == "", "belief_empty", "belief is empty", "belief"),
        _issue(thinking == "", "thinking_empty", "thinking is empty", "thinking"),
        _issue((belief != "") & ~named(belief), "missing_counterparty_name", "belief lacks the name", "belief"),
        _issue((thinking != "") & ~named(thinking), "missing_counterparty_name", "thinking lacks the name", "thinking"),
        _issue(F.length(belief) > BELIEF_MOST, "belief_too_long", "belief is too long", "belief"),
        _issue(F.length(thinking) > THINKING_MOST, "thinking_too_long", "thinking is too long", "thinking"),
        *[_issue(F.contains(F.lower(both), F.lit(w)), "schema_jargon", f"names the field {w}") for w in JARGON],
        _issue((belief != "") & _of(language, lambda k: ~belief.rlike(FIRST_PERSON[k])), "belief_not_first_person", "belief is not in the first person", "belief"),
        _issue(_of(language, lambda k: belief.rlike(LEAK[k])), "belief_decision_leak", "belief tells the decision", "belief"),
        _issue(_of(language, lambda k: both.rlike(ADDRESS[k])), "counterparty_direct_address", "addresses the counterparty"),
        _issue(_of(language, lambda k: both.rlike(PRONOUN[k])), "counterparty_pronoun", "a pronoun stands for the counterparty"),
        _issue(_of(language, lambda k: contains_any(both, GENERIC[k])), "counterparty_generic_placeholder", "a placeholder stands for the counterparty"),
        _issue(F.when(now, ~helps).otherwise(helps), "intent_immediate_help_mismatch", "help now does not fit the decision", "thinking"),
        _issue(missing, "intent_missing_cue", "no cue of the intent", "thinking"),
        _issue(conflict, "intent_conflicting_cue", "a cue of another intent", "thinking"),
    ]
    return F.array_compact(F.array(*issues))


def with_issues(df: DataFrame, *, belief="belief", thinking="thinking", decision="policy_decision", language="language", name="name", mention="mention") -> DataFrame:
    c = F.col
    return df.withColumn("issues", text_issues(c(belief), c(thinking), c(decision), c(language), c(name), c(mention)))


def issue_messages(issues: Column) -> Column:
    return F.array_join(F.transform(issues, lambda i: i["message"]), "; ")


def needs_name(issues: Column) -> Column:
    """Whether feedback must repeat the counterparty's name."""
    return F.exists(issues, lambda i: i["code"].isin("missing_counterparty_name", "counterparty_pronoun", "counterparty_direct_address", "counterparty_generic_placeholder"))


def judge_issue_code(text: Column) -> Column:
    """The kind of a judge's remark, by its words."""
    low = F.lower(text)
    invented = low.rlike("invented|made up|fabricated|scene detail|exact task|exact details")
    aligned = low.rlike("intent|aligned|alignment|branch|meaning|taking this on now")
    return F.when(invented, "semantic_invented_details").when(aligned, "semantic_alignment").otherwise("semantic_other")


def judge_issues(remarks: Column, repairs: Column) -> Column:
    """Remarks and repairs paired by place; a repair without a remark is its own remark."""
    zipped = F.arrays_zip(remarks.alias("remark"), repairs.alias("repair"))
    return F.transform(F.filter(zipped, lambda z: z["repair"].isNotNull() | z["remark"].isNotNull()), lambda z: F.struct(
        judge_issue_code(F.coalesce(z["remark"], z["repair"])).alias("code"), F.lit("judge").alias("origin"), F.coalesce(z["remark"], z["repair"]).alias("message"), F.coalesce(z["repair"], z["remark"]).alias("repair"),
    ))


def decision_check(decision: Column) -> Column:
    return F.when(decision.isin(*DECISIONS), decision).otherwise(F.raise_error(F.concat(F.lit("unknown decision "), F.coalesce(decision, F.lit("null")))))
