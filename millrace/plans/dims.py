"""Lookup data. The values are fixed: results depend on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Decisions in their order, with response intent, and the strategies of each.
DECISIONS = {
    "engage_now": "help_now",
    "engage_briefly": "brief_non_help",
    "defer": "defer",
    "decline": "decline",
    "minimal_acknowledgment": "acknowledge_only",
    "set_boundary": "set_boundary",
    "redirect_channel_or_time": "redirect",
}
STRATEGIES = {
    "engage_now": ["answer_seriously"],
    "engage_briefly": ["answer_briefly"],
    "defer": ["defer_with_time_hint", "defer_with_hint"],
    "decline": ["polite_decline", "set_boundary"],
    "minimal_acknowledgment": ["acknowledge_only"],
    "set_boundary": ["set_boundary"],
    "redirect_channel_or_time": ["redirect_channel_or_time"],
}

# Relation kinds with accepted labels (the last is the one that is sampled), direction, typical closeness.
TARGET, SELF, EQUAL = "target_is_my_relation", "i_am_targets_relation", "equal"
RELATIONS = {
    "mentor": (["导师"], TARGET, "medium"),
    "student": (["学生"], SELF, "medium"),
    "coworker": (["同事"], EQUAL, "medium"),
    "boss": (["上司"], TARGET, "low"),
    "subordinate": (["下属"], SELF, "low"),
    "family": (["家人"], TARGET, "high"),
    "friend": (["朋友", "老朋友"], EQUAL, "high"),
    "stranger": (["陌生人"], TARGET, "low"),
    "client": (["客户"], TARGET, "low"),
    "partner": (["合作伙伴"], EQUAL, "medium"),
    "neighbor": (["邻居"], EQUAL, "low"),
    "classmate": (["同学"], EQUAL, "medium"),
    "teacher": (["老师"], TARGET, "medium"),
    "junior": (["晚辈"], SELF, "medium"),
    "elder": (["长辈"], TARGET, "high"),
    "other": ([], EQUAL, None),
}
#: Kinds whose utterances are questions; the others say something.
ASKING = ("stranger", "partner")
OBSERVED = {"zh": {True: "问我：", False: "对我说："}, "en": {True: " asks me: ", False: " says to me: "}}

# Parts of the names of counterparties.
SURNAMES = ["周", "林", "陈", "许", "沈", "顾", "唐", "陆", "宋", "韩", "叶", "赵", "钱", "孙", "李", "吴", "郑", "王", "冯", "蒋", "程", "薛", "魏", "何", "马", "罗", "高", "梁", "董", "于", "余", "杜"]
GIVEN_PREFIXES = ["安", "知", "清", "景", "初", "闻", "序", "怀", "向", "若", "以", "可", "言", "亦", "书", "映", "思", "临", "照", "承"]
GIVEN_SUFFIXES = ["宁", "和", "远", "白", "舟", "川", "南", "北", "遥", "衡", "微", "乔", "念", "允", "朗", "平"]

# Names of the reply tool, and sentences that introduce it.
REPLY_TOOLS = ("SendMessage", "SendMsg", "send_message", "Speek", "speek")
PRELUDES = {
    "zh": {
        "action_proto_v1": "我当前可调用的外部动作原型：",
        "action_proto_v2": "我现在可用的对外动作原型如下：",
        "action_proto_v3": "当前可用的外部动作原型如下：",
        "action_proto_v4": "我这边目前能使用的对外动作接口有：",
    },
    "en": {
        "action_proto_v1": "Available outward action prototype:",
        "action_proto_v2": "Current outward interaction prototype:",
        "action_proto_v3": "The runtime currently exposes this outward action:",
        "action_proto_v4": "I can currently use the following outward action interface:",
    },
}

# Levels of questions from low to high, and the lower levels each can be turned into.
BLOOM = ("remember", "understand", "apply", "analyze", "evaluate", "create")
LOWER_BLOOM = {"understand": ["remember"], "apply": ["remember"], "analyze": ["remember", "understand"], "evaluate": ["understand", "apply"], "create": ["understand", "analyze"]}

# Reason tags that say most, and those that say nothing.
SIGNAL_TAGS = (
    "time_pressure_high", "energy_low", "energy_high", "can_do_later", "can_do_now", "trust_constrains_engagement", "trust_enables_engagement",
    "closeness_enables_engagement", "tension_inhibits_engagement", "regret_high", "socially_guarded", "socially_ready", "clarity_constrains", "clarity_enables",
)
NEUTRAL_TAGS = ("cost_acceptable", "risk_acceptable")

# Cues that a text helps now, or puts off.
HELP_NOW = {
    "zh": ("现在接下", "马上处理", "立刻处理", "现在处理", "我先接下", "我来处理", "这就处理", "直接接下"),
    "en": ("take this on now", "handle this now", "work on this now", "deal with this now", "pick this up now", "start on this now", "do this now", "step in now"),
}
LATER = {
    "zh": ("晚点", "之后", "回头", "等我", "等晚上", "稍后", "改天", "有空了再"),
    "en": ("later", "after this", "once i'm free", "when i have time", "later today", "tonight", "tomorrow", "get back to it later"),
}
# What a text of each decision must have one of; whether it must not put off (it must never help now, but for engage_now).
CUES = {
    "engage_now": (HELP_NOW, False),
    "engage_briefly": ({"zh": ("先回", "简单回", "先回应", "先答一句", "先说一声"), "en": ("quick reply", "brief reply", "respond briefly", "just reply", "answer briefly")}, False),
    "defer": (LATER, False),
    "decline": ({"zh": ("不帮", "不接", "拒绝", "不方便接", "没法接", "不想接"), "en": ("can't help", "won't take this", "have to decline", "can't take this on", "need to say no")}, True),
    "minimal_acknowledgment": ({"zh": ("收到", "知道了", "先回应", "简单回应", "应一声", "表示收到"), "en": ("got it", "noted", "i saw this", "message received", "acknowledged")}, True),
    "set_boundary": ({"zh": ("边界", "不方便", "我只能", "不适合", "不想再", "先说清"), "en": ("boundary", "not available for this", "i can only", "not a fit for me", "doesn't work for me")}, False),
    "redirect_channel_or_time": ({"zh": ("换个时间", "之后再聊", "发到", "邮件", "群里", "明天再", "回头再"), "en": ("another time", "email channel", "group channel", "move this to email", "tomorrow")}, False),
}

#: Task families and whether their runs are shared or of one language.
SCOPES = {"qa_corpus": "language", "policy_records": "shared", "policy_text_records": "language", "help_gate_acml": "language"}


def decisions(spark: SparkSession) -> DataFrame:
    rows = [(i, d, intent, intent == "help_now", STRATEGIES[d]) for i, (d, intent) in enumerate(DECISIONS.items())]
    return spark.createDataFrame(rows, "ordinal int, decision string, response_intent string, will_help_now boolean, strategies array<string>")


def relations(spark: SparkSession) -> DataFrame:
    """One row for each accepted label; `other` has none."""
    rows = [(label, k, direction, close, label == labels[-1]) for k, (labels, direction, close) in RELATIONS.items() for label in labels]
    return spark.createDataFrame(rows, "label string, relation_kind string, direction string, typical_closeness string, sampled boolean")


def check() -> None:
    """A label has one kind, every kind but `other` is sampled, and every decision has strategies and cues in both languages."""
    labels = [label for names, *_ in RELATIONS.values() for label in names]
    assert len(labels) == len(set(labels)) and all(names for k, (names, *_) in RELATIONS.items() if k != "other")
    assert set(STRATEGIES) == set(CUES) == set(DECISIONS) and all(set(must) == {"zh", "en"} for must, _ in CUES.values())


check()
