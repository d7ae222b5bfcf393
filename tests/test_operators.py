"""Golden values, properties and edge cases of the operators."""

import hashlib
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import keys, text
from millrace.operators import compose, ledger, policy, provider, qa, reports, responses, sampling, text_rules
from millrace.operators.ordinals import with_ordinals
from millrace.plans import dims
from millrace.plans.lifecycle import Run, differences, final_status, resolve_run_id, run_root
from millrace.sources import readers, writers
from millrace.sources.scratch import stored
from millrace.streaming import failures


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(1).alias("_"))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("n, w, want", [
    (100, 1, [15, 15, 14, 14, 14, 14, 14]), (100, 3, [34, 11, 11, 11, 11, 11, 11]), (100, 9, [63, 6, 6, 6, 6, 6, 7]), (1000, 9, [639, 60, 60, 60, 60, 60, 61]),
    (5000, 9, [3213, 297, 298, 298, 298, 298, 298]), (10, 9, [9, 1, 1, 1, 1, 1, 1]),
])
def test_decision_quotas(n, w, want):
    assert list(sampling.decision_quotas(n, {"engage_now": float(w)}).values()) == want


@given(st.integers(15, 10**6))
@settings(max_examples=50, deadline=None)
def test_label_quotas_are_even_and_exact(n):
    q = list(sampling.label_quotas(n).values())
    assert sum(q) == n and max(q) - min(q) <= 1


def test_phase_quotas():
    assert sampling.phase_quotas(40, {"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}) == {"a": 16, "b": 12, "c": 8, "d": 4}
    assert sampling.phase_quotas(10, {"a": 1, "b": 1, "c": 1}) == {"a": 4, "b": 3, "c": 3} and sampling.phase_quotas(0, {"a": 1}) == {"a": 0}


def test_golden_keys(spark):
    rec = F.col("r")
    row = spark.createDataFrame([("policy_rec__000001",)], "r string").select(
        keys.stable_slot(rec).alias("slot"), keys.canonical_name(keys.stable_slot(rec), dims.SURNAMES, dims.GIVEN_PREFIXES, dims.GIVEN_SUFFIXES).alias("name"),
        keys.sample_id("qa-1", "qa_export_sft_v1", "qa_corpus:qa-1:qa_export_sft_v1:math:a__b__q0001", "pt-1", keys.policy_text_id(rec), "zh").alias("sample"), keys.person_id(rec).alias("person"),
    )
    row = row.select("*", keys.sample_person_id(F.col("sample"), F.col("person")).alias("own"), keys.rendered_person_id(F.col("sample"), F.col("person")).alias("rendered"),
                     keys.pool_pick(F.col("sample"), "reply_tool_name", dims.REPLY_TOOLS).alias("tool"), keys.pool_pick(F.col("sample"), "belief_runtime_affordance:zh", list(dims.PRELUDES["zh"])).alias("variant")).first()
    assert (row.slot, row.name, row["sample"]) == (3313, "叶怀和", "acml__379c8213420a64130936")
    assert row.own == "person__sample__acml__379c8213420a64130936__0baec9ea7135__primary"
    assert (row.rendered, row.tool, row.variant) == ("AMDIm4x68yc", "send_message", "action_proto_v1")
    assert one(spark, keys.uniform(42, 7, 0, "energy")) == 0.25389944575726986


@pytest.mark.parametrize("raw, want", [("  Linear Algebra - I ", "linear_algebra_i"), ("线性 代数!", "线性_代数"), ("***", "untitled"), ("a__-__b", "a_____b"), ("　x ", "x")])
def test_slugify(spark, raw, want):
    assert one(spark, text.slugify(F.lit(raw))) == want


@pytest.mark.parametrize("raw, want", [
    ('{"a": 1}', {"a": 1}), ('```json\n{"a": {"b": "}"}}\n```', {"a": {"b": "}"}}), ('so: {"q": "\\"{", "n": [1]} and {"z": 1}', {"q": '"{', "n": [1]}), ("[1, 2]", None), ("no { here", None), ("", None),
])
def test_parsed_object(spark, raw, want):
    got = one(spark, F.to_json(text.parsed_object(F.lit(raw))))
    assert (json.loads(got) if got is not None else None) == want


@pytest.mark.parametrize("raw, phrase, lang, want", [
    ("我不想现在处理", "现在处理", "zh", False), ("我不知道, 真的一二三四五六七八现在处理", "现在处理", "zh", True), ("I will not handle this now", "handle this now", "en", False),
    ("do this now", "do this now", "en", True), ("I can't do this now, but then I do this now", "do this now", "en", True), ("", "x", "en", False),
])
def test_negation(spark, raw, phrase, lang, want):
    assert one(spark, text.affirmative(F.lit(raw), phrase, lang)) is want


def test_encoding_preview_summary(spark):
    assert one(spark, text.percent_encode(F.lit("a b:c/d+é"))) == "a%20b%3Ac%2Fd%2B%C3%A9"
    assert one(spark, text.percent_decode(text.percent_encode(F.lit("a b:c/d+é")))) == "a b:c/d+é"
    assert one(spark, text.preview(F.lit(" a \n b "), 10)) == "a b" and one(spark, text.preview(F.lit("x" * 20), 10)) == "xxxxxxx..."
    assert one(spark, text.error_summary(F.array(*map(F.lit, "abcde")))) == "a; b; c (+2 more)"
    assert one(spark, keys.id_component(F.lit("-é-"))) == hashlib.sha256("-é-".encode()).hexdigest()[:12]


TEXTS = [
    ("I know N and my day is full.", "About N: take this on now.", "engage_now", "en", []),
    ("", "", "defer", "en", ["belief_empty", "thinking_empty", "intent_missing_cue"]),
    ("I know N.", "N can wait until tomorrow; not take this on now.", "defer", "en", []),
    ("I know N.", "N: later, and take this on now.", "defer", "en", ["intent_immediate_help_mismatch", "intent_conflicting_cue"]),
    ("My day. " + "x" * 220, "N noted", "minimal_acknowledgment", "en", ["missing_counterparty_name", "belief_too_long"]),
    ("N is my role_obligation.", "the other person: N noted. " + "y" * 120, "minimal_acknowledgment", "en", ["thinking_too_long", "schema_jargon", "counterparty_generic_placeholder"]),
    ("N is busy", "N noted, thank you", "minimal_acknowledgment", "en", ["belief_not_first_person", "counterparty_direct_address", "counterparty_pronoun"]),
    ("I will see N.", "N noted", "minimal_acknowledgment", "en", ["belief_decision_leak"]),
    ("我认识N，其他吉他。", "N收到", "minimal_acknowledgment", "zh", []),
    ("我认识N，他说data。", "N收到", "minimal_acknowledgment", "zh", ["counterparty_pronoun"]),
    ("我认识N，TA在。", "N收到，对方您", "minimal_acknowledgment", "zh", ["counterparty_direct_address", "counterparty_pronoun", "counterparty_generic_placeholder"]),
    ("我决定N", "N边界", "set_boundary", "zh", ["belief_decision_leak"]),
    ("我认识N", "N边界", "decline", "zh", ["intent_missing_cue"]),
    ("我认识N", "N拒绝，稍后", "decline", "zh", ["intent_conflicting_cue"]),
]


def test_text_rules(spark):
    rows = [(i, *r[:4], "N", "N[friend]") for i, r in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "i int, belief string, thinking string, policy_decision string, language string, name string, mention string")
    got = {r.i: [x.code for x in r.issues] for r in text_rules.with_issues(df).collect()}
    assert got == {i: r[4] for i, r in enumerate(TEXTS)}


def test_policy_records_are_exact_and_deterministic(spark):
    rows = stored(policy.policy_records(spark, 200, 7, {"engage_now": 9.0}))
    count = lambda c: {r[c]: r["count"] for r in rows.groupBy(c).count().collect()}
    assert count("decision") == sampling.decision_quotas(200, {"engage_now": 9.0}) and count("label") == sampling.label_quotas(200)
    assert rows.where("implausible or soft_issues > 2").count() == 0
    again = policy.policy_records(spark, 200, 7, {"engage_now": 9.0})
    assert rows.select("record_id", "energy", "strategy").exceptAll(again.select("record_id", "energy", "strategy")).count() == 0
    docs = policy.as_documents(rows)
    assert policy.record_issues(docs).where("size(issues) > 0").count() == 0
    for field, bad in (("counterparty.entity_id", "x"), ("policy.decision", "x"), ("relation.relation_label", "x")):
        outer, inner = field.split(".")
        broken = docs.withColumn(outer, F.col(outer).withField(inner, F.lit(bad)))
        assert field in policy.record_issues(broken).first().issues


def test_signal_tags(spark):
    arr = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    assert one(spark, policy.signal_tags(arr("cost_acceptable", "energy_low", "x", "can_do_now"))) == ["energy_low", "can_do_now"]
    assert one(spark, policy.signal_tags(arr("cost_acceptable", "a", "risk_acceptable"))) == ["a"] and one(spark, policy.signal_tags(arr())) == []


def test_ordinals_of_many_equal_partitions(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("k"))
    got = with_ordinals(df, ["k"], parts=7).orderBy("k").collect()
    assert [r.ordinal for r in got] == list(range(1, 5001))
    assert with_ordinals(df.limit(0), ["k"]).count() == 0


def pairs(spark, n_texts=2):
    payload = [("qa", f"p{i}", f"q{i}", f"Why <{i}> & \"x\"?\n", f" answer\t{i} ", "d", "n", "apply", "") for i in range(5)]
    payloads = spark.createDataFrame(payload, "payload_type string, payload_id string, derived_from_question_id string, request_text string, fulfillment_content string, domain_slug string, node_path string, bloom_level string, source_path string")
    texts = [(f"t{i}", f"policy_rec__00000{i + 1}", k, d, f" b{i} ", f"t{i}") for i, (k, d) in enumerate([("stranger", "engage_now"), ("friend", "defer")])][:n_texts]
    right = spark.createDataFrame(texts, "record_id string, source_policy_record_id string, relation_kind string, policy_decision string, belief string, thinking string")
    return compose.modulo_pairs(payloads, right, ["payload_id"], ["record_id"]).select("index", F.col("left").alias("payload"), F.col("right").alias("text"), F.lit("en").alias("language"))


IDS = {"qa_run": "r", "qa_view": "v", "text_run": "t"}


def test_modulo_pairs_cycle(spark):
    assert [(r["index"], r.payload.payload_id, r.text.record_id) for r in pairs(spark).orderBy("index").collect()] == [(1, "p0", "t0"), (2, "p1", "t1"), (3, "p2", "t0"), (4, "p3", "t1"), (5, "p4", "t0")]
    assert pairs(spark, 0).count() == 0


def test_documents_round_trip_and_mutations_are_found(spark):
    rows = stored(compose.document(compose.composed(pairs(spark), **IDS)))
    assert compose.round_trip_issues(rows).where("size(issues) > 0").count() == 0
    assert compose.composition_issues(rows, **IDS).where("size(issues) > 0").count() == 0
    asks = {r.text.relation_kind: r.observation_wrapper for r in rows.collect()}
    assert asks["stranger"].endswith(" asks me: ") and asks["friend"].endswith(" says to me: ")
    assert {r.reply_action_text for r in rows.where("not will_help_now").collect()} == {""}
    broken = rows.withColumn("reply_tool_name", F.lit("x"))
    assert {tuple(r.issues) for r in compose.composition_issues(broken, **IDS).collect()} == {("reply_tool_name",)}
    lost = compose.round_trip_issues(rows.withColumn("markup", F.replace("markup", F.lit("answer"), F.lit("other"))))
    good, failed = compose.valid_and_failed(lost)
    assert failed.count() == 3 and good.count() == 2


def test_realize_retries_and_client_errors(spark):
    inputs = spark.createDataFrame([(f"r{i}", d, lang, "N", "N[x]") for i, (d, lang) in enumerate([(d, k) for d in dims.DECISIONS for k in ("zh", "en")])], "record_id string, policy_decision string, language string, name string, mention string")
    good, tries = provider.realize(inputs, provider.template, stored)
    assert good.count() == 14 and tries.count() == 14

    def second_time(rows):
        out = provider.template(rows)
        return out.withColumn("thinking", F.when(F.size("feedback") > 0, F.col("thinking")).otherwise(F.lit("")))

    good, tries = provider.realize(inputs, second_time, stored)
    assert good.count() == 14 and tries.where("ok").count() == 14 and tries.count() == 28
    good, tries = provider.realize(inputs, lambda rows: rows.withColumns({"belief": F.lit(""), "thinking": F.lit("")}), stored, attempts=2)
    assert good.count() == 0 and tries.count() == 28

    class Busy(Exception):
        status = 429

    calls, pauses = [], []

    def client(row):
        calls.append(row)
        if len(calls) < 3:
            raise Busy("wait")
        return "b", "t"

    assert provider.called(client, {}, 5, (2.0, 60.0), pauses.append) == ("b", "t", None) and len(pauses) == 2
    assert provider.called(lambda row: 1 / 0, {}, 1, (2.0, 60.0))[2].startswith("ZeroDivisionError")
    told = provider.ClientProvider(lambda: lambda row: (row["record_id"], "t"))(inputs.limit(2)).collect()
    assert {r.belief for r in told} == {r.record_id for r in told}


def test_ledger(spark):
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k long, v string")
    done = spark.createDataFrame([(2, "z")], "k long, v string")
    assert ledger.pending(new, done, ["k"]).count() == 3 and ledger.missing_rows(new, done, "k").count() == 2
    log = spark.createDataFrame([("x", i) for i in range(5)], "item string, at int")
    got = [(r.attempt, r.action) for r in ledger.attempts(log, ["item"], ["at"]).orderBy("at").collect()]
    assert got == [(1, "retry"), (2, "retry"), (3, "dead_letter"), (1, "retry"), (2, "retry")]
    assert {r.action for r in ledger.attempts(log, ["item"], ["at"], 0).collect()} == {"dead_letter"}
    assert ledger.latest(log, ["item"], F.col("at")).first()["at"] == 4
    tries = spark.createDataFrame([("x", 1, ["a"]), ("x", 2, []), ("x", 3, ["b"])], "item string, attempt int, issues array<string>")
    assert [r.feedback for r in ledger.with_feedback(tries, ["item"], "attempt", "issues").orderBy("attempt").collect()] == [None, ["a"], ["a"]]
    with pytest.raises(ValueError, match=r"bad: .*\(\+2 more\)"):
        ledger.require_none(log, "bad", ["at"])


def test_tree_and_questions(spark):
    nodes = spark.createDataFrame([("0", None, "", 1), ("1", "0", "a", 1), ("2", "0", "a0", 2), ("3", "1", "b", 1), ("4", "0", "a", 3), ("9", "8", "lost", 1)], "id string, parent string, slug string, ord int")
    tree = qa.tree_paths(nodes, 3)
    assert [("/".join(r.path), r.id) for r in qa.ordered_leaves(tree).orderBy("ordinal").collect()] == [("a", "4"), ("a/b", "3"), ("a0", "2")]
    assert qa.find_path(tree, ["a"]).first().id == "1" and qa.tree_paths(nodes.where("id = '0'")).first().is_leaf
    assert qa.leaf_frontier(tree, 2).count() == 2
    raw = spark.createDataFrame([("", " x ", 1), ("", "x", 2), ("", " ", 3), ("", "y", 4), ("a/b", "x", 5)], "node_path string, text string, pos int")
    assert {r.id: r.text for r in qa.kept_questions(raw).collect()} == {"root__q0001": "x", "root__q0002": "y", "a__b__q0001": "x"}
    domains = spark.createDataFrame([("Linear Algebra", "la", 1), ("B", "b", 2)], "name string, slug string, ord int")
    assert [qa.resolve_domain(domains, k).first().slug for k in ("la", "Linear Algebra", "linear_algebra")] == ["la"] * 3


def test_merge_keeps_the_first(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", "")], "pos int, u string, v string")
    rows = qa.merged([a, a], ["u", "v"])
    assert sorted((r.src_ord, r.pos) for r in rows.where("kept").collect()) == [(0, 1), (0, 3)]
    assert {(r.src_ord, r.records, r.kept) for r in qa.merge_counts(rows).collect()} == {(0, 3, 2), (1, 3, 0)}


EXPORT = "id string, question string, domain string, domain_slug string"


def test_views_and_manifests(spark, tmp_path):
    path = str(tmp_path / "view")
    rows = spark.createDataFrame([("1", "q1", "A", "a"), ("2", "q2", "B", "b"), ("3", "q3", "B", "b")], EXPORT)
    manifest = writers.write_view(rows, path, "r", "en")
    assert manifest["total_records"] == 3 and [d["slug"] for d in manifest["domains"]] == ["a", "b"]
    assert readers.view(spark, path, EXPORT).count() == 3 and readers.view(spark, path, EXPORT, "b").count() == 2
    assert "PartitionFilters" in readers.view(spark, path, EXPORT, "b")._jdf.queryExecution().toString()
    writers.write_view(rows.where("id = '2'"), path, "r", "en", refresh=["b"])
    assert sorted(r.id for r in readers.view(spark, path, EXPORT).collect()) == ["1", "2"]
    writers.write_json(spark, f"{path}/manifest.json", manifest | {"format_version": 7})
    with pytest.raises(ValueError, match="format_version"):
        readers.view(spark, path, EXPORT)
    writers.write_json(spark, f"{path}/manifest.json", manifest | {"domains": [*manifest["domains"], {"slug": "c", "records": 1}]})
    with pytest.raises(ValueError, match="listed but not there: c"):
        readers.view(spark, path, EXPORT)
    with pytest.raises(FileNotFoundError):
        readers.view(spark, str(tmp_path), EXPORT)


def test_json_lines_items_and_ledgers(spark, tmp_path):
    bad = tmp_path / "x.jsonl"
    bad.write_text('{"a": 1}\n\n{oops\n{"a": 2}\n')
    assert sorted(r.a for r in readers.json_lines(spark, str(bad), "a int", strict=False).collect()) == [1, 2]
    assert [r.line for r in readers.rejected_lines(spark, str(bad), "a int").collect()] == ["{oops"]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_lines(spark, str(bad), "a int").collect()
    folder = tmp_path / "items"
    folder.mkdir()
    (folder / "p%3Aq%20r.json").write_text('{"a":\n 5}')
    assert [(r.item_key, r.a) for r in readers.items(spark, str(folder), "a int").collect()] == [("p:q r", 5)]
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    path = str(tmp_path / "ledger")
    assert writers.append_missing(rows.limit(1), path, "k").count() == 1
    assert writers.append_missing(rows, path, "k").count() == 2 and writers.append_missing(rows, path, "k").count() == 2


def test_shards(spark, tmp_path):
    rows = spark.createDataFrame([("a", i, n) for i, n in enumerate([4, 6, 1, 25, 3, 7, 1])], "g string, pos int, n int")
    got = [r.shard_index for r in writers.greedy_shards(rows, "g", "pos", "n", 10).orderBy("pos").collect()]
    assert got == [0, 0, 1, 2, 3, 3, 4]
    folded = rows.groupBy().agg(writers.shard_numbers(F.array_sort(F.collect_list("n")), 10).alias("x")).first().x
    assert folded == [0, 0, 0, 0, 1, 2, 3]
    writers.write_shards(spark.createDataFrame([("a", 0, "é"), ("b", 1, "x")], "bloom_level string, shard_index int, line string"), str(tmp_path / "s"))
    assert spark.read.text(str(tmp_path / "s")).where("bloom_level = 'a'").first().value == "é"
    (tmp_path / "o.bin").write_bytes(b"\x01\0\0\0\x02\0\0\0\xff\xff\xff\xff\x00\x01\0\0abc")
    assert [(r.pos, r.offset, r.length) for r in readers.offsets(spark, str(tmp_path / "o.bin")).orderBy("pos").collect()] == [(0, 1, 2), (1, 2**32 - 1, 256)]
    names = spark.createDataFrame([("a--b--0003",), ("x",), ("x--y",)], "name string")
    assert [(r.bloom_level, r.shard_index) for r in readers.shard_names(names).collect()] == [("a--b", 3)]
    shard = spark.createDataFrame([(i, f"v{i}") for i in range(4)], "pos long, v string")
    asked = spark.createDataFrame(list(enumerate([3, 0, 3, -1])), "req_ord int, pos long")
    assert [r.v for r in readers.records_at(shard, asked).collect()] == ["v3", "v0", "v3", "v3"]
    with pytest.raises(Exception, match="out of bounds"):
        readers.records_at(shard, spark.createDataFrame([(0, 9)], "req_ord int, pos long")).collect()


def test_runs(spark, tmp_path):
    assert run_root("o", "policy_records", "r") == "o/shared/runs/policy_records--r" and run_root("o", "qa_corpus", "r", "zh") == "o/zh/runs/qa_corpus--r"
    for bad in (lambda: run_root("o", "qa_corpus", "r"), lambda: run_root("o", "x", "r"), lambda: resolve_run_id("a", "b"), lambda: resolve_run_id(None, None, True)):
        with pytest.raises(ValueError):
            bad()
    assert resolve_run_id(None, None) == "default" and differences({"a": 1}, {"a": 2, "b": None}) == ["a"] and final_status(0, 0) == "completed"
    run = Run(spark, str(tmp_path), "qa_corpus", "r", "en")
    with run.running({"seed": 1}) as done:
        done({"completed_count": 1, "failed_count": 1})
    assert run.read("run")["status"] == "completed_with_failures" and run.read("manifest")["failed_count"] == 1
    with pytest.raises(FileExistsError), run.running({"seed": 1}):
        pass
    with pytest.raises(ValueError, match="seed"), run.running({"seed": 2}, resume=True):
        pass
    with pytest.raises(KeyError), run.running({"seed": 1}, resume=True):
        raise KeyError("x")
    assert run.read("run")["status"] == "failed"


def test_streams(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a.json").write_text("".join(json.dumps({"item": i, "ts": f"2024-01-01T0{h}:00:00Z", "d": "x"}) + "\n" for i, h in (("a", 1), ("a", 1), ("b", 2), ("a", 3))))
    stream = failures.log_stream(spark, str(log), "item string, ts timestamp, d string")
    q = failures.windowed(stream, "ts", "1 hour", ["item"], "1 day").writeStream.format("memory").queryName("win").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.item, r.n) for r in spark.table("win").collect()) == [("a", 1), ("a", 2), ("b", 1)]


@pytest.fixture
def log(spark, tmp_path):
    """A failure log of two files, read as one micro-batch each."""
    folder = tmp_path / "log"
    folder.mkdir()
    rows = [[("a", 1), ("a", 2), ("b", 2), ("a", 3), ("a", 4)], [("a", 5), ("b", 6), ("a", 7), ("a", 8)]]
    for n, own in enumerate(rows):
        (folder / f"{n}.json").write_text("".join(json.dumps({"item": i, "at": h, "d": "x"}) + "\n" for i, h in own))
        os.utime(folder / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema("item string, at long, d string").option("maxFilesPerTrigger", 1).json(str(folder)), spark.createDataFrame([x for own in rows for x in own], "item string, at long")


def test_retry_states_agree_with_attempts_over_several_batches(spark, log):
    stream, rows = log
    q = failures.retry_states(stream.select("item", "at"), "item", "at").writeStream.format("memory").queryName("retry").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    want = ledger.attempts(rows, ["item"], ["at"]).select("item", "at", "attempt", "action").collect()
    assert sorted(tuple(r) for r in spark.table("retry").collect()) == sorted(tuple(r) for r in want) and sum(r.action == "dead_letter" for r in want) == 2


def test_exports_keep_what_earlier_batches_wrote(spark, log, tmp_path):
    stream, rows = log
    for _ in range(2):  # the second run finds nothing new
        failures.export_finished(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "d", F.col("item") == "a").awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out"))
        assert sorted(r["at"] for r in got.collect()) == [1, 2, 3, 4, 5, 7, 8] and got.select("_batch").distinct().count() == 2


def test_shards_are_appended_with_their_offsets(spark, tmp_path):
    rows = lambda lo, hi: spark.createDataFrame([(f"s{i:03d}", "x" if i % 3 else "y", "é" * (i % 7)) for i in range(lo, hi)], "sample_id string, bloom_level string, line string")
    writers.append_shards(rows(0, 40), str(tmp_path / "s"), 60)
    index = writers.append_shards(rows(40, 60), str(tmp_path / "s"), 60).collect()
    lines = {r.sample_id: r.line for r in rows(0, 60).collect()}
    assert len(index) == 60
    for level in "xy":
        own = sorted((r for r in index if r.bloom_level == level), key=lambda r: r.before)
        assert [r.sample_id for r in own] == sorted(r.sample_id for r in own)
        before = 0
        for r in own:
            assert (r.before, r.shard_index, r.length) == (before, before // 60, len(lines[r.sample_id].encode()) + 1)
            assert r.offset == before - next(x.before for x in own if x.shard_index == r.shard_index)
            before += r.length
    data = spark.read.text(str(tmp_path / "s" / "data"))
    assert sorted((r.bloom_level, r.shard_index, r.value) for r in data.collect()) == sorted((r.bloom_level, r.shard_index, lines[r.sample_id]) for r in index)


def test_dataset_merged_views_and_outputs(spark, tmp_path):
    rows = spark.createDataFrame([("b", "B", 1), ("a", "A", 2), ("b", "B", 3)], "domain_slug string, domain string, pos long")
    assert writers.write_dataset(rows, str(tmp_path / "d"), ["pos"]) == {"total_records": 3, "domains": [{"slug": "a", "records": 1}, {"slug": "b", "records": 2}]}
    assert spark.read.json(str(tmp_path / "d" / "dataset")).count() == 3
    other = spark.createDataFrame([("b", "B", "q1"), ("c", "C", "q2")], "domain_slug string, domain string, question string").withColumn("pos", F.monotonically_increasing_id())
    manifest = writers.write_merged([other, other.where("domain_slug = 'b'")], ["domain_slug", "domain", "question"], str(tmp_path / "m"), "r", "en")
    assert manifest["sources"] == [{"place": 0, "records": 2, "kept": 2}, {"place": 1, "records": 1, "kept": 0}] and manifest["total_records"] == 2
    base = {"views": {"x": {"path": "p"}}}
    assert writers.merged_outputs(base, {"views": {"x": {"n": 1}}, "system": {"y": {"path": "q"}}}, None) == {"views": {"x": {"path": "p", "n": 1}}, "system": {"y": {"path": "q"}}} and base == {"views": {"x": {"path": "p"}}}


def test_checkpoints_and_saved_domains(spark, tmp_path):
    for slug, doc in (("d1", '{"phase": "complete", "knowledge_tree": {"domain": "One"}}'), ("d2", '{"phase": "questions"}'), ("d3", "{broken"), (".hidden", "{}")):
        (tmp_path / slug).mkdir()
        (tmp_path / slug / "checkpoint.json").write_text(doc)
    good, bad = readers.checkpoints(spark, f"{tmp_path}/*/checkpoint.json")
    assert sorted(tuple(r) for r in good.collect()) == [("d1", "One", "complete", True), ("d2", "d2", "questions", False)]
    assert [r.line for r in bad.collect()] == ["{broken"]
    docs = ['[{"name": "A", "slug": "a"}]', '{"domains": [{"name": "B"}]}', "{}", "no"]
    rows = spark.createDataFrame([(d,) for d in docs], "t string").select(readers.meta_domains(F.col("t")).alias("d")).collect()
    assert [[tuple(x) for x in r.d] for r in rows] == [[("A", "a", "")], [("B", "", "")], [], []]


def test_chat_client_asks_and_retries(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.headers["Authorization"], body))
            text = body["messages"][-1]["content"]
            status = 400 if text == "bad" else 503 if len([s for s in seen if s[1] == body]) < 3 else 200
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps({"choices": [{"message": {"content": f'{{"got": "{text}"}}'}}]}).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.conf.set("spark.millrace.chat.url", f"http://127.0.0.1:{server.server_port}/v1/")
    spark.conf.set("spark.millrace.chat.model", "m")
    spark.conf.set("spark.millrace.chat.key", "k")
    client = provider.ChatClient(**provider.settings(spark))
    rows = spark.createDataFrame([("a",), ("bad",)], "q string").withColumn("messages", responses.messages(F.lit("s"), F.col("q")))
    got = responses.response_columns(provider.asked(rows, client, pause=(0.01, 0.02))).select("q", F.try_variant_get("object", "$.got", "string").alias("got"), "reason", "error").collect()
    server.shutdown()
    one, two = sorted(got, key=lambda r: r.q)
    assert (one.got, one.reason, one.error) == ("a", None, None) and two.got is None and two.reason == "no_message" and "400" in two.error
    assert len(seen) == 4 and {s[0] for s in seen} == {"Bearer k"}
    with pytest.raises(ValueError, match="url"):
        spark.conf.unset("spark.millrace.chat.url")
        provider.settings(spark)


def test_reports(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("", 4)], "k string, pos int")
    assert [(r.value, r.n) for r in reports.distribution(df, "k", "pos").orderBy(F.desc("n"), "first").collect()] == [("a", 2), ("b", 1), ("", 1)]
    assert {(r.k, r.records, r.is_total) for r in reports.rollup_counts(df, "k").collect()} == {("a", 2, 0), ("b", 1, 0), ("", 1, 0), (None, 4, 1)}
    assert reports.diversity(df, "k", "k").first()[:3] == (3, 2, True)
