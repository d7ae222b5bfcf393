import brute
import pytest
from pyspark.sql import functions as F

from millrace.llm import lines, pii, winnowing

SMALL = "/root/testdata/sf0.001"
COMMON = "This line is long enough to be a licence line of many documents"
TEXTS = [
    None, "", "\n", " \t\n", "short", COMMON, COMMON.upper() + "\nown", "a\n" + COMMON + "  \nb", COMMON + "\n" + COMMON, COMMON, "x\r\n" + COMMON,
    "a@b.com@c.org a@b.c%d@e.f x@y 1.2.3.4.5.6.7.8 999.1.1.1.1 +1 (668) 555-1911 4867410821218232 4867 4108 2121 8232 4867-4108-2121-8233 é 😀 q@é.com",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 1 2 +1 +22 +1 (2) 00000000 1..2.3.4 01.002.0003.255 256.1.1.1 iban GB82 WEST 1234 5698 7654 32",
    "1" * 30000 + "-" + "1-" * 20000 + " " + "a" * 3000 + "@" + "b" * 50 + ".c" * 3000, "word " * 60000, "É" * 50 + "\n" + "é" * 50,
]


def frame(spark, texts=TEXTS):
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_pii_equals_brute_force(spark):
    rows, df = frame(spark)
    found = pii.with_spans(df)
    base = F.concat("email", "ip", "card", "phone")
    got = found.select("row.doc_id", *[F.size(k) for k in pii.KINDS[:4]], F.sha2(pii._listed(base), 256)).collect()
    assert {tuple(r) for r in got} == brute.op10(rows)
    assert [r[0] for r in found.where(F.size("iban") > 0).select("row.doc_id").collect()] == [12]

def test_account_numbers_end_where_their_country_says(spark):
    ends = {
        "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX": [(5, 32)], "DE89370400440532013000 AND": [(0, 22)], "BE71 DE89 3704 0044 0532 0130 00": [(5, 32)],
        "GB82WEST12345698765432 DE89370400440532013000": [(0, 22), (23, 45)], "NO93 8601 1117 947 SWIFT DNBANOKK": [(0, 18)], "DE89370400440532013001 AND": [], "DE8937040044053201300 0BIC": [],
        "ZZ18 1234 5678 9012 34 AND MORE UPPER CASE WORDS": [(0, 22)], "xDE89370400440532013000": [], "é😀 DE89370400440532013000é": [(3, 25)], "AB12 GB82 WEST 1234 5698 7654 32 OR": [(5, 32)],
    }
    df = spark.createDataFrame(list(enumerate(ends)), "doc_id long, text string")
    got = {r.row.doc_id: [(s.start, s.end) for s in r.iban] for r in pii.with_spans(df).collect()}
    assert [got[i] for i in range(len(ends))] == list(ends.values())


SECRET = "0a1b2c3d4e5f60718293a4b5c6d7e8f9"
SECRETS = {
    f'token = "{SECRET}"': [(9, 41)],  # the word before decides
    f"commit {SECRET}": [],
    f"api_key: {SECRET}, {SECRET}": [(9, 41)],  # the word is too far from the second one
    f"password {'a' * 30}": [],  # no digits
    f"token {'1' * 30}": [],  # no letters
    f"secret {SECRET[:19]}": [],  # too short
}


def test_added_spans_stay_only_with_the_score_that_nearby_words_give(spark):
    df = spark.createDataFrame(list(enumerate([*SECRETS, None, "", "YY89 3704 0044 0532 0130 00"])), "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = {r.row.doc_id: r for r in pii.with_spans(df, carry=("doc_id", "score")).collect()}
    assert [[(s.start, s.end) for s in got[i].secret] for i in range(len(SECRETS))] == list(SECRETS.values())
    assert all(s.score >= pii.ACCEPT for r in got.values() for k in pii.ADDED for s in r[k]) and {r.row.score for r in got.values()} == {"clash"}
    assert pii.with_spans(df.limit(0)).count() == 0
    near, far = pii.with_spans(spark.createDataFrame([(0, "mail a@b.c"), (1, "see a@b.c")], "doc_id long, text string")).orderBy("row.doc_id").collect()
    assert near.email[0].score > far.email[0].score


def test_many_matches_of_a_long_text_are_placed(spark):
    text = "x 10.0.0.1, a.b@c.de " * 3000
    (r,) = pii.with_spans(spark.createDataFrame([(0, text)], "doc_id long, text string")).collect()
    assert [s.start for s in r.ip] == [21 * i + 2 for i in range(3000)] and [(s.start, s.end) for s in r.email] == [(21 * i + 12, 21 * i + 20) for i in range(3000)]


def _read(spark, table, *names):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(*names).collect()]


def test_queries_equal_brute_force_on_a_whole_table(spark):
    docs, items = _read(spark, "documents", "doc_id", "text"), _read(spark, "benchmark", "item_id", "text")
    assert {tuple(r) for r in winnowing.query(spark, SMALL).collect()} == brute.op5(docs, items)
    assert {tuple(r) for r in lines.query(spark, SMALL).collect()} == brute.op7(docs)
    assert {tuple(r)[:6] for r in pii.query(spark, SMALL).drop("spans").collect()} == brute.op10(docs)


def test_lines_of_edge_cases(spark):
    rows, df = frame(spark)
    kept = lines.apply_bitmaps(df, lines.line_bitmaps(df))
    got = kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("row.text", F.lit("")), 256)).collect()
    assert {tuple(r) for r in got} == brute.op7(rows)


def test_lines_with_null_ids_repeated_rows_clashing_names_and_no_rows(spark):
    df = spark.createDataFrame([(i // 2, COMMON, "x") for i in range(12)] + [(None, COMMON, "x")], "doc_id long, text string, n_lines string")
    kept = lines.apply_bitmaps(df, lines.line_bitmaps(df)).select("row.*").collect()
    assert sorted((r.doc_id if r.doc_id is not None else 99) for r in kept if r.text == COMMON) == [5, 5, 99] and len(kept) == 13
    assert {r.n_lines for r in kept} == {"x"}
    assert lines.apply_bitmaps(df.limit(0), lines.line_bitmaps(df.limit(0))).count() == 0


ITEMS = ["one two three four five six seven eight nine ten eleven", "tiny item", None, "", "ONE two three four five six seven eight nine ten", "solo"]


@pytest.mark.parametrize("block", [winnowing.BLOCK_WINDOWS, 2])
def test_decontaminate_edge_cases(spark, monkeypatch, block):
    texts = [None, "", "x one two three four five six seven eight nine ten y", "a tiny-item solo", "ONE, two three four five six seven eight nine TEN eleven twelve", "one two three four five six seven eight nine", "é solo " * 3000]
    rows, df = frame(spark, texts)
    items = [(i, t) for i, t in enumerate(ITEMS)]
    seen = []
    make = winnowing._Block.__init__
    monkeypatch.setattr(winnowing._Block, "__init__", lambda self, rows, most: (seen.append(rows.num_rows), make(self, rows, most))[1])
    found = winnowing.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), block_windows=block)
    assert max(seen) <= 3 * block and (len(seen) > 1) == (block < 100)
    got = {(r.row.doc_id, r.n_words, r.n_hit, len(r["items"]), brute.sha(",".join(r["items"])), r.n_hit > 0) for r in found.collect()}
    assert got == brute.op5(rows, items)
    assert winnowing.decontaminate(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert winnowing.decontaminate(df, spark.createDataFrame([], "item_id long, text string")).where("n_hit > 0").count() == 0
