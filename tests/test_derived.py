"""Derived rows over odd texts equal their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.operators import derived
from millrace.plans import more_queries  # noqa: F401  registers its queries
from millrace.plans.queries import ORACLES, QUERIES


def differing(spark, folder, name, table, schema, rows):
    """Rows of the query and of its SQL that the other has not, over one table."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    want = con.sql(ORACLES[name])
    got = {tuple(r) for r in QUERIES[name](spark, str(folder)).select(*want.columns).collect()}
    return got ^ set(want.fetchall())


@pytest.mark.parametrize("blank", ["\u3000", "\u00a0", "\u2003", "\u202f", "\x0b", "\r", "\u0085", "\u200b"])
def test_facts_end_at_the_blanks_of_sql(spark, tmp_path, blank):
    texts = [f"{blank}One answer{blank}", f"One.{blank}Two.{blank}{blank}Three", f"One. {blank} Two.", blank, f"One。{blank}\nTwo", None]
    assert not differing(spark, tmp_path, "recall_facts", "documents", "doc_id long, text string", list(enumerate(texts)))


def conversation(spark, folder, texts):
    return differing(spark, folder, "answer_leaks", "conversations", "conv_id long, turn long, role string, text string", [(1, i, "user", t) for i, t in enumerate(texts)])


def test_leaks_have_the_words_of_sql(spark, tmp_path):
    texts = ["a b\rc d e", "a b c d e", "İ ΑΣ x", "i ασ x", "ΑΣΑ ας\x0bk", "ασα ας K", "", " 　 ", None, "one", "ONE", "one two", "one\ttwo\fthree  four", "x One two three four"]
    assert not conversation(spark, tmp_path, texts)


def test_overlap_is_rounded_as_in_sql(spark, tmp_path):
    words = [f"w{i}" for i in range(5122)]  # 5120 runs, 41 of which the reply has: 0.0080078125
    assert not conversation(spark, tmp_path, [" ".join(words), " ".join(words[:43])])


def test_each_text_is_split_once(spark):
    rows = spark.range(1).selectExpr("concat('a b c ', id) AS a", "concat('b c ', id) AS b")
    plan = derived.answer_leaks(rows, "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 2


def test_overlap_of_long_texts(spark):
    many = F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: F.concat(F.lit("w"), i))
    rows = spark.range(1).select(F.array_join(many, " ").alias("a"), F.array_join(F.slice(many, 1, 50_001), " ").alias("b"))
    got = derived.answer_leaks(rows, "a", "b").first()
    assert got.overlap == 49_999 / 99_998 and got.leaks
