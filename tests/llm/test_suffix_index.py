import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import suffix_index

SMALL = "/root/testdata/sf0.001"


def texts():
    """Passages that repeat at many lengths around 400 bytes, within and across texts, copies, periodic and non-ASCII texts."""
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared = [word(n) for n in (390, 399, 400, 401, 420, 700, 2000, 5000)]
    out = [None, "", "short", "x" * 399, "y" * 400, "y" * 401, "z" * 3000, "ab" * 900, "ab" * 600 + "c", word(350) * 3]
    for _ in range(60):
        own = word(rng.randint(0, 600))
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            own += s[a : a + rng.choice([380, 400, 450, 5000])] + word(rng.randint(0, 200))
        out.append(own)
    return out + [out[20], out[21] + "!", word(9000) + shared[7]]


@pytest.mark.parametrize("segment", [suffix_index.SEGMENT, 700])
def test_removal_equals_brute_force(spark, segment, monkeypatch):
    monkeypatch.setattr(suffix_index, "SEGMENT", segment)
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("kept", F.lit("clash"))
    got = suffix_index.remove_repeats(df).collect()
    found = {(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), brute.sha(bytes(r.kept))) for r in got}
    assert found == brute.op4(rows)


def test_removal_in_one_batch_by_segments():
    """Segments of a batch, and the anchors' promise: equal windows have equal digests of anchor suffixes."""
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 5000, np.uint8)
    data[3000:3600] = data[100:700]
    w = suffix_index.Windows(data, np.array([2500, 5000]), 400, 128)
    seen = {}
    for s, lo, hi, leading, _, digest in w.segments():
        for a, b, x in zip(lo.tolist(), hi.tolist(), leading.tolist()):
            for i, h in zip(range(a, b + 1), digest(np.arange(a, b + 1)).tolist()):
                seen[s + i] = (x, h)
    assert sorted(seen) == [*range(0, 2101), *range(2500, 4601)]
    assert all(seen[3000 + k] == seen[100 + k] for k in range(201)) and seen[2999] != seen[99]
    assert len({h for _, h in seen.values()}) == len(seen) - 201


def test_levels_are_few_and_count():
    rng, levels, n = np.random.default_rng(2), suffix_index.Levels(), {}
    for _ in range(100):
        key = np.unique(rng.integers(0, 5000, 50).astype(np.uint64))
        for k in key.tolist():
            n[k] = min(2, n.get(k, 0) + 1)
        levels.add(key, np.ones(len(key), np.uint32), np.zeros(len(key), np.uint32), np.zeros(len(key), np.uint32))
        assert len(levels.levels) <= 14
    key = np.array(sorted(n), np.uint64)
    assert levels.get(key)[0].tolist() == [n[k] for k in key.tolist()]


def test_no_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "q" * 500), (1, "q" * 500), (1, "r")], "doc_id long, text string")
    assert sorted(len(r.kept) for r in suffix_index.remove_repeats(df).collect()) == [0, 0, 1]
    assert suffix_index.remove_repeats(df.limit(0)).count() == 0


def test_query_equals_brute_force_on_a_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in suffix_index.query(spark, SMALL).collect()} == brute.op4(docs)
