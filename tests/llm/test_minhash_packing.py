import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import minhash, packing

SMALL = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def near_copies():
    """Groups in which some pairs are linked only through others, copies, and texts around the threshold."""
    rng = random.Random(3)
    out = [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (905, "one two three four five"), (906, "w " * 3000)]
    for g in range(12):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.choice([30, 80, 200]))]
        for k in range(12):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 10**6)}"
            base = own if k % 3 == 0 else base
            out += [(g * 20 + k, " ".join(own))] * 1
    return out + [(500, out[8][1].upper()), (501, out[8][1] + "\n")]


@pytest.mark.parametrize("block", [minhash.BLOCK, 3])
def test_near_duplicates_equal_brute_force(spark, block):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'clash' as component_id", "1 as n")
    assert {tuple(r) for r in minhash.near_duplicates(df, block=block).collect()} == brute.op3(rows, 80)


def test_near_duplicates_repeated_and_null_ids_and_no_rows(spark):
    rows = [(5, "a b c d e f g"), (5, "h i j k l m n"), (7, "h i j k l m n"), (3, "A b c d e f g"), (None, "a b c d e f g"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, -1, True), (-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_all_texts_of_a_repeated_id_are_joined(spark):
    a, b, c = ("a b c d e f g", "h i j k l m n", "o p q r s t u")
    rows = [(1, a), (2, b), (3, c), (9, a), (9, b), (9, c), (4, "v w x y z 0 1")]
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (9, 1, False), (4, 4, True)}


def test_texts_of_a_repeated_id_with_equal_sizes_give_no_false_links(spark):
    one, two = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, one), (5, two), (6, one + " c"), (7, " ".join(f"d{i}" for i in range(60))), (8, two.replace("b30", "e"))]
    got = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5), (6, 5), (7, 7), (8, 5)}


def test_minhash_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in minhash.query(spark, SMALL).collect()} == brute.op3(docs)


def check_packing(pieces, docs):
    """An exact round trip: pieces cover each id once, sequences are gapless and short enough; returns the share of padding."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in docs}
    at, sequences = dict.fromkeys(ids, 0), {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == at[p.doc_id] and p.doc_tokens == len(ids[p.doc_id]) and p.length > 0
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())
        at[p.doc_id] += p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert at == {i: len(x) for i, x in ids.items()}
    padding = 0
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048
        padding += 2048 - end if end & (end - 1) else 0
    return padding / sum(map(len, ids.values()))


def test_packing_round_trip(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert check_packing(packing.query(spark, SMALL).collect(), docs) < 0.02


@pytest.mark.parametrize("block", [packing.BLOCK, 3000])
def test_packing_edge_cases(spark, block):
    docs = [(i, t) for i, t in enumerate([None, "", " \n", "x<|endoftext|>Y", "A, B. it's 'S É é\x0b\x0c", "*" * 9000, "word " * 9000, "中文　" * 500, "End. " * 3000])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 as start")
    assert check_packing(packing.pack(df, TOKENIZER, block=block).collect(), docs) < 0.02
    assert packing.pack(df.limit(0), TOKENIZER).count() == 0
    again = packing.pack(spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string"), TOKENIZER).collect()
    assert len(again) == 3 and sum(p.length for p in again) == 6


def test_cuts_of_a_block_are_the_cheapest_chain_of_document_and_sentence_ends():
    rng = np.random.default_rng(4)
    ids = rng.integers(2, 40, 3000).astype(np.uint32)
    ids[800:1100] = 7  # one long sentence
    stops = np.zeros(41, bool)
    stops[[2, 3]] = True
    ends = np.array([400, 405, 1500, 2200, 3000])
    at, cost = packing.cut_points(ids, ends, stops, 256)
    sentence = set((np.flatnonzero(stops[ids]) + 1).tolist()) | set(ends.tolist())
    inside = [x for x in at.tolist() if x not in sentence and x < 2800]  # further on, cuts may leave powers of two
    assert inside and all(min((b for b in sentence if b >= x)) - max((b for b in sentence | {0} if b < x)) > packing.LONG for x in inside if x > 256) and at[-1] == 3000
    best = {0: 0}
    for j, c in zip(at.tolist(), cost.tolist()):
        sizes = {i: j - i for i in best if j - i <= 256}
        ok = lambda n, j=j, c=c: n & (n - 1) == 0 and (c == packing.AT_DOC or j > 3000 - 512)
        best[j] = min(best[i] + (0 if ok(n) else 256 - n) + c for i, n in sizes.items())
    total = last = 0
    for j in packing.best_cuts(at.tolist(), cost.tolist(), 256):
        n, c = j - last, dict(zip(at.tolist(), cost.tolist()))[j]
        total, last = total + (0 if n & (n - 1) == 0 and (c == packing.AT_DOC or j > 3000 - 512) else 256 - n) + c, j
    assert last == 3000 and total == best[3000]


def test_best_cuts_is_the_cheapest_chain():
    rng = random.Random(5)
    for _ in range(60):
        at = sorted(rng.sample(range(1, 120), 30))
        cost = [rng.choice([0, 1, 3]) for _ in at]
        best = {0: 0}
        for j, c in zip(at, cost):
            best[j] = min([best[i] + 16 - (j - i) + c for i in best if j - i <= 16], default=10**9)
        if best[at[-1]] >= 10**9:
            continue
        cuts, total, last = packing.best_cuts(at, cost, 16), 0, 0
        for j in cuts:
            size = j - last
            total += (16 - size if size & (size - 1) else 0) + dict(zip(at, cost))[j]
            last = j
        assert last == at[-1] and total <= best[at[-1]]
