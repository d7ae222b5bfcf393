import random
import re

import brute
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import common

ODD = st.text(alphabet="aBÉé \t\n\x0b\x0c\r\x1c\x1f\x00\x85\xa0 中😀.,-9Zİ", max_size=40)


@given(st.lists(st.one_of(st.none(), ODD), max_size=8))
@settings(max_examples=300, deadline=None)
def test_words_are_those_of_the_patterns(texts):
    for alnum, pattern in ((False, r"[^\x20\x09-\x0D]+"), (True, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words, counts = common.split_words(pa.array(texts, pa.string()), alnum)
        want = [re.findall(pattern, (t or "").translate(brute.A_Z)) for t in texts]
        assert words.to_pylist() == [w for own in want for w in own] and counts.tolist() == [len(own) for own in want]
        h, again = common.word_hashes(pa.array(["x", *texts], pa.string()).slice(1), alnum)
        assert len(h) == len(words) and again.tolist() == counts.tolist()


def test_components_of_paths_stars_and_random_graphs(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(150)] + [(1000, k) for k in range(1001, 1400)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(140)] + [(5000, 5000)]
    want = brute.reachable({x for link in links for x in link}, links)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k not in loops}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
