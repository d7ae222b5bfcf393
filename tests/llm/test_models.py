import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import cover_tree, toxicity, url_filter

SMALL = "/root/testdata/sf0.001"


def vectors():
    rng = np.random.default_rng(4)
    out, n = [], 0
    for label in (0, 1, 2):
        for _ in range(25):
            base = rng.normal(size=12)
            for k in range(rng.integers(1, 9)):
                v = base + rng.normal(size=12) * rng.choice([0, 0.02, 0.06, 0.1]) * np.linalg.norm(base) / 3.5
                out.append((n, [float(np.float32(x)) for x in v * (2 if k == 3 else 1)], label))
                n += 1
    hot = out[5][1]
    out += [(n + i, hot, 0) for i in range(40)]
    n += 40
    odd = [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [None] + [1.0] * 11, [float("inf")] * 12, [1.0, 2.0]]
    return out + [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 50, hot, None), (n + 51, [1.0, 2.0], 0)]


@pytest.mark.parametrize("block", [cover_tree.BLOCK, 40])
def test_near_vectors_equal_brute_force(spark, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("clash"))
    assert {tuple(r) for r in cover_tree.near_vectors(df, block=block).collect()} == brute.op8(rows)


def test_near_vectors_repeated_and_null_ids_and_no_rows(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (None, [1.0, 0.0], 0), (3, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1, r.kept) for r in cover_tree.near_vectors(df).collect())
    assert got == [(-1, 0, -1, True), (1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert cover_tree.near_vectors(df.limit(0)).count() == 0


def test_tree_invariants_and_traversal():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 6))
    x[300:] = x[:300] + rng.normal(size=(300, 6)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = cover_tree.build(x)

    def visit(node, reach):
        d = cover_tree._distance(x[node.members], x[[node.center]])[:, 0]
        assert d.max() <= node.radius + 1e-12 and d.max() <= reach + 1e-9
        if node.children:
            assert node.children[0].center == node.center
            assert sorted(np.concatenate([c.members for c in node.children]).tolist()) == sorted(node.members.tolist())
            for c in node.children:
                visit(c, reach / 2)

    visit(tree, 2.0)
    found = np.zeros((600, 600), int)
    for i, j, linked in cover_tree.pairs(x, x, tree, tree, 0.95):
        found[np.ix_(i, j)] += linked
    assert (found == (x @ x.T >= 0.95)).all()


def pages(n=400):
    rng = random.Random(6)
    good, bad = ["garden", "music", "school", "river"], ["casino", "poker", "bets", "pills"]
    out = []
    for i in range(n):
        words = rng.sample(bad if i % 3 == 0 else good, 2)
        tld, path = rng.choice([("org", "/en/9"), ("net", "/en/1"), ("com", rng.choice(["/fr/1", "/de/1", "/en/3"]))])
        name = "".join(words) if i % 2 else "-".join(words)
        path = {("org", 0): "/es/2", ("com", 0): "/de/2"}.get((tld, i % 3), path)
        host = f"WWW.{name}.example.{tld}"
        out.append((i, f"https://{host}{path}?q#f", " ".join(rng.choices(good + bad, k=20)) + "<b>x</b><script>casinopoker</script>"))
    odd = [None, "", "no scheme/x", "://", "http://ORG", "http://xorg/a", "http://a.org", "http://a.org/b?c", "http://a.example.org/es/x#", "HTTP://a.example.org/en/123", "x://y://z.com/fr/", "http://h.com/de/" + "a" * 3000]
    return out + [(n + i, u, None) for i, u in enumerate(odd)]


def plain_url(url):
    at = (url or "").find("://")
    m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :] if at >= 0 else "", re.S)
    host, path = m[1].translate(brute.A_Z), m[2]
    fit = [(r, a) for a, r in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return host, path, max(fit, key=lambda x: len(x[0]), default=(None, None))


def test_url_verdicts_equal_plain_viterbi_and_naive_bayes(spark):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    got = {r.row.page_id: r for r in url_filter.judge_urls(df).collect()}
    lexicon = {}
    for _, _, html in rows:
        for w in re.sub("<[^>]*>", " ", re.sub("<script.*?</script>", " ", html or "")).split():
            if len(w) > 1:
                lexicon[w] = lexicon.get(w, 0) + 1
    total = sum(lexicon.values()) + sum("x" in (h or "") for *_, h in rows) * 0
    lexicon = {w: math.log10(c / total) for w, c in lexicon.items()}
    unknown = min(lexicon.values()) - 1

    def split(name):
        if not name:
            return 0.0, ()
        best = None
        for k in range(max(0, len(name) - 24), len(name)):
            score, words = memo(name[:k])
            w = name[k:]
            score += lexicon.get(w, unknown - len(w))
            if best is None or score > best[0]:
                best = score, words + (w,)
        return best

    cache = {}

    def memo(name):
        if name not in cache:
            cache[name] = split(name)
        return cache[name]

    for i, url, _ in rows:
        host, path, (rule, action) = plain_url(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        if action:
            assert got[i].verdict == action
        if i < 400:
            want = [w if w in lexicon else "?" for n in re.split(r"[^\w]+", host)[:-1] for w in memo(n)[1]]
            assert got[i].host_words == want
    net = [got[i] for i, url, _ in rows[:400] if ".net" in url]
    right = sum((r.verdict == "block") == (r.row.page_id % 3 == 0) for r in net)
    assert right >= 0.9 * len(net)
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_url_query_equals_plain_viterbi_and_naive_bayes_on_every_page(spark):
    import regex

    pages = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    count = Counter()
    for *_, html in pages:
        text = regex.sub(r"<[^>]*>|&[A-Za-z0-9_]+;", " ", regex.sub(r"<(script|style)\b.*?</\1>", " ", html or "", flags=regex.S))
        count.update(w for w in regex.split(r"[^\p{L}]+", text.lower()) if 2 <= len(w) <= 24)
    total = sum(count.values())
    judged = {i: plain_url(u) for i, u, _ in pages}
    names = {n for host, path, _ in judged.values() for n in regex.findall(r"\p{L}{2,}", host) + regex.findall(r"\p{L}{2,}", path.lower())}
    parts = {n[i:j] for n in names for i in range(len(n)) for j in range(i + 2, min(len(n), i + 24) + 1)}
    lexicon = {w: math.log10(c / total) for w, c in count.items() if c >= 2 and w in parts}
    assert len(lexicon) > 20
    unknown = min(lexicon.values()) - 1

    def split(name):
        best = [(0.0, ())]
        for j in range(1, len(name) + 1):
            options = [(best[i][0] + lexicon.get(name[i:j], unknown - (j - i)), -i) for i in range(max(0, j - 24), j)]
            score, i = max(options)
            best.append((score, best[-i][1] + (name[-i:j],)))
        return best[-1][1]

    def tokens(host, path):
        for kind, own in (("h", re.split(r"[^\w]+|_", host)[:-1]), ("p", re.split(r"[^\w]+|_", path.lower()))):
            for part in (x for n in own for x in re.findall(r"\d+|[^\W\d]+", n)):
                yield from [kind + "#"] if part[0].isdigit() else [kind + (w if w in lexicon else "?") for w in split(part)]

    seen, classes = {"allow": Counter(), "block": Counter()}, Counter()
    for host, path, (_, action) in judged.values():
        if action:
            seen[action].update(tokens(host, path))
            classes[action] += 1
    words = set(seen["allow"]) | set(seen["block"])
    size = {k: sum(x.values()) + len(words) + 1 for k, x in seen.items()}
    odds = {w: math.log((seen["block"][w] + 1) / size["block"]) - math.log((seen["allow"][w] + 1) / size["allow"]) for w in words}
    got = {r.page_id: r for r in url_filter.query(spark, SMALL).collect()}
    assert sorted(got) == sorted(judged) and classes["allow"] and classes["block"]
    for i, (host, path, (rule, action)) in judged.items():
        score = math.log((classes["block"] + 1) / (classes["allow"] + 1)) + sum(odds.get(t, 0.0) for t in tokens(host, path))
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule) and abs(got[i].score - score) < 1e-9
        assert got[i].verdict == (action or ("block" if score > 0 else "allow"))


def labelled(n=500):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    out = []
    for i in range(n):
        own = rng.choices(words, k=rng.randint(5, 60))
        if i % 4 == 0:
            for _ in range(3):
                own.insert(rng.randrange(len(own)), rng.choice(["Idiot!", "scum", "moron."]))
        elif rng.random() < 0.1:
            own.append("moron")
        out.append((i, " ".join(own), int(i % 4 == 0)))
    return out


def test_nearest_is_exact_and_scores_separate(spark):
    rows = labelled()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "w1 " * 20000 + "scum")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    got = {r.row.doc_id: r for r in toxicity.toxicity_scores(docs, labels, learn_from="doc_id < 400").collect()}
    held = [(got[i].score, x) for i, _, x in rows if i >= 400]
    assert sum((s >= 0.5) == (x == 1) for s, x in held) >= 0.95 * len(held)
    assert {got[i].score < 0.5 for i in (900, 901, 902)} == {True} and len(got) == 503
    assert all(0 <= r.score <= 1 and bool(r.evidence) == (i not in (900, 901)) for i, r in got.items())
    assert toxicity.toxicity_scores(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(docs, labels.where("toxic = 0")).collect()} == {0.0}


def plain_toxicity(docs, labels, share, k=15):
    """{id: score}, {id: nearest} by dictionaries, for docs {id: text} and the examples' labels {id: 0 or 1}."""
    bag = {i: Counter(re.findall("[0-9a-z\x80-\U0010ffff]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))) for i, t in docs.items()}
    n = Counter(labels.values())
    seen = Counter(w for b in bag.values() for w in b)
    one, none = (Counter(w for i, x in labels.items() if x == want for w in bag[i]) for want in (1, 0))

    def ratio(a, b):
        cells = [(a, a + b, n[1]), (b, a + b, n[0]), (n[1] - a, n[1] + n[0] - a - b, n[1]), (n[0] - b, n[1] + n[0] - a - b, n[0])]
        return 2 * sum(x * math.log(x * (n[1] + n[0]) / (row * column)) for x, row, column in cells if x)

    weight = {w: (math.log((1 + len(docs)) / (1 + seen[w])) + 0.05) * (0.02 + (min(1, ratio(one[w], none[w]) / 10.83) if one[w] + none[w] >= 2 else 0)) for w in one | none}
    vector = {}
    for i, b in bag.items():
        own = {w: x * weight[w] for w, x in b.items() if w in weight}
        size = math.sqrt(sum(x * x for x in own.values()))
        vector[i] = {w: x / size for w, x in own.items()}
    factor = share / (1 - share) * n[0] / n[1]

    def vote(i, leave):
        cosine = [(round(sum(x * vector[j].get(w, 0) for w, x in vector[i].items()), 12), j) for j in labels if j != leave]
        best = sorted((c for c in cosine if c[0] > 0), key=lambda c: -c[0])[:k]
        w = [(1 / (0.02 + max(1 - c, 0)), labels[j]) for c, j in best]
        yes, no = (sum(x / w[0][0] for x, y in w if y == want) for want in (1, 0))
        return math.log((yes * factor + 0.5 * share) / (no + 0.5 * (1 - share)))

    ids = list(labels)
    y = np.array([labels[i] for i in ids])
    line = toxicity._line(np.array([vote(i, i) for i in ids]), y, np.where(y == 1, factor, 1.0))
    return {i: 1 / (1 + math.exp(-(line[0] + line[1] * vote(i, None)))) for i in docs}


def test_block_max_search_equals_all_cosines(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "BLOCK", 32)
    rows = labelled(700)
    bags = toxicity.Bags(pa.table({"doc_id": [i for i, _, _ in rows], "toxic": [x for *_, x in rows], "text": [t for _, t, _ in rows]}))
    index = toxicity.build_index(bags, np.bincount(bags.term, minlength=len(bags.terms)), len(rows), 0.25)
    assert len(index.blocks) == 22 and any(len(b.rows) for b in index.blocks) and all((b.dense < 0).any() for b in index.blocks)
    place = {i: k for k, i in enumerate(index.ids.tolist())}
    full, doc, codes, times = toxicity._bags(pa.array([rows[i][1] for i in index.ids.tolist()]))
    entries = index.vectors(full, doc, codes, times, len(rows))
    dense = np.zeros((len(rows), len(index.terms)))
    dense[entries[0], entries[1]] = entries[2]
    assert len(place) == len(rows) and np.allclose(np.linalg.norm(dense, axis=1), 1)
    cosine, at = index.nearest(*entries, len(rows), 9)
    without, left = index.nearest(*entries, len(rows), 9, np.arange(len(rows)))
    for i in range(0, len(rows), 7):
        every = np.round(dense @ dense[i], 12)
        want = np.lexsort((np.arange(len(rows)), -every))
        assert np.allclose(cosine[i], every[want[:9]]) and np.allclose(every[at[i]], every[want[:9]])
        assert i not in left[i].tolist() and np.allclose(every[left[i]], np.delete(every[want], want.tolist().index(i))[:9])


def test_blocks_are_opened_for_many_texts_at_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(toxicity, "BLOCK", 32)
    rows = labelled(700)
    bags = toxicity.Bags(pa.table({"doc_id": [i for i, _, _ in rows], "toxic": [x for *_, x in rows], "text": [t for _, t, _ in rows]}))
    index = toxicity.build_index(bags, np.bincount(bags.term, minlength=len(bags.terms)), len(rows), 0.25)
    opened, plain = [], index._cosines
    monkeypatch.setattr(index, "_cosines", lambda b, *rest: opened.append(b) or plain(b, *rest))
    index.nearest(*index.vectors(*toxicity._bags(pa.array([t for _, t, _ in rows])), len(rows)), len(rows), 9)
    assert set(opened) == set(range(22)) and len(opened) <= 3 * 22


def test_toxicity_query_equals_dictionaries(spark):
    got = {r.doc_id: r for r in toxicity.query(spark, SMALL).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.toxic in (0, 1) and docs.get(r.doc_id) is not None}
    assert len(got) == len(docs) == 200 and set(labels.values()) == {0, 1}
    want = plain_toxicity(docs, labels, sum(labels.values()) / len(labels))
    assert all(abs(got[i].score - want[i]) < 1e-6 and got[i].predicted == (got[i].score >= 0.5) for i in docs)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in docs)


def test_one_row_of_a_repeated_id_is_an_example(spark):
    rows = labelled(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(0, rows[0][1])] * 5, "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in rows] + [(1, rows[1][2])] * 5, "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, labels, evidence=15).collect()
    assert len(got) == 205 and all(len({e.doc_id for e in r.evidence}) == len(r.evidence) for r in got)
