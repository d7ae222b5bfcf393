"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, votes weighted by distance.

Examples are a bounded sample of labelled rows; every word of theirs is a term. A term weighs its times in the text, its inverse
document frequency over the whole corpus, and how surely it goes with either label in the sample: words that go with neither keep
a small weight. The index is broadcast: it is bounded by the examples' number and bytes. Its posting lists stand in blocks of
examples, and a block is opened only for texts whose bound there, from each term's largest weight in the block, reaches their
k-th best cosine so far.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, carry_fields, drop, field, hash_words, packed, pieces, rows_of, split_words, trim, unpacked

#: Labelled rows of each label in the index at most, and bytes of each label's texts at most.
SAMPLE, SAMPLE_BYTES = 2048, 32 << 20
#: The log-likelihood ratio from which a term counts in full, and the weight of one that goes with neither label.
SURE, NEITHER = 10.83, 0.02
#: Neighbours that vote; examples of a block of the index; texts that are searched for at once.
NEIGHBOURS, BLOCK, QUERIES = 15, 256, 256
#: The turns, from the block with the largest bound on, from which several turns are taken together.
TURNS = (0, 1, 4)
#: Terms in so large a share of a block's examples have a dense row there.
DENSE = 0.05


def _bags(text: pa.Array):
    """Of several texts: the distinct words' hashes (all texts together), and by text the words' codes and times."""
    words, counts = split_words(text, alnum=True)
    if not len(words):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    coded = words.dictionary_encode()
    codes, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    key, times = np.unique(np.repeat(np.arange(len(counts)), counts) * n + codes, return_counts=True)
    return hash_words(coded.dictionary), key // n, key % n, times


def _ratio(a, b, n1, n0):
    """The log-likelihood ratio of a term in a of n1 and b of n0 texts."""
    n, k = n1 + n0, a + b
    out = np.zeros(len(a))
    for seen, row, column in ((a, k, n1), (b, k, n0), (n1 - a, n - k, n1), (n0 - b, n - k, n0)):
        with np.errstate(divide="ignore", invalid="ignore"):
            out += np.where(seen > 0, seen * np.log(seen * n / (row * column)), 0)
    return 2 * out


@dataclass
class Block:
    """Posting lists of a block: its terms, where each one's postings start, their examples (counted from the block's first) and
    weights, and each term's largest weight; dense: the places of terms with many postings, and their weights by example."""

    terms: np.ndarray
    starts: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    most: np.ndarray
    dense: np.ndarray
    rows: np.ndarray


@dataclass
class Index:
    """terms: sorted hashes of the examples' words; weight of each term; labels and ids of the examples, which stand in blocks;
    the label's share, and the votes' weight and calibration."""

    terms: np.ndarray
    weight: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    blocks: list[Block]
    prior: float
    ratio: float
    line: tuple[float, float] = (0.0, 1.0)
    entries: tuple = ()

    @classmethod
    def of(cls, terms, weight, labels, ids, doc, term, times, prior: float, ratio: float, line=(0.0, 1.0)) -> Index:
        """The index of entries (doc, term, times) of the examples in their order, sorted by (block, term, doc)."""
        own, n = times * weight[term], len(labels)
        own = own / np.sqrt(np.bincount(doc, own * own, n))[doc]
        cuts = np.searchsorted(doc // BLOCK, np.arange(-(-n // BLOCK) + 1))
        blocks = [_block(term[x:y], doc[x:y] - i * BLOCK, own[x:y], min(BLOCK, n - i * BLOCK)) for i, (x, y) in enumerate(zip(cuts[:-1], cuts[1:]))]
        return cls(terms, weight, labels, ids, blocks, prior, ratio, line, (doc, term, times, own))

    def stored(self) -> tuple:
        """What the index is made of again in a worker: far less than its postings."""
        doc, term, times, _ = self.entries
        return packed(self.terms, self.weight, self.labels, self.ids, doc.astype(np.int32), term.astype(np.int32), times.astype(np.int32)), self.prior, self.ratio, self.line

    @classmethod
    def loaded(cls, blob: bytes, prior: float, ratio: float, line: tuple) -> Index:
        terms, weight, labels, ids, doc, term, times = unpacked(blob, np.uint64, float, np.int64, np.int64, np.int32, np.int32, np.int32)
        return cls.of(terms, weight, labels, ids, doc.astype(np.int64), term.astype(np.int64), times.astype(np.int64), prior, ratio, line)

    def nearest(self, doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, k: int, leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each of n unit vectors, given by entries in the order of doc, the k examples of largest cosine, ties by their order:
        cosines, places. leave: for each vector an example that is left out. Missing neighbours have the place -1."""
        best, place = np.full((n, k), -2.0), np.full((n, k), -1)
        found = []
        bound = np.zeros((n, len(self.blocks)))
        own, of = np.unique(term, return_inverse=True)
        for b, block in enumerate(self.blocks):
            at = np.minimum(np.searchsorted(block.terms, own), len(block.terms) - 1)
            at = np.where(block.terms[at] == own, at, -1)[of]
            there = at >= 0
            found.append((doc[there], at[there], weight[there]))
            bound[:, b] = np.bincount(found[b][0], found[b][2] * block.most[found[b][1]], n)
        order = np.argsort(-bound, 1, kind="stable")
        turn = np.empty_like(order)
        np.put_along_axis(turn, order, np.arange(len(self.blocks))[None, :], 1)
        # the blocks of a few turns together, so that one is opened for many texts at once
        for first, last in zip(TURNS, (*TURNS[1:], len(self.blocks))):
            for b, block in enumerate(self.blocks):
                rows = np.flatnonzero((turn[:, b] >= first) & (turn[:, b] < last) & (bound[:, b] >= best[:, k - 1] - 1e-9))
                if not len(rows):
                    continue
                cosine = np.round(self._cosines(b, rows, n, *found[b]), 12)
                at = b * BLOCK + np.arange(cosine.shape[1])
                if leave is not None:
                    cosine[leave[rows][:, None] == at[None, :]] = -2.0
                every, where = np.concatenate([best[rows], cosine], 1), np.concatenate([place[rows], np.broadcast_to(at, cosine.shape)], 1)
                # k of each row and those as good as the last one, of which the first ones stay
                row, column = np.nonzero(every >= np.partition(every, -k, 1)[:, -k][:, None])
                every, where = every[row, column], where[row, column]
                keep = np.lexsort((where, -every, row))
                size = np.bincount(row, minlength=len(rows))
                keep = keep[((np.cumsum(size) - size)[:, None] + np.arange(k)).ravel()].reshape(len(rows), k)
                best[rows], place[rows] = every[keep], where[keep]
        place[best <= 0] = -1  # nothing in common
        return best, place

    def _cosines(self, b: int, rows: np.ndarray, n: int, doc: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Of the chosen rows, each one's cosines with a block's examples."""
        block, width = self.blocks[b], min(BLOCK, len(self.labels) - b * BLOCK)
        if len(rows) < n:
            number = np.full(n, -1)
            number[rows] = np.arange(len(rows))
            own = number[doc]
            doc, at, weight = own[own >= 0], at[own >= 0], weight[own >= 0]
        dense = block.dense[at]
        many = dense >= 0
        query = np.zeros((len(rows), len(block.rows)))
        query[doc[many], dense[many]] = weight[many]
        doc, at, weight = doc[~many], at[~many], weight[~many]
        size = block.starts[at + 1] - block.starts[at]
        post = np.repeat(block.starts[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        rest = np.bincount(np.repeat(doc * width, size) + block.example[post], np.repeat(weight, size) * block.weight[post], len(rows) * width)
        return query @ block.rows + rest.reshape(len(rows), width)

    def vectors(self, full: np.ndarray, doc: np.ndarray, codes: np.ndarray, times: np.ndarray, n: int):
        """Entries (doc, term, weight) of unit vectors of bags whose words have the hashes full; words that are no terms are left out."""
        at = np.minimum(np.searchsorted(self.terms, full), len(self.terms) - 1)
        known = self.terms[at] == full
        keep = known[codes]
        doc, term = doc[keep], at[codes[keep]]
        weight = times[keep] * self.weight[term]
        return doc, term, weight / np.sqrt(np.bincount(doc, weight * weight, n))[doc]

    def vote(self, cosine: np.ndarray, at: np.ndarray) -> float:
        """The log odds of the label: votes by closeness, each label's by its share of all labelled rows, with one vote of the prior."""
        cosine, at = cosine[at >= 0], at[at >= 0]
        w = 1 / (0.02 + np.maximum(1 - cosine, 0))
        w = w / w[0] if len(w) else w
        one = (w * (self.labels[at] == 1)).sum() * self.ratio + 0.5 * self.prior
        none = (w * (self.labels[at] == 0)).sum() + 0.5 * (1 - self.prior)
        return float(np.log(one / none))

    def score(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.line[0] + self.line[1] * vote, -30, 30))))


def _block(term: np.ndarray, example: np.ndarray, weight: np.ndarray, width: int) -> Block:
    """The block of entries in the order of (term, example)."""
    terms, starts = np.unique(term, return_index=True)
    starts = np.append(starts, len(term))
    size = np.diff(starts)
    many = np.flatnonzero(size > DENSE * width)
    dense, rows = np.full(len(terms), -1), np.zeros((len(many), width))
    dense[many] = np.arange(len(many))
    own = dense[np.repeat(np.arange(len(terms)), size)]
    rows[own[own >= 0], example[own >= 0]] = weight[own >= 0]
    return Block(terms, starts, example.astype(np.int32), weight, np.maximum.reduceat(weight, starts[:-1]), dense, rows)


class Bags:
    """The bags of examples: labels and ids, distinct terms, and entries (example, term, times)."""

    def __init__(self, examples: pa.Table):
        self.label, self.ids = (examples.column(c).to_numpy().astype(np.int64) for c in ("toxic", "doc_id"))
        full, self.doc, codes, self.times = _bags(examples.column("text").combine_chunks())
        self.terms, of = np.unique(full, return_inverse=True)
        self.term = of[codes] if len(codes) else codes


def build_index(bags: Bags, seen: np.ndarray, total: int, share: float) -> Index | None:
    """The index of bags; seen: in how many of total documents each term is; share: of label 1 among all labelled rows."""
    label, n = bags.label, len(bags.label)
    n1, n0 = int(label.sum()), int((1 - label).sum())
    if not n1 or not n0 or not len(bags.terms):
        return None
    one = label[bags.doc] == 1
    a, b = (np.bincount(bags.term[x], minlength=len(bags.terms)) for x in (one, ~one))
    sure = np.where(a + b >= 2, np.minimum(_ratio(a, b, n1, n0) / SURE, 1), 0)
    weight = (np.log((1 + total) / (1 + seen)) + 0.05) * (NEITHER + sure)
    own = bags.times * weight[bags.term]
    own = own / np.sqrt(np.bincount(bags.doc, own * own, n))[bags.doc]
    # examples with the same leading term stand together, which keeps other blocks' largest weights low
    first = np.lexsort((-own, bags.doc))
    lead = np.full(n, -1)
    lead[bags.doc[first][::-1]] = bags.term[first][::-1]
    by = np.lexsort((bags.ids, lead))
    rank = np.empty(n, np.int64)
    rank[by] = np.arange(n)
    doc = rank[bags.doc]
    order = np.lexsort((doc, bags.term, doc // BLOCK))
    return Index.of(bags.terms, weight, label[by], bags.ids[by], doc[order], bags.term[order], bags.times[order], share, share / (1 - share) * n0 / n1 if share < 1 else 1.0)


def _left_out(shared):
    """(first, last) of examples to their votes by all the others."""

    def f(batches):
        index = Index.loaded(*shared.value)
        doc, term, _, own = index.entries
        order = np.argsort(doc, kind="stable")
        doc, term, own = doc[order], term[order], own[order]
        for batch in batches:
            for lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                x, y = np.searchsorted(doc, [lo, hi])
                votes = [index.vote(*v) for v in zip(*index.nearest(doc[x:y] - lo, term[x:y], own[x:y], hi - lo, NEIGHBOURS, np.arange(lo, hi)))]
                yield pa.record_batch([pa.array([lo]), pa.array([votes], pa.list_(pa.float64()))], ["first", "votes"])

    return f


def _calibrate(spark, index: Index) -> None:
    """A logistic line through the examples' left-out votes with the labels' shares as weights."""
    n = len(index.labels)
    spans = spark.createDataFrame([(lo, min(lo + QUERIES, n)) for lo in range(0, n, QUERIES)], "first long, last long").repartition(-(-n // QUERIES))
    found = spans.mapInArrow(_left_out(spark.sparkContext.broadcast(index.stored())), "first long, votes array<double>").collect()
    votes = np.concatenate([r.votes for r in sorted(found)])
    index.line = _line(votes, index.labels, np.where(index.labels == 1, index.ratio, 1.0))


def _line(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """The logistic regression of y on x with weights and a slight pull to the line (0, 1)."""
    design, beta = np.stack([np.ones(len(x)), x], 1), np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (w * (y - p)) - 2.0 * (beta - [0.0, 1.0])
        curve = design.T @ (design * (w * p * (1 - p))[:, None]) + 2.0 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.05))


def _frequencies(shared, text: str):
    """One blob for each task: in how many of its texts each term is, and the number of texts."""

    def f(batches):
        terms = shared.value
        seen, total = np.zeros(len(terms), np.int64), 0
        for whole in batches:
            for lo, hi in pieces(whole, field(whole, text)):
                full, _, codes, _ = _bags(field(whole.slice(lo, hi - lo), text))
                at = np.minimum(np.searchsorted(terms, full), len(terms) - 1)
                known = terms[at] == full
                times = np.bincount(codes, minlength=len(full))
                seen[at[known]] += times[known]
                total += hi - lo
            trim()
        yield pa.record_batch([pa.array([packed(seen, np.array([total]))], pa.binary())], ["seen"])

    return f


def _summed(rows: pa.Table) -> pa.Table:
    seen, total = (sum(x) for x in zip(*(unpacked(b, np.int64, np.int64) for b in rows.column("seen").to_pylist())))
    return pa.table({"seen": pa.array([packed(seen, total)], pa.binary())})


def _scored(shared, names: list[str], text: str, share: float, evidence: int):
    def f(batches):
        index = Index.loaded(*shared.value) if shared.value else None
        for whole in batches:
            for lo, hi in pieces(whole, field(whole, text)):
                batch = whole.slice(lo, hi - lo)
                n = len(batch)
                if index is None:
                    yield pa.record_batch([carry_fields(batch, names), pa.array([share] * n), pa.array([[]] * n, EVIDENCE)], ["row", "score", "evidence"])
                    continue
                doc, term, weight = index.vectors(*_bags(field(batch, text)), n)
                scores, why = np.empty(n), []
                for a in range(0, n, QUERIES):
                    b = min(a + QUERIES, n)
                    x, y = np.searchsorted(doc, [a, b])
                    for i, (cosine, at) in enumerate(zip(*index.nearest(doc[x:y] - a, term[x:y], weight[x:y], b - a, NEIGHBOURS)), a):
                        scores[i] = index.score(index.vote(cosine, at))
                        why.append([{"doc_id": int(index.ids[j]), "cosine": float(c), "toxic": int(index.labels[j])} for c, j in zip(cosine[:evidence], at[:evidence]) if j >= 0])
                yield pa.record_batch([carry_fields(batch, names), pa.array(scores), pa.array(why, EVIDENCE)], ["row", "score", "evidence"])
            trim()

    return f


EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, *, learn_from: str = "true", doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, evidence: int = 3) -> DataFrame:
    """row (a struct of the carried columns), score (0 to 1) and evidence (the nearest examples) for each row of docs.

    labels: (doc_id, toxic); corpus: the table that has their texts and whose document frequencies count, docs if it is not given.
    learn_from is a condition on doc_id. Of each label the rows of smallest hash of doc_id are the examples: sample rows, or fewer
    that have sample_bytes of text together. Rows of labels without id, label or text are not used; of an id that is repeated in
    labels or corpus one row counts. If examples of a label are missing, every score is the share of label 1 (0 if there are none).

    A null or empty text, or one without any word of the examples, has no neighbours: the prior alone votes. Very long texts are
    scored like others; repeated rows are scored one by one; an empty table gives no rows; columns of any name are carried in row.
    """
    spark = docs.sparkSession
    corpus = docs if corpus is None else corpus
    source = corpus.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    labelled = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").where(learn_from)
    labelled = labelled.groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    known = labelled.join(source.where("text is not null").groupBy("doc_id").agg(F.max(F.octet_length("text")).alias("size")), "doc_id")
    counted = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = counted.get(1, 0) / max(1, sum(counted.values()))
    chosen = []
    for label in (0, 1):
        left = sample_bytes
        for r in known.where(F.col("toxic") == label).orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(sample).collect():
            left -= r.size
            if left < 0:
                break
            chosen.append((r.doc_id, r.toxic, r.size))
    examples = source.where("text is not null").join(F.broadcast(spark.createDataFrame(chosen, "doc_id long, toxic int, size int")), "doc_id").where(F.octet_length("text") == F.col("size"))
    bags = Bags(examples.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min("text").alias("text")).orderBy("doc_id").toArrow())
    index = stored = None
    if len(bags.terms) and len(set(bags.label.tolist())) == 2:
        counts = rows_of(source, "text").mapInArrow(_frequencies(spark.sparkContext.broadcast(bags.terms), "text"), "seen binary")
        counts = counts.select(F.pmod(F.spark_partition_id(), F.lit(8)).alias("share"), "seen").groupBy("share").applyInArrow(_summed, "seen binary").toArrow()
        seen, total = (sum(x) for x in zip(*(unpacked(b, np.int64, np.int64) for b in counts.column("seen").to_pylist())))
        index = build_index(bags, seen, int(total[0]), share)
        _calibrate(spark, index)
        stored = index.stored()
    del bags, index
    drop(spark)
    rows = rows_of(docs, *carry, text)
    names = list(carry)
    return rows.mapInArrow(_scored(spark.sparkContext.broadcast(stored), names, text, share, evidence), carried(rows, names, "score double, evidence array<struct<doc_id: long, cosine: double, toxic: int>>"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: all documents, learning from labelled ones whose crc32 of the id leaves a rest by 5."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = toxicity_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn_from="crc32(cast(doc_id as string)) % 5 != 0")
    ids = F.col("row.doc_id")
    return found.select(ids.alias("doc_id"), F.coalesce(F.crc32(ids.cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
