"""Benchmark decontamination by winnowing.

The minimum hash of each window of k-grams is a fingerprint; a shared span of k + w - 1 words always shares one, so fingerprints
of documents are joined with those of the benchmark and only then are the windows around a hit compared in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, carry_fields, field, grams, pieces, rows_of, table, trim, word_hashes

#: Words of a k-gram, and of a window. A window holds WINDOW - K + 1 k-grams.
K, WINDOW = 5, 10
#: Windows of the benchmark that are broadcast at once: 40 bytes each, and the ids of their items.
BLOCK_WINDOWS = 1_000_000


def _least(g: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w consecutive values."""
    out = g[: len(g) - w + 1].copy()
    for i in range(1, w):
        np.minimum(out, g[i : len(g) - w + 1 + i], out=out)
    return out


def _benchmark_windows(k: int, window: int):
    def f(batches):
        for batch in batches:
            ids = field(batch, "item_id").to_pylist()
            h, counts = word_hashes(field(batch, "text"), alnum=True)
            at, out = 0, []
            for item, n in zip(ids, counts.tolist()):
                own = h[at : at + n]
                at += n
                if not n or item is None:
                    continue
                size = min(n, window)
                full, first = np.unique(grams(own, size), return_index=True)
                marks = _least(grams(own, k), window - k + 1)[first].view(np.int64) if size == window else np.zeros(len(full), np.int64)
                out.append(pa.record_batch([pa.array([item] * len(full), pa.string()), pa.array([size] * len(full), pa.int32()), pa.array(full.view(np.int64)), pa.array(marks)], ["item", "size", "window", "mark"]))
            yield from out

    return f


class _Block:
    """A block of benchmark windows in sorted arrays: fingerprints, and by size the windows with their items."""

    def __init__(self, rows: pa.Table, most: int):
        size, window, mark = (rows.column(c).to_numpy() for c in ("size", "window", "mark"))
        item = rows.column("item").combine_chunks().dictionary_encode()
        number = item.indices.to_numpy(zero_copy_only=False)
        self.items = item.dictionary.to_pylist()
        self.marks = np.unique(mark[size == most].view(np.uint64))
        self.sizes = {}
        for n in np.unique(size).tolist():
            own = np.flatnonzero(size == n)
            own = own[np.argsort(window[own].view(np.uint64), kind="stable")]
            self.sizes[n] = window[own].view(np.uint64), number[own].astype(np.int64)


def _within(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of h are in the sorted array known."""
    if not len(known) or not len(h):
        return np.zeros(len(h), bool)
    at = np.searchsorted(known, h)
    return known[np.minimum(at, len(known) - 1)] == h


def _search(block: _Block, h: np.ndarray, counts: np.ndarray, k: int, window: int):
    """Over the words of several documents: which words are hit, and (document, item number) pairs."""
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)
    hit = np.zeros(len(h) + 1, np.int64)
    pairs = []
    for size, (known, items) in block.sizes.items():
        if len(h) < size:
            continue
        if size == window:
            g = grams(h, k)
            w = window - k + 1
            low = _least(g, w)
            # a k-gram is a fingerprint if it is the least of a window that has it; ties all count
            marked = np.zeros(len(g), bool)
            for i in range(w):
                marked[i : len(g) - w + 1 + i] |= g[i : len(g) - w + 1 + i] == low
            spots = np.flatnonzero(marked)
            spots = spots[_within(g[spots], block.marks)]
            starts = np.unique((spots[:, None] - np.arange(w)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts + window <= len(h))]
            full = grams(h, window)[starts] if len(starts) else np.zeros(0, np.uint64)
        else:
            starts, full = np.arange(len(h) - size + 1), grams(h, size)
        keep = starts + size <= ends[doc[starts]] if len(starts) else np.zeros(0, bool)
        starts, full = starts[keep], full[keep]
        found = _within(full, known)
        starts, full = starts[found], full[found]
        np.add.at(hit, starts, 1)
        np.add.at(hit, starts + size, -1)
        lo, hi = np.searchsorted(known, full, "left"), np.searchsorted(known, full, "right")
        for s, a, b in zip(starts.tolist(), lo.tolist(), hi.tolist()):
            pairs.append(np.stack([np.full(b - a, doc[s]), items[a:b]]))
    return np.cumsum(hit[:-1]) > 0, (np.unique(np.concatenate(pairs, 1), axis=1) if pairs else np.zeros((2, 0), np.int64))


def _mark(block, text: str, names: list[str], k: int, window: int):
    def f(batches):
        for whole in batches:
            for a, b in pieces(whole, field(whole, text)):
                batch = whole.slice(a, b - a)
                h, counts = word_hashes(field(batch, text), alnum=True)
                hit, pairs = _search(block.value, h, counts, k, window)
                old_hit, old_items = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                own = {}
                for d, i in pairs.T.tolist():
                    own.setdefault(d, []).append(block.value.items[i])
                bits, items, n_hit, at = [], [], [], 0
                for d, n in enumerate(counts.tolist()):
                    mask = hit[at : at + n]
                    if old_hit[d]:
                        mask = mask | np.unpackbits(np.frombuffer(old_hit[d], np.uint8), count=n).astype(bool)
                    at += n
                    n_hit.append(int(mask.sum()))
                    bits.append(np.packbits(mask).tobytes() if n_hit[-1] else None)
                    items.append(sorted({*own.get(d, ()), *(old_items[d] or ())}))
                yield pa.record_batch([carry_fields(batch, names), pa.array(bits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(counts), pa.array(n_hit, pa.int64())], ["row", "hit_bits", "items", "n_words", "n_hit"])
            trim()

    return f


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", carry: tuple[str, ...] = ("doc_id",), k: int = K, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row for each row of docs: row (a struct of the carried columns), hit_bits (a bit for each word, null if
    none is hit), items (sorted ids, as strings, of the items with an occurring window), n_words and n_hit.

    Benchmark windows come in blocks of about block_windows, each dealt by window and item together with its own fingerprint, so
    that what is collected and broadcast has that bound at any benchmark size, also where a third of the items share a window; each
    further block is another pass over the documents. Null and empty texts have no words, items without words or id have no
    windows, repeated rows are judged one by one, very long texts are searched whole, an empty table gives no rows, and columns of
    any name are carried.
    """
    spark = docs.sparkSession
    bench = rows_of(benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text")), "item_id", "text")
    windows = table(bench.mapInArrow(_benchmark_windows(k, window), "item string, size int, window long, mark long").distinct())
    blocks = max(1, -(-windows.count() // block_windows))
    out = rows_of(docs, *carry, text).withColumns({"hit_bits": F.lit(None).cast("binary"), "items": F.lit(None).cast("array<string>")})
    for b in range(blocks):
        block = _Block(windows.where(f"pmod(xxhash64(window, item), {blocks}) = {b}").toArrow(), window)
        names = list(dict.fromkeys([*carry, *[text] * (b + 1 < blocks)]))
        out = out.select("row", "hit_bits", "items").mapInArrow(_mark(spark.sparkContext.broadcast(block), text, names, k, window), carried(out, names, "hit_bits binary, items array<string>, n_words long, n_hit long"))
        if b + 1 < blocks:
            out = table(out)
    return out


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every document against the whole benchmark."""
    found = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
tw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM t, (SELECT DISTINCT n FROM bw))),
hit AS (SELECT doc_id, i, n, item_id FROM tw JOIN bw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN h USING (doc_id) LEFT JOIN m USING (doc_id)
"""
