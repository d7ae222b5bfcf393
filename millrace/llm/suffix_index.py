"""Removal of long repeated byte strings by a logarithmic family of sparse suffix arrays.

A batch of texts is indexed at anchors: each 400-byte window chooses, by its own bytes alone, the position of the least hash in
its first 128 bytes. Suffixes at anchors are sorted by a digest of their first 273 bytes, which lie within every window that chose
them, so two equal windows meet at equal digests. A new batch's array is merge-scanned against the levels of the index, its
unseen suffixes become a level, and levels of like size are merged, so that there are logarithmically many.

Windows with one anchor form a group. If the whole group occurs elsewhere, all its windows do; else its windows are compared one
by one, but only where another group has the same digest. Texts move between partitions only as digests.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, each_row, field, mixed, pieces, rows_of, table, trim

SIZE, CHOICE = 400, 128
#: Bytes of a batch, windows that are worked on at once, and batches for each partition of the digests.
BATCH_BYTES, SEGMENT, BATCHES = 2 << 20, 1 << 17, 16
_LOW = U64((1 << 18) - 1)
_BASES = (U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F))


def _powers(base: U64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    inverse = U64(pow(int(base), -1, 1 << 64))
    out = []
    for b in (base, inverse):
        p = np.full(n, b, U64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


class Windows:
    """Groups of the windows of one batch, by segments; data: the texts' bytes one after another, ends: where each text ends."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, size: int, choice: int):
        self.size, self.choice, self.leading = size, choice, size - choice + 1
        self.total = len(data)
        self.data = np.concatenate([data, np.zeros(size + choice + 16, np.uint8)])
        self.end = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) if len(ends) else np.zeros(0, np.int64)
        span = min(SEGMENT, max(self.total, 1)) + size + choice + 16
        self.powers = [_powers(b, span) for b in _BASES]

    def _digest(self, which: int, prefix: np.ndarray, at: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((prefix[stop] - prefix[at]) * self.powers[which][1][at] + (stop - at).astype(U64))

    def segments(self):
        """(first position, first and last window of each group, digest of the anchor's suffix, digest of the group, a function
        that gives the digests of windows)."""
        for s in range(0, self.total, SEGMENT):
            n = min(SEGMENT, self.total - s)
            i = np.flatnonzero(self.end[s : s + n] - np.arange(s, s + n) >= self.size)
            if not len(i):
                continue
            length = n + self.size + self.choice
            raw = self.data[s : s + length + 8]
            length = len(raw) - 8
            grams = np.empty(length, U64)
            for r in range(8):
                own = np.frombuffer(raw[r : r + (length - r + 7) // 8 * 8].tobytes(), "<u8")
                grams[r::8] = own
            grams = mixed(grams)
            prefixes = [np.concatenate([[U64(0)], np.cumsum(grams * p[0][:length])]) for p in self.powers]
            least = (grams & ~_LOW) | (_LOW - np.arange(length, dtype=U64))  # of equal hashes the last
            width = 1
            while width < self.choice:
                step = min(width, self.choice - width)
                least = np.minimum(least[: len(least) - step], least[step:])
                width += step
            anchor = (_LOW - (least[i] & _LOW)).astype(np.int64)
            new = np.ones(len(i), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (i[1:] != i[:-1] + 1)
            first = np.flatnonzero(new)
            lo, hi, at = i[first], i[np.append(first[1:], len(i)) - 1], anchor[first]
            leading = self._digest(0, prefixes[0], at, at + self.leading - 7)
            whole = mixed(self._digest(1, prefixes[1], lo, hi + self.size - 7) * U64(3) + (at - lo).astype(U64))
            yield s, lo, hi, leading, whole, lambda at, p=prefixes[1]: self._digest(1, p, at, at + self.size - 7)


class Levels:
    """A logarithmic family of sorted digest arrays, each with the number of places (at most 2), and the least and the largest mark."""

    def __init__(self):
        self.levels: list[list[np.ndarray]] = []

    def add(self, key: np.ndarray, n: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Merge-scans a sorted batch of distinct digests against all levels; what no level has becomes a level."""
        fresh = np.ones(len(key), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level[0], key), len(level[0]) - 1)
            hit = level[0][at] == key
            own = at[hit]
            level[1][own] = np.minimum(level[1][own] + n[hit], 2)
            level[2][own] = np.minimum(level[2][own], lo[hit])
            level[3][own] = np.maximum(level[3][own], hi[hit])
            fresh &= ~hit
        if fresh.any():
            self.levels.append([x[fresh] for x in (key, n, lo, hi)])
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            a, b = self.levels.pop(), self.levels.pop()
            key = np.concatenate([a[0], b[0]])
            order = np.argsort(key, kind="stable")
            self.levels.append([np.concatenate([x, y])[order] for x, y in zip(a, b)])

    def get(self, key: np.ndarray) -> list[np.ndarray]:
        """Places, least and largest mark of digests that have been added."""
        out = [np.zeros(len(key), np.uint32) for _ in range(3)]
        for level in self.levels:
            at = np.minimum(np.searchsorted(level[0], key), len(level[0]) - 1)
            hit = level[0][at] == key
            for x, y in zip(out, level[1:]):
                x[hit] = y[at[hit]]
        return out


def _distinct(key: np.ndarray, mark: np.ndarray, parts: int):
    """Distinct digests ordered by partition and value, with places, least and largest mark, and the number of each place's digest."""
    order = np.lexsort((mark, key))
    k = key[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    stop = np.append(first[1:], len(k))
    distinct, lo, hi = k[first], mark[order][first], mark[order][stop - 1] if len(k) else mark[:0]
    n = np.minimum(stop - first, 2).astype(np.uint32)
    by = np.lexsort((distinct, distinct % U64(parts)))
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    number = np.empty(len(key), np.int64)
    number[order] = rank[np.repeat(np.arange(len(first)), stop - first)]
    return distinct[by], n[by], lo[by].astype(np.uint32), hi[by].astype(np.uint32), number


def _asked(kind: int, batch: str, distinct, n, lo, hi, parts: int):
    """Rows (kind, p, batch, digests, places, least, largest), one for each partition of the digests."""
    cuts = np.searchsorted(distinct % U64(parts), np.arange(parts + 1, dtype=U64))
    own = np.flatnonzero(np.diff(cuts)).tolist()
    blobs = [[x[cuts[p] : cuts[p + 1]].tobytes() for p in own] for x in (distinct, n.astype(np.uint8), lo, hi)]
    return [pa.array([kind] * len(own), pa.int32()), pa.array(own, pa.int64()), pa.array([batch] * len(own), pa.string()), *[pa.array(x, pa.binary()) for x in blobs]]


ASKED = ["kind", "p", "batch", "keys", "n", "lo", "hi"]
ASKED_DDL = "kind int, p long, batch string, keys binary, n binary, lo binary, hi binary"
LEADING, WHOLE, SINGLE = 0, 1, 2


def _answered(rows: pa.Table) -> pa.Table:
    """A partition of one kind of digests: the index over its batches, and for each batch a byte for each digest: 1 if it is
    repeated, and 2 if groups differ after it (LEADING) or if this batch is its first (WHOLE)."""
    kind, levels = rows.column("kind")[0].as_py(), Levels()
    blobs = [rows.column(c).to_pylist() for c in ("keys", "n", "lo", "hi")]
    keys = [np.frombuffer(k, U64) for k in blobs[0]]
    for b, (k, n, lo, hi) in enumerate(zip(keys, *blobs[1:])):
        n = np.frombuffer(n, np.uint8).astype(np.uint32)
        if kind == LEADING:
            lo, hi = np.frombuffer(lo, np.uint32).copy(), np.frombuffer(hi, np.uint32).copy()
        else:
            lo = hi = np.full(len(k), b, np.uint32)
        levels.add(k, n, lo, hi)
    out = []
    for b, k in enumerate(keys):
        n, lo, hi = levels.get(k)
        out.append(((n >= 2) + 2 * (lo != hi if kind == LEADING else lo == b)).astype(np.uint8).tobytes())
    return pa.table({"kind": rows.column("kind"), "p": rows.column("p"), "batch": rows.column("batch"), "codes": pa.array(out, pa.binary())})


def _batches(text: str, doc_id: str):
    def f(batches):
        for whole in batches:
            for lo, hi in pieces(whole, field(whole, text), BATCH_BYTES):
                batch = whole.slice(lo, hi - lo)
                data = [b or b"" for b in field(batch, text).cast(pa.binary()).to_pylist()]
                ends = np.cumsum([len(b) for b in data]).astype(np.int64)
                yield pa.record_batch([pa.array([uuid.uuid4().hex]), pa.array([field(batch, doc_id).to_pylist()], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([pa.compress(b"".join(data), codec="zstd", asbytes=True)], pa.binary())], ["batch", "ids", "ends", "data"])
            trim()

    return f


def _groups(row_ends, data, size: int, choice: int):
    return list(Windows(_bytes(row_ends, data), np.array(row_ends, np.int64), size, choice).segments())


def _bytes(row_ends, data) -> np.ndarray:
    """The bytes of a batch's texts, which are stored and moved compressed."""
    return np.frombuffer(pa.decompress(data, row_ends[-1], codec="zstd"), np.uint8) if row_ends[-1] else np.zeros(0, np.uint8)


def _joined(parts_of, index: int):
    return np.concatenate([x[index] for x in parts_of]) if parts_of else np.zeros(0, U64)


def _first(parts: int, size: int, choice: int):
    """The digests of a batch's suffixes and groups."""

    def f(batches):
        for whole in batches:
            for batch, ends, data in each_row(whole):
                found = _groups(ends, data, size, choice)
                leading, group = _joined(found, 3), _joined(found, 4)
                for kind, key, mark in ((LEADING, leading, group), (WHOLE, group, np.zeros(len(group), U64))):
                    *own, _ = _distinct(key, (mark >> U64(32)).astype(np.int64), parts)
                    yield pa.record_batch(_asked(kind, batch, *own, parts), ASKED)
                trim()

    return f


def _codes(answers: pa.Table, kind: int) -> np.ndarray:
    own = sorted((r["p"], r["codes"]) for r in answers.select(["kind", "p", "codes"]).to_pylist() if r["kind"] == kind)
    return np.frombuffer(b"".join(c for _, c in own), np.uint8)


def _decided(found, answers: pa.Table, parts: int):
    """For each group: whether all its windows are repeated, whether its windows must be compared, whether they stand for others."""
    leading, group = _joined(found, 3), _joined(found, 4)
    *_, at_leading = _distinct(leading, (group >> U64(32)).astype(np.int64), parts)
    *_, at_group = _distinct(group, np.zeros(len(group), np.int64), parts)
    a, b = _codes(answers, LEADING)[at_leading], _codes(answers, WHOLE)[at_group]
    first = np.zeros(len(group), bool)
    first[np.unique(at_group, return_index=True)[1]] = True
    known = (a & 1 == 1) & (b & 1 == 1)
    return known, (a & 1 == 1) & (b & 1 == 0), known & (a & 2 == 2) & (b & 2 == 2) & first


def _expanded(found, chosen: np.ndarray):
    """Positions and digests of the windows of the chosen groups."""
    out, at = [], 0
    for s, lo, hi, _, _, digest in found:
        own = chosen[at : at + len(lo)]
        at += len(lo)
        n = (hi - lo + 1)[own]
        i = np.repeat(lo[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        out.append((s + i, digest(i)))
    return (np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])) if out else (np.zeros(0, np.int64), np.zeros(0, U64))


def _second(parts: int, size: int, choice: int):
    """The digests of a batch's windows that must be compared one by one."""

    def f(batches: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in batches.select(["batch", "ends", "data"]).to_pylist():
            found = _groups(row["ends"], row["data"], size, choice)
            if found:
                _, single, stand = _decided(found, answers, parts)
                _, key = _expanded(found, single | stand)
                *own, _ = _distinct(key, np.zeros(len(key), np.int64), parts)
                out.append(pa.table(_asked(SINGLE, row["batch"], *own, parts), ASKED))
        trim()
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), pa.string(), *[pa.binary()] * 4)], ASKED)

    return f


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _removed(parts: int, size: int, choice: int):
    def f(batches: pa.Table, answers: pa.Table) -> pa.Table:
        ids, sizes, spans, kept = [], [], [], []
        for row in batches.to_pylist():
            data, ends = _bytes(row["ends"], row["data"]), np.array(row["ends"], np.int64)
            found = _groups(row["ends"], row["data"], size, choice)
            change = np.zeros(len(data) + 1, np.int32)
            if found:
                known, single, stand = _decided(found, answers, parts)
                lo, hi = (np.concatenate([x[0] + x[k] for x in found])[known] for k in (1, 2))
                i, key = _expanded(found, single | stand)
                *_, number = _distinct(key, np.zeros(len(key), np.int64), parts)
                i = i[_codes(answers, SINGLE)[number] & 1 == 1] if len(i) else i
                for at, step in ((lo, 1), (hi + size, -1), (i, 1), (i + size, -1)):
                    np.add.at(change, at, step)
            gone = np.cumsum(change[:-1]) > 0
            starts = ends - np.diff(np.concatenate([[0], ends]))
            for d, a, b in zip(row["ids"], starts.tolist(), ends.tolist()):
                own = gone[a:b]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                ids.append(d)
                sizes.append(b - a)
                spans.append([{"start": x, "end": y} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())])
                kept.append(data[a:b][~own].tobytes() if len(edge) else data[a:b].tobytes())
        trim()
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, SPANS), "kept": pa.array(kept, pa.binary())})

    return f


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, choice: int = CHOICE) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for each row of docs: removed runs as byte offsets, and the bytes that are left.

    A byte goes if a string of size bytes that covers it also starts at any other place of any row. Null and empty texts have no
    bytes; repeated rows repeat each other, as do overlapping strings; a null doc_id is a text like others; an empty table gives
    no rows; other columns are not read; a text of any length is a batch of its own. Digests have 64 bits, and a string needs two equal ones to be taken for a repeat.
    """
    spark = docs.sparkSession
    source = rows_of(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id", "text")
    batches = table(source.mapInArrow(_batches("text", "doc_id"), "batch string, ids array<long>, ends array<long>, data binary"))
    # a partition's work stays the same as the texts grow
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-batches.count() // BATCHES))
    answer = "kind int, p long, batch string, codes binary"
    asked = batches.select("batch", "ends", "data").mapInArrow(_first(parts, size, choice), ASKED_DDL)
    answers = table(asked.groupBy("kind", "p").applyInArrow(_answered, answer))
    asked = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_second(parts, size, choice), ASKED_DDL)
    answers = answers.unionByName(table(asked.groupBy("kind", "p").applyInArrow(_answered, answer)))
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(_removed(parts, size, choice), "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every byte of every document."""
    found = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, md5(substr(x, 2 * i - 1, 800)) AS h FROM (SELECT *, unnest(range(1, length(x) // 2 - 398)) AS i FROM d)),
r AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
g AS (SELECT doc_id, i, sum((p IS NULL OR i > p + 400)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM r),
s AS (SELECT doc_id, k, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY doc_id, k),
q AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY k), 1) AS before FROM s),
o AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substr(x, 2 * before - 1, 2 * (a - before)), '' ORDER BY k) || substr(any_value(x), 2 * max(b) - 1) AS kept FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN o USING (doc_id)
"""
