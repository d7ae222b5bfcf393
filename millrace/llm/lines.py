"""Line dedup: hashes of lines, range-partitioned and sorted by document and position, are streamed to find which lines are kept.

The stream gives the positions of lost lines, and these a compressed bitmap of kept lines for each document that loses some. Only
digests are sorted and streamed; when bitmaps are applied, only texts that lose lines are moved to them.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, carry_fields, drop, field, rows_of, table

MIN_CHARS, MIN_DOCS = 40, 5
#: Bits of the filter that tells which rows may lose lines.
FILTER = 1 << 25
#: [\x20\x09-\x0D]
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _starts(columns) -> np.ndarray:
    """Where runs of (part, h1, h2) start."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns[:3]], 0)
    return np.flatnonzero(new)


def _outer(part: np.ndarray) -> list[int]:
    """Of runs with these parts: the first and the last one, and those where a part begins or ends."""
    change = np.flatnonzero(part[1:] != part[:-1])
    return np.unique(np.concatenate([[0, len(part) - 1], change, change + 1])).tolist()


def _documents(doc: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The number of distinct documents of each run."""
    new = np.ones(len(doc), np.int64)
    new[1:] = doc[1:] != doc[:-1]
    new[starts] = 1
    return np.add.reduceat(new, starts)


EDGES = ["part", "h1", "h2", "docs", "most", "least"]


def _edges(batches):
    """The first and the last run of each part of sorted rows (part, h1, h2, doc_id): the documents there, the largest, the smallest."""
    run, out = None, []

    def close():
        if run is not None:
            out.append(run[:6])

    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        part, h1, h2, doc = columns = [c.to_numpy() for c in batch.columns]
        starts = _starts(columns)
        docs, last = _documents(doc, starts), np.append(starts[1:], len(doc)) - 1
        for k in _outer(part[starts]):
            i = starts[k]
            if run is not None and run[:3] == [part[i], h1[i], h2[i]]:
                run[3] += int(docs[k]) - (run[5] == doc[i])
                run[5] = doc[last[k]]
                continue
            changed = run is None or run[0] != part[i]
            if changed or first:
                close()
            first = changed
            run = [part[i], h1[i], h2[i], int(docs[k]), doc[i], doc[last[k]]]
    close()
    if out:
        yield pa.record_batch([pa.array([int(r[j]) for r in out], pa.int64()) for j in range(6)], EDGES)


def _lost(known, min_docs: int):
    """Rows that are lost: those of a run of min_docs documents that aren't of its first, the largest document.

    Runs that go on in another part are in known, with their documents and largest one; of others at most the rows of min_docs
    documents are held until it is clear whether the run is common.
    """

    def f(batches):
        edges, held, decided, key = known.value, None, None, None  # decided: the open run's key and its largest document
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [c.to_numpy() for c in batch.columns]
            if key is None and (int(columns[1][0]), int(columns[2][0])) not in edges:
                raise RuntimeError("sorted lines were not read in the same pieces twice")
            if held is not None:
                columns, held = [np.concatenate(x) for x in zip(held, columns)], None
            starts = _starts(columns)
            part, h1, h2, doc, rid, pos = columns
            docs, most = _documents(doc, starts), doc[starts].copy()
            if decided and decided[0] == (int(h1[0]), int(h2[0])):
                docs[0], most[0] = min_docs, decided[1]
            for k in _outer(part[starts]):
                key = (int(h1[starts[k]]), int(h2[starts[k]]))
                docs[k], most[k] = edges.get(key, (docs[k], most[k]))
            common = docs >= min_docs
            decided = (key, int(most[-1])) if common[-1] else None
            if not common[-1]:
                held = [c[starts[-1] :].copy() for c in columns]
            n = np.diff(np.append(starts, len(doc)))
            gone = np.repeat(common, n) & (doc != np.repeat(most, n))
            if gone.any():
                yield pa.record_batch([pa.array(x[gone]) for x in (doc, rid, pos)], ["doc_id", "rid", "pos"])
        if key is not None and key not in edges:
            raise RuntimeError("sorted lines were not read in the same pieces twice")

    return f


def _bitmaps(batches):
    """(doc_id, rid, lost positions) to (doc_id, rid, n_dropped, keep_bits): zlib over a bit for each line up to the last lost one, 1 if it is kept."""
    for batch in batches:
        bits, counts = [], []
        for at in batch.column(2).to_pylist():
            keep = np.ones(max(at) // 8 * 8 + 8, np.uint8)
            keep[at] = 0
            counts.append(int((keep == 0).sum()))
            bits.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(bits, pa.binary())], ["doc_id", "rid", "n_dropped", "keep_bits"])


def _row_id(doc_id, text):
    return F.xxhash64(doc_id, F.coalesce(text, F.lit("")))


def line_bitmaps(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, rid, n_dropped, keep_bits) for each row that loses lines; rid is the hash of id and text.

    A key is a line stripped of ASCII white space with A-Z lower-cased. Keys of min_chars code points in min_docs documents stay
    only in the largest doc_id that has them. Rows without an id are no documents: they count for nothing and keep all lines.
    Rows that share an id are one document, each with its own bitmap. Null and empty texts have one empty line.
    """
    spark = docs.sparkSession
    ids, body = F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")
    source = docs.select(ids.alias("doc_id"), _row_id(ids, body).alias("rid"), body.alias("text")).where("doc_id is not null and text is not null")
    source = source.select("doc_id", "rid", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(SPACES)), UPPER, LOWER)
    source = source.select("doc_id", "rid", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
    source = source.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), "doc_id", "rid", "pos")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = table(source)  # texts are split once; the ranges' sample and the sort read digests
    # a key in a third of all documents spreads over many parts, as document and position are in the range
    order = ["h1", "h2", F.desc("doc_id"), "rid", "pos"]
    ranged = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = table(ranged.select(F.spark_partition_id().cast("long").alias("part"), "h1", "h2", "doc_id", "rid", "pos"))
    # two rows for each part: what runs that go on in another part have together
    found = ranged.select("part", "h1", "h2", "doc_id").mapInArrow(_edges, ", ".join(f"{x} long" for x in EDGES)).collect()
    known, last = {}, {}
    for r in sorted(found, key=lambda r: (r.h1, r.h2, -r.most, -r.least)):
        key = (r.h1, r.h2)
        docs, most = known.get(key, (0, r.most))
        known[key] = docs + r.docs - (last.get(key) == r.most), most
        last[key] = r.least
    drop(spark, lines)
    lost = ranged.mapInArrow(_lost(spark.sparkContext.broadcast(known), min_docs), "doc_id long, rid long, pos int")
    return lost.groupBy("doc_id", "rid").agg(F.collect_set("pos").alias("lost")).mapInArrow(_bitmaps, "doc_id long, rid long, n_dropped long, keep_bits binary")


def _apply(text: str, names):
    def f(batches):
        for batch in batches:
            texts, bits = field(batch, text).to_pylist(), batch.column(1).to_pylist()
            for i, b in enumerate(bits):
                if b is not None:
                    own = texts[i].split("\n")
                    bits_ = np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8))
                    keep = np.ones(len(own), bool)
                    n = min(len(own), len(bits_))
                    keep[:n] = bits_[:n] == 1
                    texts[i] = "\n".join(itertools.compress(own, keep))
            row = carry_fields(batch, names)
            own = [pa.array(texts, row.type.field(n).type) if n == text else row.field(j) for j, n in enumerate(names)]
            yield pa.record_batch([pa.StructArray.from_arrays(own, list(names)), batch.column(2), batch.column(3)], ["row", "n_lines", "n_dropped"])

    return f


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, *, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """row (a struct of the carried columns, the text without lost lines), n_lines before, n_dropped, for each row of docs.

    A text that loses nothing stays as it is, null included.
    """
    names = list(dict.fromkeys([*(carry or docs.columns), doc_id, text]))
    body = F.col(f"row.`{text}`")
    rows = rows_of(docs, *names)
    rows = rows.select("row", F.col(f"row.`{doc_id}`").cast("long").alias("doc_id"), _row_id(F.col(f"row.`{doc_id}`").cast("long"), body).alias("rid"))
    # a row without bitmap stays where it is: words of bits, at most FILTER / 64, tell which rows may have one
    bitmaps = table(bitmaps)
    place = lambda rid: (F.shiftright(F.pmod(rid, F.lit(FILTER)), 6).alias("word"), F.pmod(rid, F.lit(64)).cast("int").alias("bit"))
    words = bitmaps.select(*place(F.col("rid"))).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    rows = rows.select("row", "doc_id", "rid", *place(F.col("rid"))).join(F.broadcast(words), "word", "left")
    may = F.coalesce(F.expr("getbit(bits, bit) = 1"), F.lit(False))
    lines = (F.char_length(F.coalesce(body, F.lit(""))) - F.char_length(F.translate(F.coalesce(body, F.lit("")), "\n", "")) + 1).cast("long").alias("n_lines")
    moved = rows.where(may).join(bitmaps.hint("shuffle_hash"), ["doc_id", "rid"], "left").select("row", "keep_bits", lines, F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
    schema = carried(moved, names, "n_lines long, n_dropped long")
    same = rows.where(~may).select(F.col("row").cast(schema["row"].dataType).alias("row"), lines, F.lit(0).cast("long").alias("n_dropped"))
    return same.unionByName(moved.mapInArrow(_apply(text, names), schema))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every line of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = apply_bitmaps(docs, line_bitmaps(docs))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT d.doc_id, t.pos, t.line, translate(trim(t.line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents d, LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) t),
c AS (SELECT k, max(doc_id) AS most FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT l.*, coalesce(l.doc_id < c.most, false) AS lost FROM l LEFT JOIN c ON l.k = c.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
