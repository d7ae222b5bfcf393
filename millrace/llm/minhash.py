"""Near-duplicate documents by b-bit MinHash.

Minima of 128 permutations make the keys of 32 bands; then only their low bits are kept, packed. Documents that share a band are
compared by bit counts, corrected for chance agreement, and pairs that may reach the threshold are confirmed on full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, components, drop, field, grams, hot_limit, looked_up, mixed, pieces, rows_of, table, trim, word_hashes

#: Words of a shingle, and the similarity of a link in percent.
WORDS, PERCENT = 5, 80
#: Permutations, rows of a band, bands, kept bits: no band agrees for two pairs in 10^8 at a similarity of 0.85, for three in 10^6 at 0.8.
HASHES, ROWS, BANDS, BITS = 128, 4, 24, 2
#: A pair this far (about six standard deviations) below the threshold by its kept bits is not compared in full.
SLACK = 0.25
#: Documents that one task compares with each other; larger buckets are compared in pairs of blocks of about so many.
BLOCK = 2048
#: Members of a bucket that one task compares with a copy of the pivot's set.
SHARE = 256


def shingle_sets(text: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted hashes of each text's shingles; of all its words, if they are fewer; empty without words."""
    h, counts = word_hashes(text)
    all_grams, out, at = grams(h, words), [], 0
    for n in counts.tolist():
        own = all_grams[at : at + n - words + 1] if n >= words else grams(h[at : at + n], n) if n else h[:0]
        out.append(np.unique(own))
        at += n
    return out


def _signed(text: str, doc_id: str, words: int, hashes: int, rows: int, bands_: int, bits: int):
    rng = np.random.default_rng(20)
    a = rng.integers(0, 1 << 31, hashes, np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, hashes, np.int64).astype(np.uint32)

    def f(batches):
        for whole in batches:
            for lo, hi in pieces(whole, field(whole, text), 2 << 20):
                batch = whole.slice(lo, hi - lo)
                sets = shingle_sets(field(batch, text), words)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                keys = [xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else None for s in sets]
                bands, signature = [None] * len(sets), [None] * len(sets)
                if len(full):
                    h = (np.concatenate([sets[i] for i in full]) >> U64(32)).astype(np.uint32)
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    least = np.stack([np.minimum.reduceat(h * a[k] + b[k], starts) for k in range(hashes)], 1)
                    wide = least[:, : bands_ * rows].astype(U64).reshape(len(full), bands_, rows)
                    band = np.zeros(wide.shape[:2], U64) + np.arange(bands_, dtype=U64)
                    for r in range(rows):
                        band = mixed(band * U64(31) + wide[:, :, r])
                    planes = [np.packbits((least >> np.uint32(p)) & np.uint32(1), axis=1).view(np.int64) for p in range(bits)]
                    packed = np.concatenate(planes, 1)
                    for j, i in enumerate(full.tolist()):
                        bands[i], signature[i] = band[j].view(np.int64), packed[j]
                half = [(k >> 64, k & (1 << 64) - 1) if k is not None else (None, None) for k in keys]
                yield pa.record_batch(
                    [
                        pa.array(field(batch, doc_id)), pa.array(sizes), *[pa.array([None if k[j] is None else k[j] - (1 << 63) for k in half], pa.int64()) for j in (0, 1)],
                        pa.array(signature, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n", "k1", "k2", "signature", "bands"],
                )
            trim()

    return f


def _sets(text: str, doc_id: str, words: int):
    def f(batches):
        for whole in batches:
            for lo, hi in pieces(whole, field(whole, text)):
                batch = whole.slice(lo, hi - lo)
                sets = [s.view(np.int64) for s in shingle_sets(field(batch, text), words)]
                yield pa.record_batch([field(batch, doc_id), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "h"])
            trim()

    return f


def _unit_links(percent: int):
    """Links between the documents of a unit whose roots differ, as many as join them: exact intersections by matrix products."""

    def f(rows: pa.Table) -> pa.Table:
        rep, root, n = (rows.column(c).to_numpy() for c in ("rep", "root", "n"))
        flat = rows.column("h").combine_chunks().flatten().to_numpy()
        doc = np.repeat(np.arange(len(rep)), n)
        _, of, count = np.unique(flat, return_inverse=True, return_counts=True)
        column = np.cumsum(count > 1) - 1
        both = count[of] > 1
        of, doc = column[of[both]], doc[both]
        order = np.argsort(of, kind="stable")
        of, doc = of[order], doc[order]
        common = np.zeros((len(rep), len(rep)), np.float32)
        step = max(64, (1 << 24) // max(1, len(rep)))
        for a in range(0, int(of[-1]) + 1 if len(of) else 0, step):
            lo, hi = np.searchsorted(of, [a, a + step])
            x = np.zeros((len(rep), min(step, int(of[-1]) + 1 - a)), np.float32)
            x[doc[lo:hi], of[lo:hi] - a] = 1
            common += x @ x.T
        common = common.astype(np.int64)
        linked = np.triu((common * 100 >= (n[:, None] + n[None, :] - common) * percent) & (root[:, None] != root[None, :]), 1)
        up = {}

        def find(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        out = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
            a, b = find(root[i]), find(root[j])
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((rep[i], rep[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return f


def _pivot_links(percent: int):
    """Links of a unit's members (role 1) with its pivot (role 0), by exact intersections of their sorted sets."""

    def f(rows: pa.Table) -> pa.Table:
        role, rep, sets = rows.column("role").to_numpy(), rows.column("rep").to_numpy(), rows.column("h").combine_chunks()
        flat, offsets = sets.flatten().to_numpy().view(U64), sets.offsets.to_numpy() - sets.offsets[0].as_py()
        own = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        out = []
        for i in np.flatnonzero(role == 0).tolist():
            x = own[i]
            for j in np.flatnonzero(role == 1).tolist():
                y = own[j]
                common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                if common * 100 >= (len(x) + len(y) - common) * percent:
                    out.append((rep[i], rep[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return f


def _alike(hashes: int, bits: int) -> F.Column:
    """The similarity of signatures x and y: agreeing positions, less those that agree by chance."""
    words = hashes // 64
    same = sum(F.bit_count(F.bitwise_not(_any([F.get("x", F.lit(p * words + w)).bitwiseXOR(F.get("y", F.lit(p * words + w))) for p in range(bits)]))) for w in range(words))
    chance = 0.5**bits
    return (same / hashes - chance) / (1 - chance)


def _any(planes):
    out = planes[0]
    for p in planes[1:]:
        out = out.bitwiseOR(p)
    return out


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, hashes: int = HASHES, rows: int = ROWS, bands: int = BANDS, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs.

    Equal sets are one class, of which only the smallest doc_id is compared, so copies make no pairs. In each bucket of a band the
    members are first compared with one pivot. Where links then leave several components in a bucket, all its members are compared
    within one task, or in pairs of blocks if they are many, and only links that join components come out.

    Null and empty texts have empty sets and are linked with nothing. Rows that share a doc_id are one node with all their links.
    A null doc_id is a node of its own: component_id null, kept. An empty table gives no rows; other columns are not read.
    """
    source = rows_of(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id", "text")
    signed = table(source.mapInArrow(_signed("text", "doc_id", words, hashes, rows, bands, bits), "doc_id long, n long, k1 long, k2 long, signature array<long>, bands array<long>"))
    some = signed.where("n > 0 and doc_id is not null")
    # a document can be the smallest of two classes if ids repeat, so classes are nodes of their own by (k1, k2), named by their id
    classes = some.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n", "signature", "bands")).alias("first"), F.count("*").alias("copies"))
    classes = table(classes.select("k1", "k2", F.col("first.doc_id").alias("rep"), "copies", "first.n", "first.signature", "first.bands"))
    buckets = classes.select("rep", "k1", F.posexplode("bands").alias("pos", "band")).select(F.xxhash64("pos", "band").alias("bucket"), "rep", "k1")
    shared = buckets.groupBy("bucket").agg(F.min(F.struct("rep", "k1")).alias("pivot"), F.count("*").alias("members")).where("members > 1")
    limit = hot_limit(docs.sparkSession, classes.count() * bands)
    members = looked_up(buckets, shared, ["bucket"], "members", limit)
    members = table(members.select("bucket", F.struct("rep", "k1").alias("node"), "pivot", "members"))
    node = F.struct("rep", "k1")
    signatures = classes.select(node.alias("node"), "signature", "n")
    wanted = members.select("node.rep").distinct()
    texts = source.join(wanted.hint("shuffle_hash"), F.col("row.doc_id") == F.col("rep"), "left_semi")
    sets = texts.mapInArrow(_sets("text", "doc_id", words), "doc_id long, h array<long>").select(F.col("doc_id").alias("rep"), "h")
    # a repeated id may have several sets of one size: any of them is compared, as what one is linked with, the id is
    sets = table(sets)

    # a pivot's members are dealt out, and each share gets the pivot's signature and set once
    shares = F.ceil(F.col("members") / SHARE).cast("int")
    pairs = members.where("node != pivot").groupBy("pivot", "node").agg(F.max("members").alias("members"))
    pairs = table(pairs.select(F.struct("pivot", shares.alias("of"), F.pmod(F.xxhash64("node"), shares).cast("int").alias("share")).alias("unit"), "node"))
    heads = pairs.select("unit").distinct().join(signatures.select(F.col("node").alias("pivot"), F.col("signature").alias("x"), F.col("n").alias("na")), F.col("unit.pivot") == F.col("pivot"))
    both = pairs.join(signatures.select("node", F.col("signature").alias("y"), F.col("n").alias("nb")), "node").join(heads, "unit")
    both = both.where((_alike(hashes, bits) >= percent / 100 - SLACK) & (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent))
    both = table(both.select("unit", F.col("pivot.rep").alias("head"), "na", F.col("node.rep").alias("rep"), F.col("nb").alias("n")).where("head != rep"))
    rows_ = both.select("unit", F.lit(1).alias("role"), "rep", "n").unionByName(both.select("unit", F.lit(0).alias("role"), F.col("head").alias("rep"), F.col("na").alias("n")).distinct())
    rows_ = rows_.join(sets, "rep").where("size(h) = n").select("unit", "role", "rep", "h")
    linked = rows_.groupBy("unit").applyInArrow(_pivot_links(percent), "a long, b long").distinct()
    # two graphs at once: links, and overlaps of buckets
    graphs = linked.select(F.lit(0).alias("graph"), "a", "b").unionByName(pairs.select(F.lit(1).alias("graph"), F.col("unit.pivot.rep").alias("a"), F.col("node.rep").alias("b")))
    graphs = table(components(graphs, "graph"))
    roots, loose = (graphs.where(f"graph = {g}").select("node", "root") for g in (0, 1))
    # documents of one group of overlapping buckets are compared together if they are few, else bucket by bucket
    sizes = loose.groupBy("root").agg(F.count("*").alias("size"))
    loose = looked_up(loose, sizes, ["root"], "size", limit).select(F.col("node").alias("rep"), F.when(F.col("size") <= block, F.col("root")).alias("group"))
    placed = members.select("bucket", "node.rep", "node.k1").join(loose, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    unit = F.when(F.col("group").isNotNull(), F.struct(F.lit(0).alias("kind"), F.col("group").alias("id"))).otherwise(F.struct(F.lit(1).alias("kind"), F.col("bucket").alias("id")))
    placed = table(placed.select(unit.alias("unit"), "rep", "k1", F.coalesce("root", "rep").alias("root")).distinct())
    open_ = placed.groupBy("unit").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")).where("lo != hi").select("unit", "size", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    own_block = F.pmod(F.xxhash64("rep", "k1"), F.col("blocks")).cast("int")
    spread = looked_up(placed, open_, ["unit"], "size", limit).select("unit", "rep", "k1", "root", own_block.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.join(classes.select("rep", "k1", "n"), ["rep", "k1"]).join(sets, "rep").where("size(h) = n")
    spread = spread.select("unit", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "rep", "root", "n", "h")
    joining = spread.groupBy("unit", "lo", "hi").applyInArrow(_unit_links(percent), "a long, b long").where("a != b")
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(joining)
    # copies join their class, and rows that share an id join each other
    some, copies = some.select("doc_id", "k1", "k2"), classes.select("k1", "k2", "rep", "copies")
    limit = hot_limit(docs.sparkSession, some.count())
    own = looked_up(some, copies, ["k1", "k2"], "copies", limit).select("doc_id", "rep").distinct()
    repeated = own.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("doc_id", "a")
    twice = own.join(repeated, "doc_id").select("a", F.col("rep").alias("b")).where("a != b").distinct()
    roots = components(links.unionByName(twice)).select(F.col("node").alias("rep"), "root")
    copies = copies.join(roots, "rep", "left").select("k1", "k2", F.coalesce("root", "rep").alias("component_id"), "copies")
    found = looked_up(some, copies, ["k1", "k2"], "copies", limit).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: all documents, linked from 85 percent."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85)


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.root::BIGINT AS component_id, c.root = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
