"""What the operators of this subpackage share: scratch tables, tokens as hashes, rows carried through Arrow, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
MIX = U64(0x9E3779B97F4A7C15)


def scratch(spark: SparkSession) -> str:
    """A new path in the folder of spark.checkpoint.dir, which all executors share; in local mode, where that is unset, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base}/llm-{uuid.uuid4().hex}"


def table(df: DataFrame, by: str | list[str] | None = None) -> DataFrame:
    """df written once to the shared folder (a folder for each value of by) and read again: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


class Bucketed:
    """A growing table in the shared folder with n buckets by a column: grouping it by that column moves no rows."""

    def __init__(self, spark: SparkSession, by: str, n: int):
        self.spark, self.by, self.n, self.scratch_path, self.name = spark, by, n, scratch(spark), f"llm_{uuid.uuid4().hex}"

    def add(self, df: DataFrame, moved: bool = False) -> None:
        """Appends rows; moved: after they have come together by bucket, else each task writes files of its own."""
        rows = df.repartition(self.n, self.by) if moved else df
        rows.write.mode("append").format("parquet").bucketBy(self.n, self.by).option("path", self.scratch_path).saveAsTable(self.name)

    def read(self, share: int = 0, shares: int = 1) -> DataFrame:
        """All rows, or those of the buckets of one of so many shares."""
        rows = self.spark.table(self.name)
        return rows.where(F.pmod(F.hash(self.by), F.lit(self.n)) % shares == share) if shares > 1 else rows

    def shed(self, share: int, shares: int) -> None:
        """Deletes the buckets of a share, whose rows nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.scratch_path)
        files = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        for file in files.listStatus(path) if files.exists(path) else ():
            # Spark's writers name a file by its bucket: part-<task>-<id>_<bucket>.c000...
            bucket = re.search(r"_(\d+)(\.[^_]*)?$", file.getPath().getName())
            if bucket and not file.getPath().getName().startswith(("_", ".")) and int(bucket[1]) % shares == share:
                files.delete(file.getPath(), False)
        self.spark.catalog.refreshTable(self.name)

    def forget(self) -> None:
        """Takes the name out of the catalog; what read() gave can still be read."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def drop(spark: SparkSession, *tables: DataFrame | Bucketed, part: str = "") -> None:
    """Deletes tables that table() or Bucketed wrote (or a part of them) and that nothing reads any more, and lets go of finished jobs' shuffle files."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for df in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path + part)
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    trim()
    spark._jvm.System.gc()


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, the first bytes of all numbers before their second ones and so on, which compresses better; types
    are the reader's to know."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    raw = np.array([len(a) for a in arrays], np.int64).tobytes() + b"".join(planes)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(blob, *types) -> list[np.ndarray]:
    """The arrays of a blob of packed()."""
    blob = memoryview(blob)
    raw, out, at = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd"), [], 8 * len(types)
    for n, kind in zip(np.frombuffer(raw, np.int64, len(types)).tolist(), map(np.dtype, types)):
        own = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(own.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def rows_of(df: DataFrame, *columns: str, carry: bool = False) -> DataFrame:
    """One struct column `row`: the named columns, or with carry all of them, so that no name of the caller's can clash."""
    names = df.columns if carry else list(dict.fromkeys(columns))
    return df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))


def carried(df: DataFrame, names, more: str) -> T.StructType:
    """The schema of a result: `row` with the named fields of df's row, then the columns of the DDL string more."""
    old = df.schema["row"].dataType
    return T.StructType([T.StructField("row", T.StructType([old[n] for n in names])), *T.StructType.fromDDL(more).fields])


def carry_fields(batch: pa.RecordBatch, names) -> pa.StructArray:
    """The named fields of the row column of a batch."""
    return pa.StructArray.from_arrays([field(batch, n) for n in names], list(names))


def field(batch: pa.RecordBatch, name: str, column: str = "row") -> pa.Array:
    """A field of a struct column, null where the struct is null."""
    return pc.struct_field(batch.column(batch.schema.get_field_index(column)), name)


def trim() -> None:
    """Gives memory that freed arrays leave in a worker back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _trimmed(batches):
    gc.collect()
    trim()
    yield from batches


def release(spark: SparkSession) -> None:
    """Executors give back memory that earlier work left: Python workers old broadcasts and freed arrays, JVMs heap that is no longer used.

    One task for each core, so that every executor gets some; what is left over costs memory, never results.
    """
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).mapInArrow(_trimmed, "id long").selectExpr("java_method('java.lang.System', 'gc')").collect()


def each_row(batch: pa.RecordBatch):
    """The rows of a batch, one at a time: binary columns as buffers without a copy, others as Python values."""
    for i in range(batch.num_rows):
        yield [c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for c in batch.columns]


def pieces(batch: pa.RecordBatch, text: pa.Array, most: int = 4 << 20):
    """(start, stop) of runs of rows with at most so many bytes of text each, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def hash_words(words: pa.Array) -> np.ndarray:
    """The 64-bit hash of each word: eight bytes at a time for all words at once, those above 256 bytes one by one."""
    words = pa.concat_arrays([words.cast(pa.binary())])
    out = np.zeros(len(words), U64)
    if not len(words):
        return out
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.concatenate([np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    sizes = np.diff(offsets)
    out = mixed(sizes.astype(U64) + MIX)
    own = np.flatnonzero((sizes > 0) & (sizes <= 256))
    for at in range(0, 256, 8):
        own = own[sizes[own] > at]
        if not len(own):
            break
        left = np.minimum(sizes[own] - at, 8).astype(U64)
        out[own] = mixed((out[own] ^ (eight[offsets[own] + at] << (U64(64) - U64(8) * left))) * MIX)
    for i in np.flatnonzero(sizes > 256).tolist():
        out[i] = xxhash.xxh3_64_intdigest(words[i].as_buffer())
    return out


#: Bytes that separate words of [0-9a-z] and bytes from 0x80 on become spaces, A-Z become a-z.
ALNUM = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def split_words(text: pa.Array, alnum: bool = False) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another with A-Z lower-cased, and the number of words of each text; null has none.

    Words are [^\\x20\\x09-\\x0D]+, or with alnum [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing.
    """
    text = pc.fill_null(text.cast(pa.string()), "")
    if alnum:
        text = translated(text)
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    flat = lists.flatten()
    real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    ends = np.concatenate([[0], np.cumsum(real)])
    counts = ends[offsets[1:] - offsets[0]] - ends[offsets[:-1] - offsets[0]]
    return (flat if real.all() else flat.filter(pa.array(real))), counts.astype(np.int64)


def translated(text: pa.Array) -> pa.Array:
    """The texts with each byte mapped by ALNUM."""
    text = pa.concat_arrays([text])
    _, offsets, data = text.buffers()
    mapped = (data.to_pybytes() if data else b"").translate(ALNUM)
    return pa.Array.from_buffers(pa.string(), len(text), [None, offsets, pa.py_buffer(mapped)], offset=text.offset)


def word_hashes(text: pa.Array, alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all texts, and the number of words of each text."""
    words, counts = split_words(text, alnum)
    if not len(words):
        return np.zeros(0, U64), counts
    coded = words.dictionary_encode()
    return hash_words(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)], counts


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n word hashes; empty if there are fewer."""
    if len(h) < n:
        return np.zeros(0, U64)
    out = np.full(len(h) - n + 1, n, U64)
    for i in range(n):
        out = out * MIX + h[i : len(h) - n + 1 + i]
    return mixed(out)


def looked_up(rows: DataFrame, values: DataFrame, keys: list[str], size: str, limit: int) -> DataFrame:
    """rows with the columns of values, which has one row for each key and, as size, how many of rows have that key.

    Keys of more than limit rows are broadcast: there are at most (number of rows) / limit of them, and no task gets all rows of one.
    """
    hot = F.broadcast(values.where(F.col(size) > limit))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(values.where(F.col(size) <= limit), keys)
    return rows.join(hot, keys).unionByName(cold)


def hot_limit(spark: SparkSession, rows: int) -> int:
    """Rows of one key from which it is broadcast: so many that the broadcast has a few rows for each partition at most."""
    return max(64, rows // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def components(links: DataFrame, *by: str, rounds: int = 60) -> DataFrame:
    """(by, node, root) for each node of links (by, a, b long): root is the smallest node reachable; by keeps graphs apart.

    Alternates large-star and small-star joins over the links until they no longer change; each step is a written table. A node
    with many neighbours, as the middle of a star, gets its least neighbour by a broadcast of such nodes, which are few.
    """
    spark = links.sparkSession
    edges = table(links.select(*by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    node, before = [*by, "a"], None

    def least(rows: DataFrame, limit: int) -> DataFrame:
        return looked_up(rows, rows.groupBy(*node).agg(F.min("b").alias("m"), F.count("*").alias("size")), node, "size", limit).drop("size")

    for _ in range(rounds):
        limit = hot_limit(spark, 2 * (before[0] if before else edges.count()))
        both = edges.unionByName(edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
        large = table(least(both, limit).where("b > a").select(*by, F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())
        small = least(large, limit)
        near, far = small.where("b != m").select(*by, F.col("b").alias("a"), F.col("m").alias("b")), small.select(*by, "a", F.col("m").alias("b"))
        last, edges = edges, table(near.unionByName(far).where("a != b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64(*by, "a", "b").cast("decimal(38,0)"))).first()
        drop(spark, last, large)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(*by, F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(*by, F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
