"""Packing: order-preserving dynamic programming over cuts at document ends and sentence ends, and on a grid in long sentences alone.

Each partition holds a range of documents in order. Its token stream is packed block by block; within a block the cheapest chain
of cuts is found with a monotone queue, where a sequence costs its padding and a cut costs what it truncates.
"""

from __future__ import annotations

import functools
import os
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import field, pieces, rows_of, trim

LENGTH, END_ID = 2048, 1
#: What a cut costs, in padded tokens: at a document's end, at a sentence's end, elsewhere.
AT_DOC, AT_SENTENCE, ELSEWHERE = 0, 4, 16
#: Tokens of a sentence above which it may be cut inside, and the width of the grid of such cuts.
LONG, GRID = 64, 16
#: Tokens of a block, which bounds memory: a block ends with the document that reaches it.
BLOCK = 1 << 20
#: Words whose ids a worker remembers.
REMEMBERED = 500_000
#: White space that any tokenizer drops becomes a space.
#: A-Z are lower-cased first unless a special token, which is not, may be in the texts.
_SPACES = bytes(0x20 if c in (0x09, 0x0A, 0x0D) else c for c in range(256))


def _is_plain(word: str) -> bool:
    """Whether a word has Latin letters alone, each of which is one letter in lower case too."""
    return word.isalpha() and max(word) < "\u0250" and "\u0130" not in word


class _Ids:
    """Ids of texts by a tokenizer that treats words between spaces independently; each distinct word is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.last = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.clear()

    def clear(self):
        self.known, self.flat, self.starts, self.sizes = {}, np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def sentence_ends(self) -> np.ndarray:
        """Of each id whether it is a full stop, an exclamation or a question mark that ends a word."""
        out = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = token.removesuffix("</w>") in (".", "!", "?", "...", "!!", "?!")
        return out

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and the number of each word's; words of Latin letters alone come first.

        Such a word is one unit of the tokenizer, so its last id, and no other, is of a token that ends a unit: many are encoded as
        one text. Other words are encoded one by one.
        """
        plain = next((i for i, w in enumerate(words) if not _is_plain(w)), len(words))
        texts = [" ".join(words[a : min(a + 256, plain)]) for a in range(0, plain, 256)]
        ids = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        sizes = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        if len(sizes) != plain:
            raise RuntimeError("this tokenizer doesn't end each word with one token that ends words")
        got = [x.ids for a in range(plain, len(words), 4096) for x in self.tokenizer.encode_batch_fast(words[a : a + 4096], add_special_tokens=False)]
        more = np.fromiter(map(len, got), np.int64, len(got))
        return np.concatenate([ids, np.fromiter((i for x in got for i in x), np.uint32, int(more.sum()))]), np.concatenate([sizes, more])

    def __call__(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each text's."""
        if len(self.known) > REMEMBERED:
            self.clear()
        text = pa.concat_arrays([pc.fill_null(text.cast(pa.string()), "")])
        _, offsets, data = text.buffers()
        text = pa.Array.from_buffers(pa.string(), len(text), [None, offsets, pa.py_buffer((data.to_pybytes() if data else b"").translate(_SPACES))], offset=text.offset)
        # a letter and a run of signs before a space are always split, so they are looked up apart
        text = pc.replace_substring_regex(text, r"([A-Za-z])([.,;:!?*&%$#|]+( |$))", r"\1 \2")
        if (left := text.buffers()[2]) is None or b"<|" not in left.to_pybytes():
            text = pc.ascii_lower(text)
        lists = pc.split_pattern(text, " ")
        words, at = lists.flatten(), lists.offsets.to_numpy()
        coded = words.dictionary_encode()
        own = coded.dictionary.to_pylist()
        new = [w for w in own if w not in self.known]
        if new:
            new.sort(key=lambda w: not _is_plain(w))
            first = len(self.known)
            self.known.update(zip(new, range(first, first + len(new))))
            ids, sizes = self._encoded(new)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, ids])
        number = np.fromiter((self.known[w] for w in own), np.int64, len(own))
        of = number[coded.indices.to_numpy(zero_copy_only=False)] if len(own) else np.zeros(0, np.int64)
        sizes = self.sizes[of]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.starts[of] - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[at[1:] - at[0]] - ends[at[:-1] - at[0]]


@functools.cache
def _ids(path: str) -> _Ids:
    """One for each worker process, so that its later tasks know the words of earlier ones."""
    return _Ids(path)


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a block may be cut, its end last, and what a cut costs at each."""
    total = int(doc_ends[-1])
    cost = np.full(total + 1, ELSEWHERE, np.int64)
    sentence = np.flatnonzero(stops[ids]) + 1
    cost[sentence] = AT_SENTENCE
    cost[doc_ends] = AT_DOC
    known = np.unique(np.concatenate([[0], sentence, doc_ends]))
    gaps = np.diff(known)
    extra = np.where(gaps > min(LONG, length // 2), (gaps - 1) // GRID, 0)
    starts = np.repeat(known[:-1], extra)
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    # at the end, a rest splits into powers of two, which need no padding
    tail, rest = [], total
    for bit in range(length.bit_length() - 1):
        if (total % length) >> bit & 1:
            rest -= 1 << bit
            tail.append(rest)
    at = np.unique(np.concatenate([known, starts + nth * GRID, np.array(tail, np.int64)]))[1:]
    return at, cost[at]


def best_cuts(at: list[int], cost: list[int], length: int = LENGTH) -> list[int]:
    """The cheapest chain of cuts from 0 to the last position: each sequence costs length less its size, or nothing at a power
    of two (tried at document ends and near the block's end), each cut its own cost. Windows slide with a monotone queue."""
    places, best, came = [0, *at], [0], [0]
    # the queue: places from head on, with best + position increasing
    values, queue, head = [0], [0], 0
    powers = [1 << b for b in range(length.bit_length())]
    tail = at[-1] - 2 * length if at else 0
    for n, (j, c) in enumerate(zip(at, cost), 1):
        low = j - length
        while head < len(queue) and places[queue[head]] < low:
            head += 1
        value, source = (values[head] + length - j, queue[head]) if head < len(queue) else (1 << 60, 0)
        if c == AT_DOC or j > tail:
            for p in powers:
                k = bisect_left(places, j - p, 0, n)
                if k < n and places[k] == j - p and best[k] < value:
                    value, source = best[k], k
        value += c
        best.append(value)
        came.append(source)
        key = value + j
        while len(queue) > head and values[-1] >= key:
            values.pop()
            queue.pop()
        values.append(key)
        queue.append(n)
    out, n = [], len(at)
    while n:
        out.append(places[n])
        n = came[n]
    return out[::-1]


def _packed(text: str, doc_id: str, path: str, length: int, end_id: int, block: int):
    def f(batches):
        encode = _ids(path)
        stops = encode.sentence_ends()
        first, count = TaskContext.get().partitionId() << 40, 0
        docs, held, size = [], [], 0

        def flush():
            nonlocal docs, held, size, count
            if not docs:
                return None
            sizes = np.array([n for _, n in docs], np.int64)
            ends = np.cumsum(sizes)
            ids = np.concatenate(held)
            at, cost = cut_points(ids, ends, stops, length)
            cuts = np.array(best_cuts(at.tolist(), cost.tolist(), length), np.int64)
            bounds = np.unique(np.concatenate([[0], cuts, ends]))
            starts, stop = bounds[:-1], bounds[1:]
            of = np.searchsorted(ends, starts, "right")
            sequence = np.searchsorted(cuts, starts, "right")
            begins = np.concatenate([[0], cuts])[sequence]
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stop.tolist())]
            out = [pa.array([docs[d][0] for d in of.tolist()], pa.int64()), pa.array(starts - (ends - sizes)[of]), pa.array(stop - starts), pa.array(crc, pa.int64()), pa.array(sizes[of]), pa.array(first + count + sequence), pa.array(starts - begins)]
            count += len(cuts)
            docs, held, size = [], [], 0
            return pa.record_batch(out, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for whole in batches:
            for a, b in pieces(whole, field(whole, text)):
                batch = whole.slice(a, b - a)
                ids, counts = encode(field(batch, text))
                at = 0
                for i, n in zip(field(batch, doc_id).to_pylist(), counts.tolist()):
                    held += [ids[at : at + n], np.array([end_id], np.uint32)]
                    docs.append((i, n + 1))
                    at, size = at + n, size + n + 1
                    if size >= block:
                        yield flush()
            trim()
        if docs:
            yield flush()

    return f


def pack(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are packed in the order of their ids (null first, repeated ids one by one). A null or empty text has only the end
    id; a very long text may be cut into many sequences; an empty table gives no rows; other columns are not read. tokenizer is a file
    that exists on every executor.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows_of(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id", "text")
    rows = rows.repartitionByRange(parts, F.col("row.doc_id")).sortWithinPartitions("row.doc_id")
    return rows.mapInArrow(_packed("text", "doc_id", tokenizer, length, end_id, block), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    """op9: all documents."""
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
