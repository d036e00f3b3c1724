"""Packing by concatenate and cut: all documents in one stream of token ids, cut every `length` ids.

1. Texts are tokenised once; each task writes its documents' ids (with an end id each) and where they
   start among the task's own. The table fixes the numbering, so retries agree with each other.
2. Prefix sums over the tasks' totals turn those places into places in the whole stream.
3. Each task cuts its documents at the windows' bounds. Windows that lie within a task are whole there;
   the first and the last, which neighbours share, leave it as boundary records and are joined by
   sequence number. Ids are never shuffled but for those.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .tokens import encoder

VOCABULARY, RANKS = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH, END = 1024, 0
#: Characters for which both tokenizers split texts alike (letters, digits and blanks of Unicode's early
#: versions: Latin to Cyrillic, kana, unified ideographs, Hangul); a test compares them one by one.
ALIKE = "\x00-ԯぁ-ゖァ-ヺ一-龥가-힣"
#: Texts and characters that are tokenised at once.
TEXTS, CHARS = 500, 1 << 22


def tokeniser(vocabulary: str = VOCABULARY, ranks: str | None = RANKS) -> Callable[[str], np.ndarray]:
    """The ids of a text by the vocabulary, special strings being ordinary text. With the ranks of the same
    vocabulary, texts of ALIKE characters are tokenised by them, which gives the same ids sooner."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    slow.encode_special_tokens = True
    quick, other = encoder(ranks) if ranks else None, re.compile(f"[^{ALIKE}]")

    def ids(text: str) -> np.ndarray:
        if quick is not None and not other.search(text):
            try:
                return quick.encode_to_numpy(text, disallowed_special=())
            except ValueError:  # runs of white space that are too long for its splitter
                pass
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def _tokenise(vocabulary: str, ranks: str | None, end: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part, start, tail = tokeniser(vocabulary, ranks), TaskContext.get().partitionId(), 0, np.array([end], kind).tobytes()
        for batch in batches:
            size = pa.compute.fill_null(pa.compute.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(size[at : at + TEXTS]), CHARS, "right")))
                piece, out, starts = batch.slice(at, n), [], []
                for text in piece.column(1):
                    own = ids(text.as_py() or "")
                    out.append(own.astype(kind).tobytes() + tail)
                    starts.append(start)
                    start += len(own) + 1
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([part] * len(out), pa.int32()), pa.array(starts, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "part", "start", "tokens"])
                at += n

    return run


class Stream:
    """The documents (doc_id, text) of a table as one stream of ids, in the order of the scan's tasks."""

    def __init__(self, docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, ranks: str | None = RANKS, end: int = END):
        from tokenizers import Tokenizer

        self.length, self.end = length, end
        self.kind = "<u2" if max(Tokenizer.from_file(vocabulary).get_vocab_size(), end + 1) <= 1 << 16 else "<u4"
        self.each, self.id_kind = np.dtype(self.kind).itemsize, docs.schema["doc_id"].dataType.simpleString()
        made = cut(docs.select("doc_id", "text").mapInArrow(_tokenise(vocabulary, ranks, end, self.kind), f"doc_id {self.id_kind}, part int, start long, tokens binary"), "stream")
        n = F.octet_length("tokens") / self.each
        parts = made.groupBy("part").agg(F.max(F.col("start") + n).cast("long").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task of the scan
        base = cut(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
        # one row for each task of the scan: 16 MB for a million tasks, and ids need not be shuffled to it
        self.placed = made.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("start")).alias("at"), n.cast("int").alias("doc_tokens"), "tokens")

    def pieces(self) -> DataFrame:
        """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): one row for each document and
        sequence that it lies in; ids are little-endian unsigned 32-bit numbers."""
        length, kind, each = self.length, self.kind, self.each

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, n = batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64)
                first, last = at // length, (at + n - 1) // length
                many = last - first + 1
                row = np.repeat(np.arange(len(at)), many)
                seq = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                lo, hi = np.maximum(seq * length, at[row]), np.minimum((seq + 1) * length, (at + n)[row])
                # pieces of a document follow each other, so all ids of the batch are cut as one array
                tokens = batch.column(3)
                off = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset : tokens.offset + len(at) + 1]
                flat = np.frombuffer(tokens.buffers()[2], np.uint8)[off[0] : off[-1]].view(kind).astype("<u4")
                assert len(flat) * each == off[-1] - off[0]
                size = hi - lo
                for a, b in _slices(size * 4):
                    left = int(size[:a].sum())
                    bounds = np.concatenate([[0], np.cumsum(size[a:b] * 4)]).astype(np.int32)
                    ids = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat[left : left + bounds[-1] // 4].tobytes())])
                    r = row[a:b]
                    columns = [(lo[a:b] - at[r]), size[a:b], n[r], seq[a:b], lo[a:b] - seq[a:b] * length]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r)), *map(pa.array, columns), ids], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        return self.placed.mapInArrow(run, f"doc_id {self.id_kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")

    def sequences(self) -> DataFrame:
        """(sequence_id, n_tokens, ids): whole sequences, ids as in pieces. The stream's last sequence is
        padded to the length with the end id, unless its size is a power of two."""
        length, kind, each = self.length, self.kind, self.each

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, rows, next_at, begun, held = ["sequence_id", "offset", "ids"], [], -1, 0, []

            def close() -> None:
                if held:
                    rows.append((begun // length, begun % length, np.frombuffer(b"".join(held), kind).astype("<u4").tobytes()))
                    held.clear()

            def flush() -> pa.RecordBatch:
                a, b, c = zip(*rows, strict=True)
                rows.clear()
                return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(c, pa.binary())], names)

            for batch in batches:
                for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    view, n, done = memoryview(data.as_buffer()), len(data.as_buffer()) // each, 0
                    if at != next_at:  # not what follows: what is held is a boundary record
                        close()
                    while done < n:
                        if not held:
                            begun = at + done
                        k = min(n - done, length - (at + done) % length)
                        held.append(bytes(view[done * each : (done + k) * each]))
                        done += k
                        if (at + done) % length == 0:
                            close()
                        if len(rows) >= 1000:
                            yield flush()
                    next_at = at + n
            close()
            if rows:
                yield flush()

        found = cut(self.placed.select("at", "tokens").mapInArrow(run, "sequence_id long, offset int, ids binary"), "windows")
        complete = F.octet_length("ids") == 4 * length
        pieces = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda s: s["ids"])
        shared = found.where(~complete).groupBy("sequence_id").agg(pieces.alias("p")).select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"))
        out = found.where(complete).select("sequence_id", "ids").union(shared).withColumn("n_tokens", F.expr("octet_length(ids) div 4"))
        full = F.rpad("ids", 4 * length, F.lit(bytearray(np.array([self.end], "<u4").tobytes())))
        return out.select("sequence_id", F.col("n_tokens").cast("int").alias("n_tokens"), F.when(F.expr("n_tokens & (n_tokens - 1)") == 0, F.col("ids")).otherwise(full).alias("ids"))


def _slices(size: np.ndarray, most: int = 1 << 26) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes together (or one row)."""
    total, a = np.cumsum(size), 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, ranks: str | None = RANKS, end: int = END) -> DataFrame:
    """Pieces of docs(doc_id, text): doc_id, start (its ids before the piece), length, ids_crc32, doc_tokens,
    sequence_id and offset (where the piece lies). Each id lies in one piece; sequences are numbered from 0
    and all but the last are full.

    A null or empty text is its end id alone. Rows that repeat, and ids that do, are documents of their own;
    a null doc_id stays null, and doc_id may be of any type. An empty table gives no pieces; other columns
    are ignored. The stream follows the tasks of the scan, so another split of the input gives another
    order. Both files have the same path on all nodes.
    """
    made = Stream(docs, length, vocabulary, ranks, end).pieces()
    return made.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def sequences(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, ranks: str | None = RANKS, end: int = END) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens before padding, ids. Cases are those of `pack`."""
    return Stream(docs, length, vocabulary, ranks, end).sequences()
