"""Token-ID output in training order: fixed-length sequences in a keyed pseudo-random order.

1. Texts are tokenised once, into a table of ids (end-of-text appended) with a hash of id and text, whose
   order is the stream's: no file, split or cluster changes it, and retries agree with each other.
2. Lengths are summed up by ranges of the hash; a shuffle by range, with each range's start as its first
   row, turns lengths into places in one token stream, which is cut every `length` tokens.
3. A keyed Feistel permutation with cycle-walking sends sequence number to slot: a bijection of
   0..N-1 that needs no sort and no table.
4. Pieces go straight to the range partition of their slot (slot div stride), are sorted there and
   joined; every sequence has the same number of bytes, so slot s of a shard starts at
   (s mod stride) * length * width, and reading can resume at any slot.
"""

from __future__ import annotations

import base64
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, mix

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern that belongs to the vocabulary, and its end-of-text id.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
LENGTH, STRIDE, ROUNDS = 1024, 4096, 6
#: Whole shards that one task writes at most, and tasks from which it writes more than one.
SHARDS, TASKS = 64, 4_000
#: Bits of the hash that lengths are summed up by, and so the most ranges; the least ranges (bits), and bytes of a range.
FINE, MIN_BITS, PART_BYTES = 20, 4, 16 << 20
WIDTH = np.dtype("<u2")


def encoder(path: str = VOCABULARY):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def max_id(path: str = VOCABULARY) -> int:
    with open(path, "rb") as f:
        return max(int(line.split()[1]) for line in f if line.strip())


def token_ids(code, text: str) -> np.ndarray:
    """The ids of a text. Runs of white space that are too long for the encoder's own splitter are
    split by the same pattern outside of it, which gives the same pieces."""
    try:
        return code.encode_to_numpy(text, disallowed_special=())
    except ValueError:
        import regex

        pieces = regex.findall(PATTERN, text)
        return np.array([i for p in pieces for i in code._encode_single_piece(p)], np.uint32)


def permute(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The keyed permutation of 0..n-1 at x: a balanced Feistel network on the smallest even number of
    bits that holds n, applied again to what falls outside (fewer than four times on average)."""
    if n <= 1:
        return np.zeros(len(x), np.uint64)
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> half, v & low
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right + np.uint64((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF), r) & low)
        return (left << half) | right

    out = once(x.astype(np.uint64))
    while len(far := np.flatnonzero(out >= n)):
        out[far] = once(out[far])
    return out


def _tokenise(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, tail = encoder(path), np.array([end], WIDTH).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                out = [token_ids(code, text.as_py() or "").astype(WIDTH).tobytes() + tail for text in piece.column(1)]
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), pa.array(out, pa.binary())], ["doc_id", "h", "tokens"])

    return run


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, place in the stream, tokens) of one part's rows in their order; the first row says where the part starts."""
    at = None
    for batch in batches:
        if at is None:
            at, batch = batch.column(1)[0].as_py(), batch.slice(1)
        if batch.num_rows:
            size = pa.compute.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64) // WIDTH.itemsize
            ends = at + np.cumsum(size)
            at = int(ends[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends - size), batch.column(2)], ["doc_id", "g", "tokens"])


def _pieces(n: int, length: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _starts(batches):
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                size = pa.compute.binary_length(part.column(2)).to_numpy(zero_copy_only=False).astype(np.int64) // WIDTH.itemsize
                g = part.column(1).to_numpy(zero_copy_only=False)
                first, last = g // length, (g + size - 1) // length
                many = last - first + 1
                row = np.repeat(np.arange(len(g)), many)
                seq = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                a = np.maximum(seq * length, g[row])
                b = np.minimum((seq + 1) * length, (g + size)[row])
                texts = part.column(2).to_pylist()
                w = WIDTH.itemsize
                cut_out = [texts[r][x * w : y * w] for r, x, y in zip(row, a - g[row], b - g[row], strict=True)]
                slot = permute(seq, n, key).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array((a - seq * length).astype(np.int32)), part.column(0).take(pa.array(row)), pa.array(cut_out, pa.binary())], ["slot", "at", "doc_id", "piece"])

    return run


def _distinct(ids: list) -> list:
    """ids without repeats, in order of first appearance; ids may be structs or arrays."""
    try:
        return list(dict.fromkeys(ids))
    except TypeError:
        return list({repr(i): i for i in ids}.values())


def _joined(length: int, stride: int, end: int, kind: pa.DataType):
    names = ["slot", "shard", "byte_offset", "n_tokens", "doc_ids", "tokens_crc32", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, pad = length * WIDTH.itemsize, np.array([end], WIDTH).tobytes()
        now, held, owners, rows = None, [], [], []

        def close() -> None:
            data = b"".join(held)
            n = len(data) // WIDTH.itemsize
            data += pad * (length - n)
            rows.append((now, now // stride, now % stride * full, n, _distinct(owners), zlib.crc32(data), data))

        def flush() -> pa.RecordBatch:
            a, b, c, d, e, f, g = zip(*rows, strict=True)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(d, pa.int32()), pa.array(e, pa.list_(kind)), pa.array(f, pa.int64()), pa.array(g, pa.binary())], names)

        for batch in batches:
            for slot, doc, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if slot != now:
                    if now is not None:
                        close()
                    now, held, owners = slot, [], []
                    if len(rows) >= 1000:
                        yield flush()
                held.append(piece)
                owners.append(doc)
        if now is not None:
            close()
        if rows:
            yield flush()

    return run


def training_order(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, stride: int = STRIDE, key: int = 1, end: int = END) -> DataFrame:
    """One row per sequence, in shards of `stride` slots: slot, shard, byte_offset in the shard,
    n_tokens before padding, doc_ids (in order of first appearance), tokens_crc32, tokens (little-endian
    16-bit ids, `length` of them; only the stream's last sequence is padded, with the end id).

    A null or empty text is an end-of-text token alone. Repeated rows are tokenised again each time.
    A null doc_id stays null in doc_ids. An empty table gives an empty result; other columns are
    ignored. The stream's order before the permutation is that of a hash of id and text, so it does not depend
    on files, splits or the cluster; rows of one hash go by their tokens. The vocabulary file has the same path on all nodes; its ids and `end` fit 16 bits, or ValueError is raised. doc_id may be of any type.
    """
    if not 0 <= end < 1 << 16 or max_id(vocabulary) >= 1 << 16:
        raise ValueError(f"{vocabulary}: ids beyond 16 bits")
    field = docs.schema["doc_id"].dataType
    kind = field.simpleString()
    hashed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    made = cut(hashed.mapInArrow(_tokenise(vocabulary, end), f"doc_id {kind}, h long, tokens binary"), "tokens", "zstd")
    fine = made.groupBy(F.shiftright("h", 64 - FINE).alias("f")).agg(F.sum(F.octet_length("tokens") / WIDTH.itemsize).cast("long").alias("n"))
    fine = cut(fine, "lengths")
    total = fine.agg(F.sum("n")).first()[0] or 0
    n = -(-total // length)
    # parts are ranges of the hash, so their number does not change the order
    bits = max(MIN_BITS, min(FINE, (total * WIDTH.itemsize // PART_BYTES).bit_length()))
    part = F.shiftright("h", 64 - bits) + F.lit(1 << (bits - 1))
    every = docs.sparkSession.range(1 << bits).select(F.col("id").alias("part"))
    sizes = fine.groupBy((F.shiftright("f", FINE - bits) + F.lit(1 << (bits - 1))).alias("part")).agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    starts = every.join(sizes, "part", "left").select(F.lit(None).cast(field).alias("doc_id"), F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("h"), F.lit(None).cast("binary").alias("tokens"), F.col("part"))
    # each part's start goes with its rows through the one shuffle, before them
    whole = made.withColumn("part", part).unionByName(starts).repartitionById(1 << bits, F.col("part").cast("int"))
    placed = whole.sortWithinPartitions(F.col("tokens").isNotNull(), "h", "tokens").select("doc_id", "h", "tokens")
    pieces = placed.mapInArrow(_pieces(n, length, key), f"slot long, at int, doc_id {kind}, piece binary")
    shards = max(1, -(-n // stride))
    each = min(SHARDS, -(-shards // TASKS))
    dealt = pieces.repartitionById(-(-shards // each), F.expr(f"cast(slot div {stride * each} as int)")).sortWithinPartitions("slot", "at")
    arrow = to_arrow_type(field)
    return dealt.mapInArrow(_joined(length, stride, end, arrow), f"slot long, shard long, byte_offset long, n_tokens int, doc_ids array<{kind}>, tokens_crc32 long, tokens binary")


def write_shards(sequences: DataFrame, folder: str) -> DataFrame:
    """Writes one file shard-<k>.bin per shard into a folder that all nodes mount, and gives the manifest
    (shard, first_slot, n_sequences, bytes). A file appears whole, by renaming, so a retried task
    overwrites it with the same bytes. All shards are written; reading can resume at any slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, temp, rows = None, None, "", []
        for batch in batches:
            for k, slot, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if k != shard:
                    if out:
                        out.close()
                        os.replace(temp, f"{folder}/shard-{shard:06d}.bin")
                    shard, temp = k, f"{folder}/.{uuid.uuid4().hex}"
                    out = open(temp, "wb")  # noqa: SIM115
                    rows.append([k, slot, 0, 0])
                out.write(data)
                rows[-1][2] += 1
                rows[-1][3] += len(data)
        if out:
            out.close()
            os.replace(temp, f"{folder}/shard-{shard:06d}.bin")
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["shard", "first_slot", "n_sequences", "bytes"])

    return sequences.select("shard", "slot", "tokens").mapInArrow(run, "shard long, first_slot long, n_sequences long, bytes long")


def read_sequence(folder: str, slot: int, length: int = LENGTH, stride: int = STRIDE) -> np.ndarray:
    """The ids at a slot, by one seek."""
    with open(f"{folder}/shard-{slot // stride:06d}.bin", "rb") as f:
        f.seek(slot % stride * length * WIDTH.itemsize)
        return np.frombuffer(f.read(length * WIDTH.itemsize), WIDTH)
