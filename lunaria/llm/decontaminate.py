"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Test items are taken in blocks of bounded size (one block for any usual benchmark), one after another,
and a block is broadcast. A first pass over all documents counts in how many each word n-gram of the
block occurs. An item's seeds are its rare n-grams: those below a share of the corpus, and in any case
its rarer half, so that a passage which is itself common keeps its seeds. A second pass finds seeds in
each document, chains them by diagonal, leaves out windows that hold too few of the item's words, and
aligns item and passage; no text is shuffled. Each block's findings are written, so neither the driver
nor a task ever holds two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import alnum_words
from .common import cut, fresh, grams, text_chunks

SEED_WORDS = 3
RARE = 1e-3
#: Words of items in a block (8 bytes each): the proven bound of what is broadcast.
BLOCK_WORDS = 500_000
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words (pairs x passage) that are aligned at once; a longer passage is aligned alone.
CELLS = 1 << 19
#: Share of an item's best possible score from which a document is contaminated; items below
#: SHORT words must match in full.
SIMILARITY, SHORT = 0.6, 8


def align(items: np.ndarray, passages: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman with linear gaps for a batch of pairs: (best score, passage word where it ends).

    items (pairs, m) and passages (pairs, w) hold word hashes; words from lengths on never match.
    Gaps along the passage come from a running maximum, so each item word costs a few array steps.
    """
    pairs, w = passages.shape
    drop = -GAP * np.arange(w, dtype=np.int32)
    beyond = np.arange(w)[None, :] >= lengths[:, None]
    h = np.zeros((pairs, w + 1), np.int32)
    best, at = np.zeros(pairs, np.int32), np.zeros(pairs, np.int64)
    for i in range(items.shape[1]):
        s = np.where((passages == items[:, i : i + 1]) & ~beyond, MATCH, MISMATCH)
        t = np.maximum(np.maximum(h[:, :-1] + s, h[:, 1:] + GAP), 0)
        t = np.maximum.accumulate(t + drop, axis=1) - drop
        h[:, 1:] = t
        top = t.argmax(1)
        v = t[np.arange(pairs), top]
        better = v > best
        best[better], at[better] = v[better], top[better]
    return best, at


class Block:
    """Items as word hashes, and their n-grams: sorted distinct values with (item, position) lists."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids, self.words = [], []
        for _, _, data, offsets in text_chunks(pa.array(texts, pa.string())):
            hashes, first = alnum_words(data, offsets)
            self.words += [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.ids = list(ids)
        own = [grams(w, min(SEED_WORDS, len(w))) if len(w) else w for w in self.words]
        self.all = np.concatenate(own) if own else np.zeros(0, np.uint64)
        self.item = np.repeat(np.arange(len(own)), [len(x) for x in own])
        self.position = np.concatenate([np.arange(len(x)) for x in own]) if own else np.zeros(0, np.int64)
        self.sizes = sorted({min(SEED_WORDS, len(w)) for w in self.words if len(w)})
        self.values = np.unique(self.all)
        flat = np.concatenate(self.words) if self.words else np.zeros(0, np.uint64)
        self.vocabulary, code = np.unique(flat, return_inverse=True)
        self.codes = np.split(code, np.cumsum([len(w) for w in self.words])[:-1]) if self.words else []
        self.mark = np.zeros(len(self.vocabulary), bool)

    def find(self, hashes: np.ndarray, first: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, word position, index in values) of every n-gram of the documents among values."""
        out = []
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for n in self.sizes:
            g = grams(hashes, n)
            if not len(g) or not len(values):
                continue
            k = np.minimum(np.searchsorted(values, g), len(values) - 1)
            at = np.flatnonzero(values[k] == g)
            at = at[doc[at] == doc[at + n - 1]]
            out.append((doc[at], at, k[at]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3

    def keep_rare(self, frequency: np.ndarray, docs: int) -> None:
        """Leaves the seeds: frequency (in documents) is by index in values."""
        f = frequency[np.searchsorted(self.values, self.all)]
        limit = np.zeros(len(self.words))
        for i in range(len(self.words)):
            mine = f[np.searchsorted(self.item, i) : np.searchsorted(self.item, i, "right")]
            limit[i] = max(RARE * docs, np.median(mine)) if len(mine) else 0
        keep = f <= limit[self.item]
        order = np.argsort(self.all[keep], kind="stable")
        self.item, self.position = self.item[keep][order], self.position[keep][order]
        self.seeds, start = np.unique(self.all[keep][order], return_index=True)
        self.seed = np.repeat(np.arange(len(self.seeds)), np.diff(np.append(start, len(order))))

    def reachable(self, item: int, words: np.ndarray) -> bool:
        """Whether the item's words occur in words (places in the vocabulary) so often that the score can
        reach SIMILARITY."""
        self.mark[words] = True
        found = np.count_nonzero(self.mark[self.codes[item]])
        self.mark[words] = False
        return found >= SIMILARITY * len(self.codes[item])

    def windows(self, doc: np.ndarray, at: np.ndarray, k: np.ndarray, low: int, high: int, size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, item, first word, word after the last) of the passages around seed hits (document,
        word, seed) of items low to high - 1."""
        own = np.flatnonzero((self.item >= low) & (self.item < high))  # in the order of seeds
        many = np.bincount(self.seed[own], minlength=len(self.seeds))
        start = np.cumsum(many) - many
        many = many[k]
        which = own[np.repeat(start[k], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        doc, item, diagonal = np.repeat(doc, many), self.item[which], np.repeat(at, many) - self.position[which]
        order = np.lexsort((diagonal, item, doc))
        doc, item, diagonal = doc[order], item[order], diagonal[order]
        # an alignment that reaches SIMILARITY affords this many gaps, so its seeds' diagonals chain and
        # its window holds it whole; one seed is enough
        slack = np.maximum(4, np.ceil(MATCH * (1 - SIMILARITY) * size[item] / -GAP).astype(np.int64))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[1:])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(doc))
        d, it = doc[begin], item[begin]
        return d, it, np.maximum(first[d], diagonal[begin] - slack[begin]), np.minimum(first[d + 1], diagonal[end - 1] + size[it] + slack[begin])

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, float, int]]:
        """(document, item, score, similarity, end word in the document) of contaminated documents."""
        hashes, first = alnum_words(data, offsets)
        doc, at, k = self.find(hashes, first, self.seeds)
        if not len(doc):
            return []
        size = np.array([len(w) for w in self.words])
        # items in ranges, so that the seed hits of one range are bounded
        each = np.bincount(self.item, np.bincount(k, minlength=len(self.seeds))[self.seed], len(self.words))
        ranges = np.unique(np.append(np.floor(np.cumsum(each) / CELLS), -1)[:-1], return_index=True)[1]
        parts = [self.windows(doc, at, k, lo, hi, size, first) for lo, hi in zip(ranges, np.append(ranges[1:], len(self.words)), strict=True)]
        d, it, lo, hi = (np.concatenate(x) for x in zip(*parts, strict=True))
        k = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[k] == hashes)  # words of any item
        k, a, b = k[known], np.searchsorted(known, lo), np.searchsorted(known, hi)
        can = np.array([self.reachable(x, k[y:z]) for x, y, z in zip(it, a, b, strict=True)], bool)
        best: dict[tuple[int, int], tuple[int, float, int]] = {}
        width = hi - lo
        order = np.flatnonzero(can)
        order = order[np.lexsort((width[order], size[it[order]]))]
        for group in np.split(order, np.flatnonzero(np.diff(size[it[order]])) + 1):
            while len(group):  # widths rise, so the last of a batch is its widest
                n = np.arange(1, len(group) + 1)
                most = max(1, int(np.searchsorted(n * width[group], CELLS, "right")))
                g, group = group[:most], group[most:]
                index = lo[g][:, None] + np.arange(int(width[g[-1]]))[None, :]
                passages = hashes[np.minimum(index, len(hashes) - 1)]
                score, stop = align(np.vstack([self.words[x] for x in it[g]]), passages, width[g])
                for x, s, e in zip(g, score.tolist(), stop.tolist(), strict=True):
                    m = int(size[it[x]])
                    share = s / (MATCH * m)
                    if share >= (SIMILARITY if m >= SHORT else 1.0):
                        key = (int(d[x]), int(it[x]))
                        best[key] = max(best.get(key, (0, 0.0, 0)), (s, share, int(lo[x] + e - first[d[x]])))
        return [(*key, *v) for key, v in sorted(best.items())]


def _frequencies(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.values), np.int64)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                doc, _, k = block.find(*alnum_words(data, offsets), block.values)
                pairs = np.unique(doc * len(block.values) + k)
                total += np.bincount(pairs % max(1, len(block.values)), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(total[some])], ["k", "n"])

    return run


def seeded_blocks(docs: DataFrame, items: DataFrame) -> Iterator[Block]:
    """The items in blocks, one at a time, each with its seeds chosen over all documents."""
    fine = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    # code points bound words; a block holds about BLOCK_WORDS of them in expectation
    words = fine.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-words // (2 * BLOCK_WORDS)) or 1
    docs_n = docs.count()
    for p in range(parts):
        rows = sorted(fine.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).collect(), key=lambda r: (r.item_id, r.text))
        block = Block([r.item_id for r in rows], [r.text for r in rows])
        if not len(block.all):
            continue
        found = docs.select("text").mapInArrow(_frequencies(block), "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
        frequency = np.zeros(len(block.values))
        frequency[found.column("k").to_numpy()] = found.column("n").to_numpy()
        block.keep_rare(frequency, docs_n)
        yield block


def _found(block: Block, keys: list[str]):
    """(keys of the document, item_id, score, similarity, end_word) of rows (keys, text)."""
    ids, at = pa.array(block.ids), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(at)):
                if rows := block.hits(data, offsets):
                    d, i, s, q, e = zip(*rows, strict=True)
                    own = [batch.column(k)[lo:hi].take(pa.array(d)) for k in range(at)]
                    yield pa.RecordBatch.from_arrays([*own, ids.take(pa.array(i)), pa.array(s, pa.int32()), pa.array(q), pa.array(e, pa.int32())], [*keys, "item_id", "score", "similarity", "end_word"])

    return run


def _contaminated(docs: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    own = docs.select(*keys, "text")
    kinds = [f"{k} {own.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*kinds, f"item_id {items.schema['item_id'].dataType.simpleString()}", "score int, similarity double, end_word int"])
    out = own.sparkSession.createDataFrame([], schema)
    for block in seeded_blocks(own, items):
        out = out.union(cut(own.mapInArrow(_found(block, keys), schema), "copies"))
    return out


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each row of docs and item that it holds a copy of, exact or edited: doc_id, item_id,
    score, similarity (share of the item's best score), end_word.

    docs(doc_id, text), items(item_id, text). Items with a null id or text, or without words, are
    never found; nor is anything in null or empty texts. Repeated rows of docs repeat their results,
    as do repeated items. No items or no documents give an empty result; other columns are ignored.
    """
    return _contaminated(docs, items, ["doc_id"])


def with_flag(docs: DataFrame, items: DataFrame, column: str = "contaminated") -> DataFrame:
    """docs, all columns and rows unchanged, with a flag: the row holds a copy of an item. What is found
    is named by two hashes of the text, so rows that repeat an id may have different flags."""
    one, two, hit = (fresh(docs, x) for x in ("__h1", "__h2", "__hit"))
    keys = {one: F.xxhash64("text"), two: F.xxhash64(F.lit("again"), "text")}
    bad = cut(_contaminated(docs.select("text").withColumns(keys), items, list(keys)).select(*keys).distinct(), "contaminated")
    # Spark picks the join by the size of what was found
    found = docs.withColumns(keys).join(bad.withColumn(hit, F.lit(True)), list(keys), "left")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(hit, F.lit(False)).alias(column))
