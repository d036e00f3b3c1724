"""Language identification: multinomial naive Bayes over hashed character n-grams.

A document is a sparse row of slot counts; its scores are the class log priors plus the counts times the
rows of the log-probability matrix (slots x languages) that they name, so the work grows with the distinct
n-grams of a document times the languages, in products of small dense blocks. The matrix is a broadcast;
languages beyond its width are scored in further passes of equal width, so none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import code_points, letter_table
from .common import bounded_sample, cut, held_out, text_chunks

#: Documented bound of the rows that the model is fitted on.
FIT_ROWS = 20_000
#: Languages that one broadcast holds (with SLOTS, 4 bytes each, its bound); more are scored in turn.
LANGUAGES = 256
#: Documents whose n-grams are counted together, and n-grams a document from which a table of all slots is cheaper.
GROUP, DENSE = 32, 400
#: Distinct slots of a document that are multiplied at once.
ROWS = 1 << 12
SLOTS = 1 << 15
ORDERS = (1, 2, 3)
SMOOTH = 0.5
UNKNOWN = "und"


def slots(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each order the hashed slot of every character position (SLOTS where the n-gram leaves its
    document or holds no letter), the documents' offsets, and the letters' flags. All that is no
    letter counts as one space."""
    cp, at = code_points(data, offsets)
    c = letter_table()[cp]
    letter = c > 0
    x = c.astype(np.uint32)
    size = len(x)
    end = np.repeat(at[1:], np.diff(at))
    place = np.arange(size)
    found, h, any_letter = [], np.zeros(size, np.uint32), np.zeros(size, bool)
    for n in range(1, max(ORDERS) + 1):
        nxt = np.zeros(size, np.uint32)
        nxt[: size - n + 1] = x[n - 1 :]
        has = np.zeros(size, bool)
        has[: size - n + 1] = letter[n - 1 :]
        h = (h ^ nxt) * np.uint32(0x9E3779B1) + np.uint32(n)
        h ^= h >> np.uint32(15)
        any_letter = any_letter | has
        if n in ORDERS:
            found.append(np.where((place + n <= end) & any_letter, (h * np.uint32(0x85EBCA6B)) >> np.uint32(17), SLOTS).astype(np.int32))
    return found, at, letter


def sparse(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, slot, count) of the distinct slots of a chunk's documents, by document; the number of
    n-grams of each; and whether it has a letter."""
    found, at, letter = slots(data, offsets)
    docs = len(at) - 1
    parts = []
    for a in range(0, docs, GROUP):
        b = min(a + GROUP, docs)
        of = np.repeat(np.arange(b - a, dtype=np.int32) * SLOTS, np.diff(at[a : b + 1]))
        own = [x[at[a] : at[b]] for x in found]
        own = np.concatenate([(of + x)[x < SLOTS] for x in own])
        if len(own) > DENSE * (b - a):  # counted in a table, or, where that would be mostly empty, sorted: the same numbers
            table = np.bincount(own, minlength=(b - a) * SLOTS)
            keys = np.flatnonzero(table)
            count = table[keys]
        else:
            keys, count = np.unique(own, return_counts=True)
        parts.append((keys // SLOTS + a, keys % SLOTS, count))
    doc, slot, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    letters = np.concatenate([[0], np.cumsum(letter)])
    some = letters[at[1:]] > letters[at[:-1]]
    for i in np.flatnonzero(~some & (np.diff(offsets) > 0)):  # letters beyond the basic plane count too
        own = data[offsets[i] : offsets[i + 1]]
        some[i] = bool((own >= 0xF0).any()) and any(c.isalpha() for c in own.tobytes().decode("utf-8", "replace"))
    return doc, slot, count, np.bincount(doc, count, docs), some


class Model:
    """languages in order, their log priors, and a matrix (SLOTS, languages) of log probabilities."""

    def __init__(self, languages: list[str], matrix: np.ndarray, prior: np.ndarray):
        self.languages, self.matrix, self.prior = languages, matrix, prior

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log scores (documents, languages), tempered ones, documents with a letter): the prior plus the
        n-grams' log probabilities, which decides; and the same with n-grams that count as at most 50
        independent ones, for a share that tells sure decisions from unsure ones."""
        doc, slot, count, used, some = sparse(data, offsets)
        total = np.zeros((len(used), len(self.languages)))
        weight = count.astype(np.float32)
        first = np.searchsorted(doc, np.arange(len(used) + 1))
        for i in np.flatnonzero(np.diff(first)):
            for a in range(first[i], first[i + 1], ROWS):  # a long document's slots in blocks
                part = slice(a, min(a + ROWS, first[i + 1]))
                total[i] += weight[part] @ self.matrix[slot[part]]
        return total + self.prior, total * np.minimum(1.0, 50 / np.maximum(used, 1))[:, None] + self.prior, some


def best_of(scores: np.ndarray, tempered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per document the best column, its score, its tempered score, and the log of the summed exponentials of
    all tempered ones."""
    at, top = scores.argmax(1), tempered.max(1)
    rows = np.arange(len(at))
    return at, scores[rows, at], tempered[rows, at], top + np.log(np.exp(tempered - top[:, None]).sum(1))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n) summed over each chunk."""
    for batch in batches:
        codes = pa.compute.dictionary_encode(batch.column(0))
        names, lang = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi, data, offsets in text_chunks(batch.column(1)):
            doc, slot, count, _, _ = sparse(data, offsets)
            keys, back = np.unique(lang[lo:hi][doc] * SLOTS + slot, return_inverse=True)
            if len(keys):
                yield pa.RecordBatch.from_arrays([names.take(pa.array(keys // SLOTS)), pa.array((keys % SLOTS).astype(np.int32)), pa.array(np.bincount(back, count).astype(np.int64))], ["lang", "slot", "n"])


def train(docs: DataFrame, most: int = FIT_ROWS, width: int = LANGUAGES) -> list[Model]:
    """Counts n-grams of about `most` rows with a language that are not held out; priors are the shares of
    all such rows. One model for every `width` languages, in the order of their names; all of them learn
    from the same sums, by language and slot."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(~held_out())
    sample = bounded_sample(known.select("doc_id", "lang", "text"), "doc_id", most).select("lang", "text").repartition(8)
    found = sorted((r.lang, r["count"]) for r in known.groupBy("lang").count().collect())  # a row a language
    every = sum(n for _, n in found)
    sums = cut(sample.mapInArrow(_counts, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")), "counts")
    out = []
    for a in range(0, len(found), width):
        part = found[a : a + width]
        order = {x: i for i, (x, _) in enumerate(part)}
        rows = sums.where(F.col("lang").between(part[0][0], part[-1][0])).toArrow()  # at most width x SLOTS
        total = np.full((SLOTS, len(part)), SMOOTH)
        lang = np.array([order[x] for x in rows.column("lang").to_pylist()], np.int64)
        total[rows.column("slot").to_numpy(), lang] += rows.column("n").to_numpy()
        matrix = np.log(total / total.sum(0)).astype(np.float32)
        out.append(Model([x for x, _ in part], matrix, np.log(np.array([n for _, n in part]) / every)))
    return out


def identify(docs: DataFrame, width: int = LANGUAGES) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    A text that is null or has no letter gives 'und' and score 0, as do all texts if no language
    could be learned. Whole texts count, however long. Repeated rows get equal results; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    models = train(docs, width=width)
    # one matrix is with a task at a time: with more languages than width, the passes hand on the best so far
    state = docs.select("doc_id", "text", F.lit(UNKNOWN).alias("lang_pred"), *[F.lit(float("-inf")).alias(c) for c in ("best", "top", "all")])
    kind = docs.schema["doc_id"].dataType.simpleString()
    for k, model in enumerate(models):
        last = k == len(models) - 1
        held = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], held=held, last=last) -> Iterator[pa.RecordBatch]:
            model = held.value
            names = np.array(model.languages, dtype=object)
            for batch in batches:
                for lo, hi, data, offsets in text_chunks(batch.column(1)):
                    scores, tempered, some = model.scores(data, offsets)
                    at, best, top, every = best_of(scores, tempered)
                    old, *held_best = (batch.column(i)[lo:hi].to_numpy(zero_copy_only=False) for i in (2, 3, 4, 5))
                    wins = some & (best > held_best[0])
                    name, best, top = np.where(wins, names[at], old), np.where(wins, best, held_best[0]), np.where(wins, top, held_best[1])
                    every = np.where(some, np.logaddexp(every, held_best[2]), -np.inf)
                    cols = [batch.column(0)[lo:hi], *([] if last else [batch.column(1)[lo:hi]]), pa.array(name, pa.string()), pa.array(best), pa.array(top), pa.array(every)]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", *([] if last else ["text"]), "lang_pred", "best", "top", "all"])

        state = state.mapInArrow(run, f"doc_id {kind}, " + ("" if last else "text string, ") + "lang_pred string, best double, top double, all double")
        if not last:
            state = cut(state, "languages")
    score = F.when(F.col("top") > float("-inf"), F.least(F.exp(F.col("top") - F.col("all")), F.lit(1.0))).otherwise(0.0)
    return state.select("doc_id", held_out().alias("held_out"), "lang_pred", score.alias("score"))
