"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context windows.

The lexicon is learned: terms that occur in many contexts of toxic documents and in few
others. Its trie is intersected with the Levenshtein automata of its terms (swapped neighbours count as
one edit) into one deterministic automaton: the subset construction over trie node and edits, done for
the states that the words of a corpus reach. It runs over all words of a chunk at once. Hits are weighed
by edits and by context: a window in which terms crowd counts more, a hit between paired quotation marks
is counted apart. A logistic model over these measures gives the score.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chars import code_points, letter_table
from .common import cut, held_out, text_chunks
from .quality import labelled_sample, with_score

#: Documented bound: labelled rows that lexicon and weights are fitted on.
FIT_ROWS = 20_000
#: Contexts that a term has at least, and the share of them that is toxic; what else speaks for or against a
#: document is left to the weights.
MIN_CONTEXTS, PURE = 3, 0.8
#: Letters of a term at least, and states that a task keeps before it begins anew.
LEAST, STATES = 4, 1 << 17
WINDOW = 50
#: Weights of a hit with an edit and of a quoted hit; stems' lengths, and words that a stem must have.
NEAR, QUOTED = 0.7, 0.25
STEM, STEM_WORDS = (4, 6), 3
#: Bound of the chance that any term at all gets into the lexicon by accident.
CHANCE = 0.01
THRESHOLD = 0.5
#: Quotation marks (code points) of one kind, which pair with each other, and how far they reach.
QUOTES = ((0x22,), (0xAB, 0xBB), (0x201C, 0x201D, 0x201E))
QUOTE_REACH = 600


def edits(term: str) -> int:
    """Edits allowed for a term: none below 5 letters, one below 8, else two."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Automaton:
    """Accepts all words within edits(term) of a term, or, for a stem (written stem*), whose beginning
    is; `found` gives per state -1 or the least edits.

    A state is a set of (place, edits): a place is a trie node, or -1 - node while a swap is under way that
    ends at node. Rows of the table are filled when a word first needs them (-1: not yet)."""

    def __init__(self, terms: list[str]):
        self.source = list(terms)
        stems = {t[:-1] for t in terms if t.endswith("*")}
        self.terms = sorted({t.rstrip("*") for t in terms})
        letters = sorted({ord(c) for t in self.terms for c in t})
        self.code = np.zeros(65536, np.int32)  # 0: a letter of no term
        for i, c in enumerate(letters):
            self.code[c] = i + 1
        self.width = len(letters) + 1
        self.child: list[dict[int, int]] = [{}]
        self.most, self.ends, self.open_end, self.before = [0], [-1], [False], [0]
        for t in self.terms:
            node, k, label = 0, edits(t), 0
            self.most[0] = max(self.most[0], k)
            for c in t:
                i = int(self.code[ord(c)])
                if i not in self.child[node]:
                    self.child[node][i] = len(self.child)
                    self.child.append({})
                    self.most.append(0)
                    self.ends.append(-1)
                    self.open_end.append(False)
                    self.before.append(label)  # the label above the node's own
                node, label = self.child[node][i], i
                self.most[node] = max(self.most[node], k)
            self.ends[node], self.open_end[node] = k, t in stems
        self.clear()

    def __reduce__(self):
        return Automaton, (self.source,)

    def clear(self) -> None:
        self.states: list[frozenset] = [frozenset(), self.closed({0: 0})]
        self.index = {x: i for i, x in enumerate(self.states)}
        self.table = np.full((64, self.width), -1, np.int32)
        self.found = np.full(64, -1, np.int8)
        self.table[0] = 0

    def closed(self, state: dict[int, int]) -> frozenset:
        todo = list(state.items())
        while todo:
            node, e = todo.pop()
            if node < 0 or state.get(node, 99) < e:
                continue
            for nxt in self.child[node].values():  # a letter of the term is missing
                if e + 1 <= self.most[nxt] and e + 1 < state.get(nxt, 99):
                    state[nxt] = e + 1
                    todo.append((nxt, e + 1))
        return frozenset(state.items())

    def step(self, state: frozenset, c: int) -> frozenset:
        out: dict[int, int] = {}

        def put(place: int, cost: int) -> None:
            if cost < out.get(place, 99):
                out[place] = cost

        for node, e in state:
            if node < 0:  # the second letter of a swap
                if c == self.before[-1 - node]:
                    put(-1 - node, e)
                continue
            if self.open_end[node] and e <= self.ends[node]:  # what follows a stem is free
                put(node, e)
            elif e + 1 <= self.most[node]:  # a letter too many
                put(node, e + 1)
            for i, nxt in self.child[node].items():
                cost = e + (i != c)
                if cost <= self.most[nxt]:
                    put(nxt, cost)
                after = self.child[nxt].get(c)
                if i != c and after is not None and e + 1 <= self.most[after]:  # the first letter of a swap
                    put(-1 - after, e + 1)
        return self.closed(out)

    def number(self, state: frozenset) -> int:
        if state not in self.index:
            k = len(self.states)
            if k == len(self.table):
                self.table = np.vstack([self.table, np.full_like(self.table, -1)])
                self.found = np.append(self.found, np.full_like(self.found, -1))
            self.index[state] = k
            self.states.append(state)
            self.found[k] = min((e for node, e in state if node >= 0 and self.ends[node] >= e), default=-1)
        return self.index[state]

    def next(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        out = self.table[state, code]
        todo = np.flatnonzero(out < 0)
        if len(todo):
            for pair in np.unique(state[todo].astype(np.int64) * self.width + code[todo]).tolist():
                s, c = divmod(pair, self.width)
                k = self.number(self.step(self.states[s], c))  # the table may grow here
                self.table[s, c] = k
            out = self.table[state, code]
        return out

    def run(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Least edits of each word to a term, or -1."""
        if len(self.states) > STATES:
            self.clear()
        out = np.full(len(starts), -1, np.int8)
        live = np.flatnonzero(lengths >= LEAST)
        state, at = np.full(len(live), 1, np.int32), 0
        while len(live):
            over = lengths[live] == at
            out[live[over]] = self.found[state[over]]
            go = ~over & (state > 0)
            live, state = live[go], state[go]
            state = self.next(state, codes[starts[live] + at])
            at += 1
        return out


def quoted_spans(cp: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of marks the places of opening marks and of the closing marks that end their quotation:
    the next mark of the kind, at most QUOTE_REACH on in the same document. A mark opens if what stands
    before it is no part of a word and what follows is; the other way round it closes; low and left
    marks open and right ones close in any case where their shape is no evidence against it. A mark
    without a partner (an inch mark, say) quotes nothing."""
    out = []
    for kind in QUOTES:
        k = np.flatnonzero(np.isin(cp, np.array(kind, np.uint16)))
        if not len(k):
            continue
        doc = np.searchsorted(at, k, "right")
        table = _space_table()
        free_before = (k == at[doc - 1]) | table[cp[k - 1]] | np.isin(cp[k - 1], _BRACKETS)
        free_after = (k + 1 >= at[doc]) | table[cp[np.minimum(k + 1, len(cp) - 1)]]
        opens = free_before & ~free_after
        closes = ~free_before | free_after
        both = free_before & free_after  # « so »
        opens |= both & np.isin(cp[k], np.array((0xAB, 0x201E, 0x201C), np.uint16))
        closes &= ~opens
        pair = np.flatnonzero(opens[:-1] & closes[1:] & (doc[1:] == doc[:-1]) & (k[1:] - k[:-1] <= QUOTE_REACH))
        out.append((k[pair], k[pair + 1]))
    return out


#: Characters after which a mark may open: brackets, dashes, colons.
_BRACKETS = np.array([ord(c) for c in "([{<:-\u2013\u2014"], np.uint16)


def letter_words(data: np.ndarray, offsets: np.ndarray):
    """Letters (lower case, 0 elsewhere), their offsets, raw code points, and starts and lengths of
    the maximal runs of letters, with the first run of each document."""
    cp, at = code_points(data, offsets)
    low = letter_table()[cp]
    solid = low > 0
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = at[:-1][at[:-1] < at[1:]]
    first[inner] = solid[inner]
    starts = np.flatnonzero(first)
    stop = np.ones(len(solid) + 1, bool)
    stop[:-1] = ~solid | first
    ends_at = np.flatnonzero(stop)
    lengths = ends_at[np.searchsorted(ends_at, starts, "right")] - starts if len(starts) else np.zeros(0, np.int64)
    return low, at, cp, starts, lengths, np.searchsorted(starts, at)


@functools.cache
def _space_table() -> np.ndarray:
    return np.array([chr(c).isspace() for c in range(65536)])


def disguised(low: np.ndarray, at: np.ndarray, cp: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Words written with digits or symbols inside or with stretched letters: letters, starts and lengths
    of their plain spelling, and the first letter run of each and the run after its last. A plain spelling
    leaves out what is no letter (so a replaced letter is one edit) and repeats in runs of three or more."""
    if not len(starts):
        return low[:0], starts, lengths, starts, starts
    space = np.concatenate([[0], np.cumsum(_space_table()[cp])])
    doc = np.searchsorted(at, starts, "right")
    head = np.ones(len(starts), bool)
    head[1:] = (space[starts[1:]] != space[starts[:-1] + lengths[:-1]]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(head)
    end = np.append(begin[1:], len(starts))
    stretched = np.zeros(len(begin), bool)
    triple = np.flatnonzero((low[2:] > 0) & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]))
    stretched[np.searchsorted(starts[begin], triple, "right") - 1] = True
    chosen = np.flatnonzero(stretched | (end - begin > 1))
    begin, end = begin[chosen], end[chosen]
    runs = np.repeat(begin - np.cumsum(end - begin) + (end - begin), end - begin) + np.arange((end - begin).sum())
    size = lengths[runs]
    index = np.repeat(starts[runs] - np.cumsum(size) + size, size) + np.arange(size.sum())
    word = np.repeat(np.repeat(np.arange(len(begin)), end - begin), size)
    letters = low[index]
    again = np.zeros(len(letters), bool)
    again[1:] = (letters[1:] == letters[:-1]) & (word[1:] == word[:-1])
    run = np.cumsum(~again)
    keep = ~(again & (np.bincount(run)[run] >= 3)) if len(run) else again
    size = np.bincount(word[keep], minlength=len(begin))
    return letters[keep], np.cumsum(size) - size, size, begin, end


MEASURES = ("hits", "crowd", "share", "any", "quoted", "near")


class Model:
    def __init__(self, automaton: Automaton | None, weights: np.ndarray, bias: float):
        self.automaton, self.weights, self.bias = automaton, weights, bias

    def measures(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of MEASURES for each document, each between 0 and about 3."""
        docs = len(offsets) - 1
        low, at, cp, starts, lengths, first = letter_words(data, offsets)
        hit = self.automaton.run(self.automaton.code[low], starts, lengths)
        plain, begin, size, run, after_run = disguised(low, at, cp, starts, lengths)
        if len(run):
            own = np.concatenate([[0], np.cumsum(hit >= 0)])
            new = np.where(own[after_run] == own[run], self.automaton.run(self.automaton.code[plain], begin, size), -1)
            hit[run[new >= 0]] = np.maximum(new[new >= 0], 1)  # a disguise counts as an edit
        k = np.flatnonzero(hit >= 0)
        doc = np.searchsorted(first, k, "right") - 1
        quoted = np.zeros(len(k), bool)
        if len(k):
            for left, right in quoted_spans(cp, at):
                own = np.searchsorted(left, starts[k]) - 1
                quoted |= (own >= 0) & (starts[k] < right[own]) if len(left) else False
        weight = np.where(hit[k] == 0, 1.0, NEAR) * np.where(quoted, QUOTED, 1.0)
        total = np.concatenate([[0.0], np.cumsum(weight)])
        crowd = np.zeros(docs)
        if len(k):
            until = np.searchsorted(k, np.minimum(k + WINDOW, first[doc + 1]))
            np.maximum.at(crowd, doc, total[until] - total[np.arange(len(k))])
        hits, near, q = (np.bincount(doc, m, docs) for m in (np.where(quoted, 0.0, weight), ~quoted & (hit[k] > 0), quoted))
        words = np.maximum(np.diff(first), 1)
        share = 10 * np.minimum(0.2, np.bincount(doc, weight, docs) / words)
        return np.column_stack([np.log1p(hits), np.log1p(crowd), share, np.minimum(hits, 1.0), np.log1p(q), np.log1p(near)])

    def score_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.automaton is None:
            return np.full(len(offsets) - 1, 1 / (1 + np.exp(-self.bias)))
        return 1 / (1 + np.exp(-(self.measures(data, offsets) @ self.weights + self.bias)))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, word before, label) of every word of LEAST letters or more, distinct within a chunk."""
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, data, offsets in text_chunks(batch.column(1), 1 << 20):
            low, _, _, starts, lengths, first = letter_words(data, offsets)
            text = low.astype("<u2").tobytes().decode("utf-16-le")
            rows = set()
            for d in range(hi - lo):
                last, y = "", int(label[lo + d] > 0)
                for w in range(first[d], first[d + 1]):
                    word = text[starts[w] : starts[w] + lengths[w]]
                    if len(word) >= LEAST:
                        rows.add((word, last, y))
                    last = word
            if rows:
                w, p, y = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(p), pa.array(y, pa.int32())], ["word", "before", "y"])


def _measured(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                x = model.measures(data, offsets)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], flat], ["label", "x"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Newton's method for a ridge-penalised logistic model; the bias is not penalised."""
    a = np.column_stack([x, np.ones(len(x))])
    w, pen = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
    pen[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(pen * len(x) / 100 + 1e-6)
        move = np.linalg.solve(h, a.T @ (y - p) - pen * len(x) / 100 * w)
        w += np.clip(move, -3, 3)
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def choose_terms(seen: DataFrame, share: float, words: int) -> list[str]:
    """Terms and stems of (word, before, y) contexts that occur in toxic contexts for the most part, and in
    so many that chance (the toxic share of all contexts, over all words) does not explain it. Contexts
    are counted, not documents: copies of one text repeat its contexts. Words of a chosen stem go. All that
    pass are kept; the sample bounds their number."""
    if not 0 < share < 1:
        return []
    least = max(MIN_CONTEXTS, int(np.ceil((np.log(max(words, 1)) - np.log(CHANCE)) / -np.log(share))))
    picked = lambda df: df.where((F.col("bad") >= least) & (F.col("bad") >= PURE * F.col("all")))
    counts = seen.groupBy("word").agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("all"))
    stems = counts.select(F.explode(F.array(*[F.when(F.length("word") > k, F.substring("word", 1, k)) for k in range(STEM[0], STEM[1] + 1)])).alias("stem"), "bad", "all").where("stem is not null")
    stems = stems.groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("all").alias("all"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= STEM_WORDS)
    set_found = set(found := sorted(r.stem for r in picked(stems).select("stem").collect()))
    short = [s for s in found if not any(s[:k] in set_found for k in range(STEM[0], len(s)))]
    alone = sorted(r.word for r in picked(counts).select("word").collect())
    return [s + "*" for s in short] + [w for w in alone if not any(w[:k] in set_found for k in range(STEM[0], STEM[1] + 1))]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = FIT_ROWS) -> Model:
    sample = cut(labelled_sample(docs, labels, label, most), "fit")  # one scan of the corpus for all that follows
    seen = cut(sample.mapInArrow(_contexts, "word string, before string, y int").distinct(), "contexts")
    total = seen.agg(F.avg("y").alias("p"), F.count_distinct("word").alias("n")).first()
    lexicon = choose_terms(seen, total.p or 0.0, total.n or 0)
    share = sample.agg(F.sum((F.col("label") > 0).cast("int")), F.count(F.lit(1))).first()
    prior = ((share[0] or 0) + 1) / (share[1] + 2)
    if not lexicon:
        return Model(None, np.zeros(len(MEASURES)), float(np.log(prior / (1 - prior))) if share[1] else 0.0)
    model = Model(Automaton(lexicon), np.zeros(len(MEASURES)), 0.0)
    rows = sample.mapInArrow(_measured(model), "label double, x array<double>").toArrow().combine_chunks()
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
    y = (rows.column("label").to_numpy() > 0).astype(np.float64)
    order = np.lexsort([*x.T, y])
    model.weights, model.bias = logistic(x[order], y[order])
    return model


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    Learns from labels of documents that are not held out; scores use the whole text alone. Null and
    empty texts have no hits and get the model's lowest score. Null labels and labels of unknown
    documents are ignored; without labels every score is 0.5, without a lexicon the share of toxic
    labels. Repeated rows get equal scores; an empty table gives an empty result.
    """
    own = docs.select("doc_id", "text")
    scored = with_score(own, train(own, labels, label))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
