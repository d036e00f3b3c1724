"""Secret scans: fixed patterns plus dictionary-primed zstandard novelty.

The fixed patterns give the base spans. The method adds spans. Words are counted over the whole corpus, and
a zstandard dictionary is fitted on names made of the commonest: it holds them, and the codes of letters as
names use them. A string in a sensitive context is compressed together with the text around it, under that
dictionary; what it adds to the compressed size, for each of its characters, is its novelty. Identifiers,
repeated strings and prose add little, also where their words are unknown; random keys cannot be compressed.
What separates the two, at a length and for a mix of characters, is measured on names made of the corpus's
own words, in the dictionary and out of it, and on random strings, so it follows the corpus.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from statistics import median

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Fixed patterns of the contract (letters of the first in either case), and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a run of 20 or more: as AKIA[A-Z0-9]+ with shorter ones dropped
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "novel")

#: Words that make what stands near them sensitive, how far they reach on either side, and a candidate's
#: least length (a documented bound of the method: shorter strings cannot be told from words).
SENSITIVE = re.compile(r"pass(?:word|wd|phrase|code)|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|authorization|bearer|signature|client[ _-]?id|pwd", re.IGNORECASE | re.ASCII)
REACH, LEAST = 64, 10
RUN = re.compile(r"[!-~]+")
EDGES = string.punctuation
#: What looks random by its grammar alone: dates and times, UUIDs, addresses of mail. Of an address with a scheme only a password in it counts.
ORDINARY = re.compile(r"\d{4}-\d\d-\d\d(?:[T_]\d\d:?\d\d(?::?\d\d)?(?:[.,]\d+)?(?:Z|[+-]\d\d:?\d\d)?)?|[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}|[\w.+-]+@[\w-]+(?:\.[\w-]+)+", re.ASCII)
ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]{0,15}://(?:[^/@:]*:([^/@]+)@)?", re.ASCII)
#: Kinds of characters, of which a candidate has two at least: lower case, upper case within, digits, symbols within.
CLASSES = (re.compile(r"[a-z]"), re.compile(r"(?<=.)[A-Z]"), re.compile(r"[0-9]"), re.compile(r"[^A-Za-z0-9]"))
LETTER = re.compile(r"[A-Za-z]")  # dates and numbers are none
#: Characters on either side that a string is compressed with: the middle of what these give is its novelty.
AROUND = (64, 144, 256)
#: Words of the dictionary, and pieces of a string that are looked up in it: a string that is for KNOWN of its characters such words is an identifier.
PARTS, KNOWN = 4_000, 0.5
COMMON = 250_000
PIECE = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")
LEVEL = 9
#: Strings of either sort that thresholds are measured on, by length in steps of STEP up to LONGEST, and what
#: a name reported weighs against a key missed.
TRIALS, STEP, LONGEST, WRONG = 96, 4, 48, 1
#: Names that the zstandard dictionary is fitted on, and its bytes.
NAMES, SIZE = 2_000, 32_768
#: Common words of code, in the dictionary of any corpus.
CODE_WORDS = (
    "abc account add admin api app application array auth authentication authorization base bean build bytes cache call class client code color command config "
    "connection container content context controller convert count create credential current data database date debug default delete dev dict directory domain "
    "edition element email enable encode endpoint entity entry env environment error event example export factory field file filter format function generate get "
    "group handle handler hash header helper home host html http https image import index info init input instance interface item json key label language level "
    "library link list load local location log login main manager map message method mode model module name node null number object option order output page param "
    "password path person phone policy port preferences print private process profile project property provider public query read record region register remote "
    "repository request reset resource response result return role route rule run save schema script search secret select send serial server service session set "
    "settings share sign size sort source start state static status storage store stream string system table tag target task temp template test text theme time "
    "title token transaction type update upload uri url user username usr util utils validate value var verify version view web widget window word words worker write www"
)


#: Sequences that are no keys though they look like none of the words.
SEQUENCES = "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 abcdefghijklmnopqrstuvwxyz0123456789 00000000000000000000000000000000 xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx "


def mix(s: str) -> int:
    """0: letters alone, 1: digits too, 2: symbols too."""
    return 2 if CLASSES[3].search(s) else 1 if CLASSES[2].search(s) else 0


def made(rng: random.Random, words: list[str], length: int, kind: int) -> str:
    """A name of a length and mix of characters, as code and configurations spell them."""
    name = rng.choice(words)
    while len(name) < length:
        joint = "" if kind == 0 or kind == 2 and rng.random() < 0.3 else str(rng.randrange(100)) if kind == 1 and rng.random() < 0.5 else ""
        if kind == 2 and rng.random() < 0.7:
            joint = rng.choice("_-/.") + joint
        word = rng.choice(words)
        name += joint + (word if joint and kind == 2 else word.capitalize())
    return name[:length]


class Novelty:
    """Marginal compressed bytes of a string within its surroundings, and from where it is novel.

    `parts` are the corpus's commonest words, most common first: the dictionary is fitted on the first PARTS,
    and the bounds are measured on names of which every other is made of the words after those, if there are any."""

    def __init__(self, parts: list[str] = (), level: int = LEVEL, fitted: tuple[bytes, list[list[float]]] | None = None):
        self.parts, self.level = list(parts), level
        words = [*self.parts[:PARTS], *CODE_WORDS.split()]
        self.known = {w.lower() for w in words}
        self.primer = fitted[0] if fitted else self.fit(words)
        primer = zstandard.ZstdCompressionDict(self.primer, dict_type=zstandard.DICT_TYPE_FULLDICT)
        self.squeeze = zstandard.ZstdCompressor(level=level, dict_data=primer, write_checksum=False, write_content_size=False, write_dict_id=False).compress
        self.bounds = fitted[1] if fitted else self.measured(words, self.parts[PARTS:] or words)

    def __reduce__(self):
        return Novelty, (self.parts, self.level, (self.primer, self.bounds))

    @staticmethod
    def fit(words: list[str]) -> bytes:
        """A zstandard dictionary of names among words; the same for the same words."""
        rng = random.Random(0)
        names = [" ".join([*rng.choices(words, k=20), made(rng, words, 24, i % 3)]).encode() for i in range(NAMES)]
        return zstandard.train_dictionary(SIZE, names, k=256, d=8, level=LEVEL).as_bytes()

    def of(self, text: str, start: int, end: int) -> float:
        s, added = text[start:end].encode("utf-8", "replace"), []
        for reach in AROUND:
            around = (SEQUENCES + text[max(0, start - reach) : start] + "\n" + text[end : end + reach] + "\n").encode("utf-8", "replace")
            added.append(len(self.squeeze(around + s)) - len(self.squeeze(around)))
        return median(added) / (end - start)

    def measured(self, words: list[str], others: list[str]) -> list[list[float]]:
        """For each mix of characters and length the bound that tells names from random strings with the least error."""
        rng = random.Random(0)
        letters, digits, symbols = string.ascii_letters, string.digits, "!@#$%^&*-_+"
        out: list[list[float]] = []
        for kind, alphabet in enumerate((letters, letters + digits, letters + digits + symbols)):
            out.append([])
            for length in range(LEAST, LONGEST + 1, STEP):
                found: tuple[list[float], list[float]] = ([], [])
                for i in range(TRIALS):
                    left, right = (" ".join(rng.choices(words, k=40)) for _ in range(2))
                    for side, s in zip(found, (made(rng, (words, others)[i % 2], length, kind), "".join(rng.choices(alphabet, k=length))), strict=True):
                        side.append(self.of(f"{left} {s} {right}", len(left) + 1, len(left) + 1 + length))
                names, keys = map(sorted, found)
                error = lambda b: WRONG * (TRIALS - bisect_left(names, b)) + bisect_left(keys, b)  # noqa: B023, E731
                out[-1].append(min(sorted({*names, *keys}), key=error))
        return out

    def novel(self, text: str, start: int, end: int) -> bool:
        s = text[start:end]
        if sum(len(p) for p in PIECE.findall(s) if p.lower() in self.known) >= KNOWN * len(s):
            return False
        bounds = self.bounds[mix(s)]
        return self.of(text, start, end) >= bounds[min((len(s) - LEAST) // STEP, len(bounds) - 1)]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the fixed patterns, by start and kind."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Strings of printable characters of several kinds, a letter among them, near a sensitive word (or after one within the same
    run), without the punctuation at their ends. Linear in the text: each run is looked at once."""
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    starts, out = [a for a, _ in words], []
    for run in RUN.finditer(text):
        a, b = run.span()
        k = bisect_left(starts, b)  # words before k begin before the run's end
        near = k < len(words) and words[k][0] - b <= REACH
        if k:
            end = words[k - 1][1]
            near |= a - end <= REACH
            if end > a:  # within the run: what follows it is the string
                a = end
                while a < b and text[a] in "-_/":
                    a += 1
        if not near or b - a < LEAST:
            continue
        if address := ADDRESS.match(text, a, b):
            a, b = address.span(1)
        while a < b and text[a] in EDGES:
            a += 1
        while a < b and text[b - 1] in EDGES:
            b -= 1
        if b - a < LEAST:
            continue
        s = text[a:b]  # kinds are looked for in it alone: what stands before it says nothing of it
        if LETTER.search(s) and sum(bool(c.search(s)) for c in CLASSES) > 1 and not ORDINARY.fullmatch(s):
            out.append((a, b))
    return out


def novel_spans(text: str, base: list[tuple[int, int, int]], measure: Novelty) -> list[tuple[int, int, int]]:
    """Candidates that are novel and touch no base span."""
    starts = [a for a, _, _ in base]
    reached = list(accumulate((b for _, b, _ in base), max))
    out = []
    for a, b in candidates(text):
        k = bisect_left(starts, b)
        if not (k and reached[k - 1] > a) and measure.novel(text, a, b):
            out.append((a, b, 3))
    return out


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scan_text(text: str | None, measure: Novelty) -> tuple[int, int, int, str, str]:
    """(n_assign, n_access, n_hex, base_sha256, spans) of one whole text; null counts as empty."""
    text = text or ""
    base = base_spans(text)
    spans = sorted(base + novel_spans(text, base, measure), key=lambda x: (x[0], x[2]))
    n = [sum(k == i for _, _, k in base) for i in range(3)]
    return (*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, n): words of ASCII letters with their counts, summed up as far as a task's memory allows."""
    found: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["part", "n"])
        found.clear()
        return rows

    for batch in batches:
        for text in batch.column(0):
            found.update(re.findall(r"[A-Za-z]{3,}", text.as_py() or ""))
            if len(found) > 200_000:
                yield out()
    yield out()


def learn(docs: DataFrame, most: int = PARTS) -> Novelty:
    """The measure with the `most` commonest words (as they are spelt) of all documents, and as many after those
    to measure bounds on: a dictionary's size is bounded by what it is for. Only words that occur twice, and once in COMMON words, count (so that
    COMMON at most are ordered, however many there are); ties go by the word."""
    counts = cut(docs.select("text").mapInArrow(_parts, "part string, n long").groupBy("part").agg(F.sum("n").alias("n")), "words")
    every = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.where((F.col("n") > 1) & (F.col("n") >= every / COMMON) & (F.length("part") <= 64))
    rows = common.orderBy(F.desc("n"), "part").limit(2 * most).collect()
    return Novelty([r.part for r in rows])


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then kind (assign, access,
    hex, novel), comma-joined; base_sha256 digests the base spans alone. Null and empty texts have
    none. Whole texts are scanned. Repeated rows get equal results; an empty table gives an empty
    result; other columns are ignored.
    """
    measure = learn(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = [scan_text(t.as_py(), measure) for t in part.column(1)]
                if rows:
                    a, b, c, d, e = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in (a, b, c)), pa.array(d), pa.array(e)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
