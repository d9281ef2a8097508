"""I-Match fingerprints over randomised lexicon subsets.

Terms are lower-cased runs of word characters. Their document frequencies are counted over all documents, and the lexicon keeps those in a
band of inverse document frequency: neither stop words nor rare ones. A lexicon subset keeps each term with probability
``2**-level``, by a seeded hash. The distinct lexicon terms of a text are sorted, and for each of ``SUBSETS`` subsets the
terms that belong to it are hashed. The ``LEVELS`` levels above the logarithm of the number of terms are used, so that
a subset meets one term or none of most texts, short or long; an edit changes the subsets that met a changed term and no
others. The likeness of two fingerprints is the Dice coefficient of their subsets' hashes at common levels; subsets that
met no term count for neither.

Terms travel as their 64-bit hashes. The lexicon is broadcast: the frequencies of all terms add up to the number of
documents times the mean number of distinct terms in one, so a band from a share ``LOW`` on has at most that mean
divided by ``LOW`` terms, however many documents there are.

Defined cases. A null text counts as empty. A text with fewer than ``LEAST_TERMS`` terms in the band uses all its terms
that are not above it, or all terms if it has only such. A text without terms has the fingerprint "0": alike (1.0) to
the same, 0.0 to any other. Repeated rows and ids are kept, in an order fixed by their texts' hashes; null ids come
last. A single document is its own next. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import packed, text_of

#: The band: shares of the documents that a term occurs in.
LOW, HIGH = 5e-4, 0.1
SUBSETS = 40
LEVELS = 3
LEAST_TERMS = 8
SEED = 42
#: Hashes held before counts are handed on.
FLUSH = 4_000_000
#: Words of which a worker keeps the place in the lexicon, about 150 bytes each; beyond them it starts anew.
KNOWN_WORDS = 400_000
_WORD = re.compile(r"\w+")


class Lexicon(NamedTuple):
    """Sorted hashes of the terms in the band, and of those above it."""

    band: np.ndarray
    above: np.ndarray


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def terms(text: str) -> np.ndarray:
    """Sorted hashes of the distinct terms."""
    words = words_of(text)
    found = np.fromiter(map(_hash, words), dtype=np.uint64, count=len(words))
    found.sort()
    return found


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


_FACTORS = np.random.default_rng(SEED).integers(1 << 62, dtype=np.uint64, size=SUBSETS) * np.uint64(2) + np.uint64(1)


def levels_of(found: np.ndarray) -> np.ndarray:
    """For each term and subset, the highest level at which the term is in the subset: leading zeros of a seeded hash."""
    mixed = found[:, None] * _FACTORS
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)  # fixed value: a common 64-bit mixing constant
    mixed ^= mixed >> np.uint64(32)
    levels = np.zeros(mixed.shape, dtype=np.uint8)
    for level in range(1, 41):
        levels += mixed < np.uint64(1 << (64 - level))
    return levels


class Printer:
    """Fingerprints of texts by one lexicon. Levels are drawn once for every term of the band."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.levels = np.concatenate([levels_of(lexicon.band[at : at + 20_000]) for at in range(0, max(1, len(lexicon.band)), 20_000)])
        self.places: dict[str, int] = {}

    def _place(self, words: set[str]) -> list[int]:
        """Places in the band of the words that are in it."""
        places = self.places
        new = [w for w in words if w not in places]
        if new:
            if len(places) + len(new) > KNOWN_WORDS:
                places.clear()
                new = list(words)
            hashes = np.fromiter(map(_hash, new), dtype=np.uint64, count=len(new))
            at = np.searchsorted(self.lexicon.band, hashes)
            found = _among(hashes, self.lexicon.band)
            places.update(zip(new, np.where(found, at, -1).tolist()))
        return [p for p in map(places.__getitem__, words) if p >= 0]

    def __call__(self, text: str) -> str:
        """Three hexadecimal digits for each level and subset after the lowest level; 000 for a subset that met no term."""
        words = words_of(text)
        places = self._place(words)
        if len(places) >= LEAST_TERMS:
            places.sort()  # by hash, as the band is
            found, levels = self.lexicon.band[places], self.levels[places]
        else:
            every = terms(text)
            found = every[~_among(every, self.lexicon.above)]
            found = found if len(found) else every
            levels = levels_of(found)
        if not len(found):
            return "0"
        level = len(found).bit_length()
        rows, subsets = np.nonzero(levels >= level)
        hashes = [0] * (LEVELS * SUBSETS)
        met = levels[rows, subsets].tolist()
        for term, subset, highest in zip(found[rows].tolist(), subsets.tolist(), met):
            for step in range(min(LEVELS, highest - level + 1)):
                at = step * SUBSETS + subset
                hashes[at] = ((hashes[at] ^ term) * 0x9E3779B97F4A7C15 + 1) & 0xFFFFFFFFFFFFFFFF  # fixed value: a common multiplier
        return f"{level:02x}" + "".join([f"{(h >> 20) % 4095 + 1:03x}" if h else "000" for h in hashes])


@lru_cache(maxsize=2)
def _printer(shared) -> Printer:
    """One per worker process."""
    return Printer(shared.value)


def fingerprint(text: str, lexicon: Lexicon) -> str:
    return Printer(lexicon)(text)


def likeness(a: str, b: str) -> float:
    """From 0 to 1; symmetric, and 1 for equal fingerprints."""
    if a == b:
        return 1.0
    if len(a) < 2 or len(b) < 2:
        return 0.0
    first, other = int(a[:2], 16), int(b[:2], 16)
    width = 3 * SUBSETS
    equal = met = 0
    for level in range(max(first, other), min(first, other) + LEVELS):
        x, y = 2 + (level - first) * width, 2 + (level - other) * width
        for at in range(0, width, 3):
            p, q = a[x + at : x + at + 3], b[y + at : y + at + 3]
            met += (p != "000") + (q != "000")
            equal += p == q != "000"
    return 2 * equal / met if met else 0.0


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many from the front of the next text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def counted() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], names=["term", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            held.append(terms(text or ""))
            size += len(held[-1])
            if size > FLUSH:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def lexicon(documents: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> Lexicon:
    """Counts all terms of all documents; what reaches the driver is bounded by ``low``."""
    texts = documents.select(text_of(F.col(text_col)).alias("text"))
    many = texts.count()
    counts = texts.mapInArrow(_frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    kept = counts.filter(F.col("n") >= low * many).toArrow()
    hashes = kept.column("term").to_numpy().view(np.uint64)
    common = kept.column("n").to_numpy() > high * many
    return Lexicon(np.sort(hashes[~common]), np.sort(hashes[common]))


_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _compared(doc_id, text: str, own: str, following: str, following_print: str, printed: Callable[[str], str]) -> tuple:
    changed = edited(text, following)
    changed_print = own if changed == text else printed(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, own, changed_print, likeness(own, changed_print), likeness(own, following_print)


def _rows(rows: list[tuple], extra: dict[str, tuple[list, pa.DataType]] | None = None) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_COLUMNS)
    arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS)]
    extra = extra or {}
    return pa.RecordBatch.from_arrays([*arrays, *(pa.array(v, k) for v, k in extra.values())], names=[*_COLUMNS, *extra])


def _in_order(shared):
    """Compares each row with the one after it; the ends of a partition are handed on with their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, printed, last = TaskContext.get().partitionId(), _printer(shared), None
        ends: list[tuple] = []

        def out(rows: list[tuple], kinds: list[str], texts: list[str | None]) -> pa.RecordBatch:
            n = len(rows)
            return _rows(rows, {"part": ([part] * n, pa.int32()), "kind": (kinds, pa.string()), "text": (texts, pa.string())})

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                piece = batch.slice(at, 500)
                for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    now = (doc_id, text, printed(text))
                    if last is None:
                        ends.append(now)
                    else:
                        rows.append(_compared(*last, now[1], now[2], printed))
                    last = now
                if rows:
                    yield out(rows, ["done"] * len(rows), [None] * len(rows))
        if last is not None:
            ends.append(last)
            rows = [(d, len(t), None, p, None, None, None) for d, t, p in ends]
            yield out(rows, ["first", "last"], [t for _, t, _ in ends])

    return run


def _across(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["doc_id", "text", "fingerprint", "next_text", "next_fingerprint"]).to_pylist()
            yield _rows([_compared(*r.values(), _printer(shared)) for r in rows])

    return run


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, compared with its edited text and with the next document in descending order of ids."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(lexicon(documents, text_col))
    text = text_of(F.col(text_col))
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = packed(placed.mapInArrow(_in_order(shared), f"{_ROW}, part int, kind string, text string"), "imatch")
    done = found.filter("kind = 'done'").select(_COLUMNS)
    # one row per partition from here on
    parts = found.filter("kind = 'first'").select("part")
    around = F.lead("part").over(Window.orderBy("part"))
    following = parts.select("part", around.alias("next")).join(parts.agg(F.min("part").alias("front")), F.lit(True))
    following = following.select("part", F.coalesce("next", "front").alias("next"))
    firsts = found.filter("kind = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint"))
    ends = found.filter("kind = 'last'").select("part", "doc_id", "text", "fingerprint").join(following, "part").join(firsts, "next")
    return done.unionByName(ends.mapInArrow(_across(shared), _ROW))
