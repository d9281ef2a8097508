"""Periodic runs of words, found with a dictionary of basic factors.

For every power of two L, equal factors of L words get equal names, made from the names of their halves. An occurrence
whose next occurrence lies within 2 L words proposes that distance as a period; occurrences that follow each other at one
distance form an arithmetic progression, of which the first proposes for all. Proposals are extended to both sides by
descending through the names, and equal results are one run.

No run is missed: a run with period q and three periods or more holds, from its first word, a factor of L words (L the
smallest power of two from q on) and its next occurrence, which is q words away and not nearer, as a nearer one would
give the run a smaller period. For the same reason no proposal is a multiple of its run's period.

Work is O(n log n) words at most; levels end as soon as no factor repeats. Documents are worked on together, up to
``BATCH_WORDS`` words or one document at a time; words of different documents have different names, so no factor is shared
between them and none that crosses an end repeats.

Defined cases. Null texts count as empty; empty and blank texts have no words and no run. Words end at the contract's
white space only. Repeated rows and null ids each give their own row. An empty table gives an empty result. Columns other
than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import text_of

MIN_WORDS = 24
MIN_PERIODS = 3
#: Words worked on together, unless one document has more.
BATCH_WORDS = 200_000

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _repeated(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, places and continuation flags of the keys that occur twice or more, by key and then by place."""
    order = np.argsort(keys, kind="stable")
    keys, places = keys[order], places[order]
    same = np.empty(len(keys) + 1, dtype=bool)
    same[0] = same[-1] = False
    np.equal(keys[1:], keys[:-1], out=same[1:-1])
    many = same[1:] | same[:-1]
    follows = same[:-1][many]
    return np.cumsum(~follows) - 1, places[many], follows


def _proposals(places: np.ndarray, follows: np.ndarray, length: int, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of progressions and their differences: successors within twice the length of the factor."""
    gap = np.zeros(len(places), dtype=np.int64)
    gap[:-1] = np.where(follows[1:], places[1:] - places[:-1], 0)
    gap[gap > 2 * length] = 0
    goes_on = np.zeros(len(gap), dtype=bool)
    goes_on[1:] = follows[1:] & (gap[1:] == gap[:-1])
    # the word before proposes the same period for the same run
    scratch[places] = gap
    before = np.where(places > 0, scratch[places - 1], 0)
    first = (gap > 0) & ~goes_on & (before != gap)
    found = places[first], gap[first]
    scratch[places] = 0
    return found


def _extended(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch around each proposal in which words a period apart are equal."""
    size = len(levels[0])
    right = np.zeros(len(at), dtype=np.int64)
    left = np.zeros(len(at), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names, step = levels[k], 1 << k
        a, b = at + right, at + period + right
        here = names[np.minimum(a, size - 1)]
        right += step * ((b < size) & (here >= 0) & (here == names[np.minimum(b, size - 1)]))
        a, b = at - left - step, at + period - left - step
        here = names[np.maximum(a, 0)]
        left += step * ((a >= 0) & (here >= 0) & (here == names[np.maximum(b, 0)]))
    return at - left, at + period + right


def find(words: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (start, length, period) of all runs in a sequence of word numbers, by start and then by period."""
    if min_periods < 3:
        raise ValueError("runs of fewer than three periods may be missed")
    size = len(words)
    levels: list[np.ndarray] = []
    scratch = np.zeros(size, dtype=np.int64)
    keys, places = words.astype(np.int64), np.arange(size)
    starts, periods = [], []
    while len(keys):
        length = 1 << len(levels)
        names, places, follows = _repeated(keys, places)
        if not len(places):
            break
        level = np.full(size, -1, dtype=np.int32)
        level[places] = names
        levels.append(level)
        at, period = _proposals(places, follows, length, scratch)
        starts.append(at)
        periods.append(period)
        places = places[places + length < size]
        places = np.sort(places[level[places + length] >= 0])
        keys = level[places].astype(np.int64) * size + level[places + length]
    at, period = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (starts, periods))
    if not len(at):
        return np.zeros((0, 3), dtype=np.int64)
    begin, end = _extended(levels, at, period)
    long = end - begin >= np.maximum(min_words, min_periods * period)
    found = np.unique(np.stack([begin, period, end - begin], axis=1)[long], axis=0)
    return found[:, [0, 2, 1]]


def _kept(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run repeats, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()])


def _numbered(words: list[bytes], first: int) -> np.ndarray:
    """Word numbers from ``first`` on, equal for equal words."""
    known = {w: i for i, w in enumerate(dict.fromkeys(words), first)}
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def _together(documents: list[tuple[object, list[bytes]]], min_words: int, min_periods: int) -> pa.RecordBatch:
    numbers, first = [], 0
    for _, words in documents:
        numbers.append(_numbered(words, first))
        first += len(words)
    ends = np.cumsum([len(n) for n in numbers])
    runs = find(np.concatenate(numbers), min_words, min_periods)
    cuts = np.searchsorted(runs[:, 0], ends)
    out, texts, before, begin = [], [], 0, 0
    for (_, words), cut, end in zip(documents, cuts.tolist(), ends.tolist()):
        mine = runs[before:cut] - [begin, 0, 0]
        out.append([dict(zip(("start", "length", "period"), r)) for r in mine.tolist()])
        texts.append(_kept(words, mine))
        before, begin = cut, end
    ids = pa.array([i for i, _ in documents], pa.int64())
    lengths = pa.array([len(w) for _, w in documents], pa.int64())
    return pa.RecordBatch.from_arrays(
        [ids, lengths, pa.array(out, RUNS), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"]
    )


def _search(min_words: int, min_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[object, list[bytes]]] = []
        many = 0
        rows = chain.from_iterable(zip(b.column("doc_id").to_pylist(), b.column("text")) for b in batches)
        for doc_id, text in rows:
            words = text.cast(pa.binary()).as_py().split()  # bytes: the six white-space characters only
            if held and many + len(words) > BATCH_WORDS:
                yield _together(held, min_words, min_periods)
                held, many = [], 0
            held.append((doc_id, words))
            many += len(words)
        if held:
            yield _together(held, min_words, min_periods)

    return run


def periodic_runs(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> DataFrame:
    """One row per document: doc_id, n_words, its runs by start and period, and the text without repeated periods."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    return rows.mapInArrow(_search(min_words, min_periods), SCHEMA)
