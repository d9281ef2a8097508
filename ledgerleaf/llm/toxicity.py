"""Toxicity by compression distance: windows that a toxic dictionary compresses better than an ordinary one.

Texts are lower-cased and cut into overlapping windows of whole words that cover all of them. Each window is compressed
twice by zstandard, with a dictionary trained on ordinary text and with that dictionary behind one trained on toxic
text. The first is padded to the length of the second, so that ordinary words cost the same in either and only what the
toxic part holds makes a difference. A window's gain is how many bytes the toxic part saves. A document's score is a
logistic function of its two greatest gains and its number of windows, fitted on labelled rows that neither dictionary
was trained on, where an ordinary document called toxic counts ``ORDINARY_COST`` times.

Toxic documents are mostly ordinary text. The toxic dictionary is therefore trained on the spans of toxic documents
whose byte n-grams set them apart from ordinary documents, not on all of their text.

Both dictionaries and the calibration are fitted on a bounded sample of labelled rows (``TRAIN_ROWS`` of each class, of
at most ``TRAIN_BYTES``) that are not held out; scoring covers every document from its first byte to its last.

Defined cases. Null, empty and blank texts have no window and score the calibrated value of no gain. Without labelled
rows of both classes, or without any span that sets toxic rows apart, every score is 0. Few or equal toxic spans are
the toxic dictionary as they are. Repeated rows get the same score; null ids count as the empty id when rows are
held out. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, cycle, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import held_out, text_of
from ledgerleaf.llm.labelled import sample

TRAIN_ROWS = 3000
TRAIN_BYTES = 12_000
THRESHOLD = 0.5

#: Words of a window, and words from one window to the next.
WINDOW, STEP = 16, 12
#: Characters of a window at most: longer words are cut, so that no window grows with a word.
WORD_CHARS = 100
NGRAM = 5
#: A span speaks for toxicity if its n-gram is this many times as frequent in toxic documents, in log units.
ODDS = math.log(20)
#: And if it occurs in this share of the toxic documents, so that chance does not choose it.
SHARE = 0.02
PART_BYTES = 3 * 1024
COMMON_BYTES = 61 * 1024
#: Bytes of tables at the start of a trained dictionary, about; only its content is used here. Few or equal samples train a
#: dictionary that holds little else: one with less content than this share of its size is made of the samples instead.
HEADER = 150
LEAST_CONTENT = 1 / 4
ORDINARY_COST = 3


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    #: The score is the logistic function of bias + best, second and log(1 + windows) by their weights.
    bias: float
    best: float
    second: float
    length: float


def windows(text: str) -> Iterator[str]:
    words = text.lower().split()
    if any(len(w) > WORD_CHARS for w in words):
        words = [w[i : i + WORD_CHARS] for w in words for i in range(0, len(w), WORD_CHARS)]
    for at in range(0, max(1, len(words) - WINDOW + STEP), STEP) if words else ():
        yield " ".join(words[at : at + WINDOW])


@lru_cache(maxsize=8)
def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, chain_log=16, hash_log=16, search_log=4, min_match=4, target_length=32, strategy=zstandard.STRATEGY_LAZY,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def gains(text: str, ordinary: bytes, toxic: bytes) -> tuple[int, int, float]:
    """The two greatest gains of the text's windows, 0 at least, and the logarithm of one more than their number."""
    plain, rude = _compressor(ordinary).compress, _compressor(toxic).compress
    best = second = many = 0
    for window in windows(text):
        data = f" {window} ".encode("utf-8", "surrogatepass")
        gain = len(plain(data)) - len(rude(data))
        many += 1
        if gain > best:
            best, second = gain, best
        elif gain > second:
            second = gain
    return best, second, math.log1p(many)


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary that zstandard trains, repeated up to the size; samples too few or too alike serve as they are."""
    try:
        content = zstandard.train_dictionary(size, samples).as_bytes()[HEADER:]
    except zstandard.ZstdError:
        content = b""
    if len(content) < size * LEAST_CONTENT:
        content = b"".join(dict.fromkeys(samples)) or b" "
    return bytes(islice(cycle(content[-size:]), size))


def _grams(data: bytes) -> set[bytes]:
    return {data[i : i + NGRAM] for i in range(len(data) - NGRAM + 1)}


def dictionaries(rows: list[tuple[str, int]]) -> tuple[bytes, bytes] | None:
    """Ordinary and toxic dictionary; None if nothing sets toxic documents apart."""
    rows = _without_copies(rows)
    spans = [([f" {w} ".encode("utf-8", "surrogatepass") for w in text.lower().split()], label) for text, label in rows]
    seen = (Counter(), Counter())
    many = [0, 0]
    for words, label in spans:
        many[label] += 1
        seen[label].update(set().union(*map(_grams, words)) if words else ())
    odds = {g: math.log((n + 0.5) / (many[1] + 1)) - math.log((seen[0][g] + 0.5) / (many[0] + 1)) for g, n in seen[1].items() if n >= max(2, SHARE * many[1])}
    telling = {g for g, o in odds.items() if o >= ODDS}
    toxic = [w for words, label in spans if label for w in words if not telling.isdisjoint(_grams(w))]
    if not toxic:
        return None
    plain = [w for words, label in spans if not label for w in words]
    common = _trained(_runs(plain), COMMON_BYTES)
    return bytes(PART_BYTES) + common, _trained(toxic, PART_BYTES) + common


def _runs(words: list[bytes]) -> list[bytes]:
    return [b"".join(words[i : i + WINDOW]).replace(b"  ", b" ") for i in range(0, len(words), WINDOW)]


def _without_copies(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The rows without near copies: what a copied text repeats is no sign of its class.

    A copy shares at least five of eight minima over its word pairs with a row before it.
    """
    holders: dict[tuple[int, int], list[int]] = {}
    out = []
    for text, label in rows:
        words = text.lower().split()
        pairs = {zlib.crc32(" ".join(p).encode("utf-8", "surrogatepass")) for p in zip(words, words[1:])}
        hashed = np.fromiter(pairs or {zlib.crc32(text.encode("utf-8", "surrogatepass"))}, dtype=np.uint64)
        least = [(i, int((hashed * np.uint64(2 * i + 1) * np.uint64(2654435761) & np.uint64(0xFFFFFFFF)).min())) for i in range(8)]
        if max(Counter(chain.from_iterable(holders.get(m, ()) for m in least)).values(), default=0) < 5:
            for m in least:
                holders.setdefault(m, []).append(len(out))
            out.append((text, label))
    return out


def calibrate(found: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's method with a small penalty; each class has its own total weight."""
    design = np.column_stack([np.ones(len(found)), found])
    share = np.where(labels == 1, 1 / max(1, (labels == 1).sum()), ORDINARY_COST / max(1, (labels == 0).sum())) * len(labels)
    at, penalty = np.zeros(design.shape[1]), np.diag([1e-3] + [1e-2] * found.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (share * (labels - p)) - penalty @ at
        curve = design.T @ (design * (share * p * (1 - p))[:, None]) + penalty
        at = at + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return tuple(float(x) for x in at)


def fit(rows: list[tuple[str, int]]) -> Model | None:
    """Dictionaries from two thirds of the rows, calibration on the last third; None if a class is missing or has no span of its own."""
    if len({k for _, k in rows}) < 2:
        return None
    learn = [r for i, r in enumerate(rows) if i % 3]
    test = [r for i, r in enumerate(rows) if i % 3 == 0]
    if len({k for _, k in test}) < 2 or len({k for _, k in learn}) < 2:
        learn = test = rows
    made = dictionaries(learn)
    if made is None:
        return None
    ordinary, toxic = made
    found = np.array([gains(t, ordinary, toxic) for t, _ in test], dtype=float)
    return Model(ordinary, toxic, *calibrate(found, np.array([k for _, k in test])))


def score(model: Model, text: str) -> float:
    best, second, length = gains(text, model.ordinary, model.toxic)
    value = model.bias + model.best * best + model.second * second + model.length * length
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, value))))


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> Model | None:
    return fit(sample(documents, labels, label, rows, max_bytes))


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score(model, t or "") if model else 0.0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return run


def scored(documents: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
