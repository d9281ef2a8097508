"""Quality by a byte-level convolutional network, written and trained in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. Bytes are embedded, learned filters run
over each chunk, and the strongest answer of every filter is kept; a small layer turns those into chunk features. Over
the document the features are max-pooled and averaged, and one logistic unit combines them. Long texts are taken a block
of chunks at a time with running maxima and sums, so memory does not grow with the text.

The network is fitted on a bounded sample of labelled rows (``TRAIN_ROWS`` of each class, of at most ``TRAIN_BYTES``)
that are not held out; scoring covers every document from its first byte to its last.

Defined cases. Null and empty texts are one chunk of padding and get the network's score for that. Without labelled rows
of both classes every score is 0.5. Repeated rows get the same score; null ids count as the empty id when rows are held
out. An empty table gives an empty result. Other columns are carried along by ``keep_good`` and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerleaf.llm.common import held_out, text_of, whole_rows
from ledgerleaf.llm.labelled import sample

TRAIN_ROWS = 1500
TRAIN_BYTES = 12_000
THRESHOLD = 0.3

CHUNK, STEP = 256, 192
WIDTH, STRIDE = 8, 2
EMBEDDING, FILTERS, HIDDEN = 6, 32, 16
EPOCHS, BATCH, RATE, DECAY = 8, 32, 0.01, 1e-4
SEED = 42
#: Chunks in one matrix product.
BLOCK = 128
POSITIONS = (CHUNK - WIDTH) // STRIDE + 1


def chunks_of(data: bytes) -> np.ndarray:
    """All chunks of a text; the last one ends with the text, a short text is padded with zeros."""
    if len(data) <= CHUNK:
        return np.frombuffer(data.ljust(CHUNK, b"\0"), dtype=np.uint8).reshape(1, CHUNK)
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), CHUNK)
    starts = np.arange(0, len(data) - CHUNK, STEP)
    return view[np.append(starts, len(data) - CHUNK)]


class ByteNetwork:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.weights = {
            "embedding": normal(256, EMBEDDING, scale=0.5),
            "filters": normal(WIDTH * EMBEDDING, FILTERS, scale=(WIDTH * EMBEDDING) ** -0.5),
            "filter_bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(FILTERS, HIDDEN, scale=FILTERS**-0.5),
            "hidden_bias": np.full(HIDDEN, 0.1, np.float32),
            "out": normal(2 * HIDDEN, scale=0.1),
            "out_bias": np.zeros(1, np.float32),
        }

    def _windows(self, chunks: np.ndarray) -> np.ndarray:
        """Embedded windows: chunks x positions x (width * embedding)."""
        embedded = self.weights["embedding"][chunks].reshape(len(chunks), CHUNK * EMBEDDING)
        windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBEDDING, axis=1)
        return np.ascontiguousarray(windows[:, :: STRIDE * EMBEDDING])

    def _features(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        w = self.weights
        windows = self._windows(chunks)
        answers = (windows.reshape(-1, WIDTH * EMBEDDING) @ w["filters"]).reshape(len(chunks), POSITIONS, FILTERS)
        best = answers.argmax(axis=1)
        pooled = np.maximum(np.take_along_axis(answers, best[:, None], 1)[:, 0] + w["filter_bias"], 0)
        return windows, best, pooled, np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)

    def _chunk_features(self, chunks: np.ndarray) -> np.ndarray:
        w = self.weights
        answers = (self._windows(chunks).reshape(-1, WIDTH * EMBEDDING) @ w["filters"]).reshape(len(chunks), POSITIONS, FILTERS)
        pooled = np.maximum(answers.max(axis=1) + w["filter_bias"], 0)
        return np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)

    def scores(self, texts: list[str]) -> np.ndarray:
        """One probability per text. Chunks of several short texts share a product; a long text takes several."""
        tops, sums = np.zeros((len(texts), HIDDEN), np.float32), np.zeros((len(texts), HIDDEN), np.float64)
        many = np.zeros(len(texts))
        held: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        waiting = 0

        def finish() -> None:
            nonlocal waiting
            if not held:
                return
            features, who = self._chunk_features(np.concatenate(held)), np.concatenate(owner)
            starts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
            first = who[starts]
            tops[first] = np.maximum(tops[first], np.maximum.reduceat(features, starts))
            sums[first] += np.add.reduceat(features, starts)
            held.clear()
            owner.clear()
            waiting = 0

        for i, text in enumerate(texts):
            chunks = chunks_of(text.encode("utf-8", "surrogatepass"))
            many[i] = len(chunks)
            for at in range(0, len(chunks), BLOCK):
                part = chunks[at : at + BLOCK]
                held.append(part)
                owner.append(np.full(len(part), i))
                waiting += len(part)
                if waiting >= BLOCK:
                    finish()
        finish()
        w = self.weights
        document = np.concatenate([tops, sums / np.maximum(many, 1)[:, None]], axis=1)
        return 1 / (1 + np.exp(-np.clip(document @ w["out"] + w["out_bias"], -30, 30).astype(np.float64)))

    def _gradients(self, texts: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        chunks = np.concatenate(texts)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        windows, best, pooled, hidden = self._features(chunks)
        top = np.stack([hidden[s : s + n].argmax(axis=0) + s for s, n in zip(starts, sizes)])
        document = np.concatenate([np.take_along_axis(hidden, top, 0), np.add.reduceat(hidden, starts) / sizes[:, None]], axis=1)
        wrong = (1 / (1 + np.exp(-(document @ w["out"] + w["out_bias"]))) - labels) / len(labels)
        back = wrong[:, None] * w["out"]
        to_hidden = np.repeat(back[:, HIDDEN:] / sizes[:, None], sizes, axis=0)
        np.add.at(to_hidden, (top, np.arange(HIDDEN)), back[:, :HIDDEN])
        to_hidden *= hidden > 0
        to_pooled = (to_hidden @ w["hidden"].T) * (pooled > 0)
        seen = np.take_along_axis(windows, best[:, :, None], 1)  # the window that each filter answered most
        to_bytes = (to_pooled[:, :, None] * w["filters"].T).reshape(-1, EMBEDDING)
        at = chunks[np.arange(len(chunks))[:, None, None], best[:, :, None] * STRIDE + np.arange(WIDTH)].reshape(-1)
        embedding = np.stack([np.bincount(at, to_bytes[:, d], 256) for d in range(EMBEDDING)], axis=1)
        return {
            "embedding": embedding,
            "filters": np.einsum("ck,ckd->dk", to_pooled, seen),
            "filter_bias": to_pooled.sum(axis=0),
            "hidden": pooled.T @ to_hidden,
            "hidden_bias": to_hidden.sum(axis=0),
            "out": document.T @ wrong,
            "out_bias": np.array([wrong.sum()]),
        }

    def fit(self, rows: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = SEED) -> ByteNetwork:
        """Adam over shuffled batches with equal weight for both classes."""
        rng = np.random.default_rng(seed)
        by_class = [[chunks_of(t.encode("utf-8", "surrogatepass")) for t, label in rows if label == k] for k in (0, 1)]
        half = BATCH // 2
        steps = epochs * max(len(c) for c in by_class) // half + 1
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        labels = np.repeat([0.0, 1.0], half).astype(np.float32)
        for step in range(1, steps + 1):
            texts = [c[i] for c in by_class for i in rng.integers(0, len(c), half)]
            rate = RATE * (1 - step / (steps + 1))
            for name, gradient in self._gradients(texts, labels).items():
                gradient = gradient.astype(np.float32) + DECAY * self.weights[name]
                first[name] = 0.9 * first[name] + 0.1 * gradient
                second[name] = 0.999 * second[name] + 0.001 * gradient**2
                scaled = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                self.weights[name] = self.weights[name] - np.float32(rate) * scaled
        return self


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES) -> ByteNetwork | None:
    """A fitted network; None if a class has no row to learn from."""
    found = sample(documents, labels, label, rows, max_bytes)
    return ByteNetwork().fit(found) if len({k for _, k in found}) == 2 else None


def _score(network: ByteNetwork | None, field: int | None = None):
    """Replaces the column text by a score, or adds one for the text in a field of the column row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [c for c in batch.schema.names if c != "text"]
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                column = part.column("text") if field is None else part.column("row").field(field)
                texts = [t or "" for t in column.to_pylist()]
                found = network.scores(texts) if network else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(found, pa.float64())], names=[*names, "score"])

    return run


def scored(documents: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    return rows.mapInArrow(_score(network), "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, network: ByteNetwork | None, text_col: str = "text") -> DataFrame:
    """The rows that the network does not reject, with the columns they came with."""
    row = whole_rows(documents)
    at = documents.columns.index(text_col)
    out = T.StructType([*row.schema.fields, T.StructField("score", T.DoubleType())])
    return row.mapInArrow(_score(network, at), out).filter(F.col("score") >= THRESHOLD).select("row.*")
