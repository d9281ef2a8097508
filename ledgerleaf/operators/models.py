"""Pluggable models.

A model is a function of columns, so a stand-in can stay inside the JVM and a real model can be an Arrow batch UDF.
``batched`` and ``batched_embedder`` make models of functions that are costly to set up: set up once per task, then asked
for batches.
The defaults here are deterministic stand-ins for offline use: they exercise the data flow and claim no meaning.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf.schemas import DOCUMENT_TYPES

REPLY = "struct<reply: string, error: string>"
WORD = r"[^\W_]+"
WORD_BREAK = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class EmbeddingModel:
    """``encode`` maps a text column to an ``array<float>`` column of ``width`` numbers."""

    name: str
    width: int
    encode: Callable[[Column], Column]


@dataclass(frozen=True)
class CompletionModel:
    """``complete`` maps (prompt, facts) to a reply column: text, or ``struct<reply, error>``.

    ``facts`` is a struct of the inputs the prompt was built from; a language model ignores it.
    """

    name: str
    complete: Callable[[Column, Column], Column]


def guarded(fn: Callable[[str], str]) -> Callable[[Column, Column], Column]:
    """Wraps a Python ``prompt -> reply`` function as a batch UDF; an exception becomes that row's error."""
    return batched(lambda: lambda prompts: [fn(prompt) for prompt in prompts], at_once=1)


def as_reply(result: Column, dtype) -> Column:
    """Normalises a model result to ``struct<reply, error>``."""
    if dtype.simpleString() == "string":
        return F.struct(result.alias("reply"), F.lit(None).cast("string").alias("error"))
    return result


#: Prompts, or texts, that a model gets at a time.
AT_ONCE = 64


def _answers(answer: Callable[[list[str]], list], items: list[str]) -> list[tuple[object, str | None]]:
    """(reply, error) per item, in order. If a batch fails its items are asked one by one, so only those that fail do."""

    def asked(some: list[str]) -> list:
        replies = list(answer(some))
        if len(replies) != len(some):
            raise ValueError(f"{len(replies)} replies to {len(some)} inputs")
        return replies

    try:
        return [(reply, None) for reply in asked(items)]
    except Exception as problem:  # one failed call must not fail the batch
        if len(items) == 1:
            return [(None, str(problem) or type(problem).__name__)]
        return [found for item in items for found in _answers(answer, [item])]


def _ready(setup: Callable[[], Callable[[list[str]], list]]) -> Callable[[list[str]], list]:
    """The model, set up; a model that cannot be set up fails every item with the reason."""
    try:
        return setup()
    except Exception as problem:  # known to each row instead
        reason = str(problem) or type(problem).__name__

        def unavailable(items: list[str]) -> list:
            raise RuntimeError(reason)

        return unavailable


def batched(
    setup: Callable[[], Callable[[list[str]], list[str]]], at_once: int = AT_ONCE, of: Callable[[Column, Column], Column] | None = None
) -> Callable[[Column, Column], Column]:
    """A completion model that is set up once per task and answers batches of prompts.

    ``setup`` runs in the worker, before the first prompt, and gives the function that answers a list of prompts in order.
    An exception becomes the error of the prompts it is about. ``of`` makes the text that the model gets from prompt and
    facts; by default that is the prompt.
    """

    @F.pandas_udf(REPLY)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        answer = None
        for prompts in batches:
            answer = answer or _ready(setup)
            items = prompts.tolist()
            found = [x for i in range(0, len(items), at_once) for x in _answers(answer, items[i : i + at_once])]
            yield pd.DataFrame(found, columns=["reply", "error"], dtype=object)

    return lambda prompt, facts: call(of(prompt, facts) if of else prompt)


def batched_embedder(name: str, width: int, setup: Callable[[], Callable[[list[str]], np.ndarray]], at_once: int = 1024) -> EmbeddingModel:
    """An embedding model that is set up once per task. The function it gives maps texts to rows of ``width`` numbers."""

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vectors_of = None
        for texts in batches:
            vectors_of = vectors_of or setup()
            rows = np.empty((len(texts), width), dtype=np.float32)
            for i in range(0, len(texts), at_once):
                # of a batch's texts only these are held as Python objects
                items = [t or "" for t in texts.slice(i, at_once).to_pylist()]
                found = np.asarray(vectors_of(items), dtype=np.float32)
                if found.shape != (len(items), width):
                    raise ValueError(f"model {name} gave {found.shape}, not {(len(items), width)}")
                rows[i : i + len(items)] = found
            offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * width)
            yield pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1)))

    return EmbeddingModel(name, width, encode)


TOKEN_CACHE = 1 << 18


def hashing_embedder(width: int = 1024) -> EmbeddingModel:
    """Token counts hashed into ``width`` buckets and scaled to length one. Buckets of tokens are remembered per task."""

    def setup() -> Callable[[list[str]], np.ndarray]:
        tokens_of = re.compile(WORD).findall

        class Buckets(dict):
            def __missing__(self, token: str) -> int:
                if len(self) >= TOKEN_CACHE:
                    self.clear()
                found = self[token] = int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % width
                return found

        bucket_of = Buckets().__getitem__

        def vectors(texts: list[str]) -> np.ndarray:
            rows = np.zeros((len(texts), width), dtype=np.float64)
            for row, text in zip(rows, texts):
                tokens = tokens_of(text.lower())
                if tokens:
                    row += np.bincount(np.fromiter(map(bucket_of, tokens), np.intp, len(tokens)), minlength=width)
            norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
            return np.divide(rows, norms, out=rows, where=norms > 0)

        return vectors

    return batched_embedder(f"hashing-{width}", width, setup)


def words(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != ""))


def keyword_classifier() -> CompletionModel:
    """Counts each type's keywords in file name and text; most hits win, vocabulary order settles ties.

    Reads the facts ``file_name`` and ``haystack`` (name and whole text in lower case).
    """

    def complete(prompt: Column, facts: Column) -> Column:
        haystack = facts["haystack"]
        scored = F.array(
            *[
                F.struct(
                    F.array_compact(
                        F.array(*[F.when(F.contains(haystack, F.lit(k)), F.lit(k)) for k in keywords])
                    ).cast("array<string>").alias("hits"),
                    F.lit(name).alias("type"),
                    F.lit(description).alias("description"),
                )
                for name, (description, keywords) in DOCUMENT_TYPES.items()
            ]
        )
        none = F.struct(
            F.array().cast("array<string>").alias("hits"),
            F.lit("UNKNOWN").alias("type"),
            F.lit(DOCUMENT_TYPES["UNKNOWN"][0]).alias("description"),
        )
        best = F.aggregate(
            scored, none, lambda top, one: F.when(F.size(one["hits"]) > F.size(top["hits"]), one).otherwise(top)
        )
        return F.aggregate(
            F.array(best),
            F.lit(""),
            lambda acc, b: F.to_json(
                F.struct(
                    b["type"].alias("document_type"),
                    F.when(F.size(b["hits"]) >= 2, F.lit("high"))
                    .when(F.size(b["hits"]) == 1, F.lit("medium"))
                    .otherwise(F.lit("low"))
                    .alias("confidence"),
                    b["hits"].alias("key_indicators"),
                    F.concat(facts["file_name"], F.lit(": "), b["description"]).alias("summary"),
                )
            ),
        )

    return CompletionModel("keyword-rules", complete)


def overlap_reranker() -> CompletionModel:
    """Picks the candidate that shares most distinct words with the query; the earlier one on ties."""

    def complete(prompt: Column, facts: Column) -> Column:
        wanted = words(facts["query"])
        shared = F.transform(
            facts["candidates"], lambda c: F.size(F.array_intersect(wanted, words(c["text"])))
        )
        best = F.array_max(shared)
        return F.to_json(
            F.struct(
                F.array_position(shared, best).alias("best_candidate_index"),
                F.when(best * 2 >= F.size(wanted), F.lit("high"))
                .when(best > 0, F.lit("medium"))
                .otherwise(F.lit("low"))
                .alias("confidence"),
                F.concat(F.lit("shares "), best.cast("string"), F.lit(" query words")).alias("reason"),
            )
        )

    return CompletionModel("word-overlap", complete)
