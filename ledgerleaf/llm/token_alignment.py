"""Alignment of two tokenizers: which tokens of either cover the same bytes, and how often two ids meet in a corpus.

A is a byte-level BPE of space and text, B a sentence-piece BPE that writes the space itself, so both spell the same
bytes. Tokens of a batch of documents lie one after another on one axis of bytes, which is document and offset in one key:
every document begins and ends at the same place on both sides. pandas ``merge_asof`` finds for each token start the
token of the other side that covers it; the union of both directions is all overlapping pairs, each once, and places
where tokens of both sides start cut the tokens into groups.

Pairs are counted over the corpus by document. A block of documents hands on its distinct pairs once, however many of its
documents hold them, so a pair that every document has is one row per block. Blocks are written, pair counts are joined
to their pairs, and each block sums its own documents; a block has at most ``BLOCK_TOKENS`` tokens, or one document.

Words between single spaces are encoded once and remembered (``CACHE_WORDS`` at most): both tokenizers begin a new token at
such a space. Texts with any other layout are encoded as a whole.

Defined cases. Null and empty texts, and texts that one of the tokenizers does not spell byte for byte, have no tokens:
all counts are 0 and ``groups`` is empty. Strings of special tokens are plain text. Null ids and repeated rows each give
their own row and count as documents of their own. An empty table gives an empty result. Columns other than the id and
the text are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import packed, text_of
from ledgerleaf.llm.tokenise import vocabulary
from ledgerleaf.session import materialise

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Tokens of A in a block, unless one document has more.
BLOCK_TOKENS = 400_000
CACHE_WORDS = 200_000

#: Fixed value: how the byte-level vocabulary cuts texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
#: Within a block: the pairs of a document by their place among the block's pairs, and how often it links each. The block's
#: pairs, and how many of its documents hold each, stand in the row of its first document.
_IN_BLOCK = "block long, at int, places binary, times binary, pairs array<long>, holders array<long>"


class Vocabularies(NamedTuple):
    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _byte_level(path: str):
    """Encoder and token bytes. Ids number the merges in order, so they serve as the ranks that merging goes by."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, letters = spec["model"], _byte_letters()
    merged = [model["vocab"][m.replace(" ", "") if isinstance(m, str) else "".join(m)] for m in model["merges"]]
    if any(x >= y for x, y in zip(merged, merged[1:])):
        raise ValueError("ids do not follow the order of merges")
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    spelt = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        spelt[i] = token
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, spelt


def _pieces(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    byte = re.compile("<0x([0-9A-F]{2})>").fullmatch
    spelt = [bytes([int(m[1], 16)]) if (m := byte(n)) else n.replace("▁", " ").encode() for n in names]
    if any("▁" in n.lstrip("▁") for n in names):
        raise ValueError("a piece goes across words")
    return (lambda text: model.encode(text, num_threads=1)), spelt


@lru_cache(maxsize=2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    """Both vocabularies, once per worker process."""
    (encode_a, bytes_a), (encode_b, bytes_b) = _byte_level(path_a), _pieces(path_b)
    if max(len(bytes_a), len(bytes_b)) > 1 << 16:
        raise ValueError("ids need more than 16 bits")
    return Vocabularies(encode_a, encode_b, bytes_a, bytes_b)


class Encoder:
    """Ids of both sides as little-endian unsigned 16-bit integers; None for texts without tokens."""

    def __init__(self, both: Vocabularies, cache_words: int = CACHE_WORDS):
        self.both, self.cache_words = both, cache_words
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def whole(self, text: str) -> tuple[bytes, bytes] | None:
        if not text:
            return None
        spelt = b" " + text.encode()
        a, b = self.both.encode_a(" " + text), self.both.encode_b(text)
        if b"".join(map(self.both.bytes_a.__getitem__, a)) != spelt or b"".join(map(self.both.bytes_b.__getitem__, b)) != spelt:
            return None
        return np.array(a, dtype="<u2").tobytes(), np.array(b, dtype="<u2").tobytes()

    def __call__(self, text: str) -> tuple[bytes, bytes] | None:
        words = text.split(" ")
        known = self.known
        if len(known) > self.cache_words:
            known.clear()
        try:
            found = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:  # white space beside a space may be merged with it
                    known[w] = self.whole(w) if w == w.strip() else None
            found = [known[w] for w in words]
        if None in found:
            return self.whole(text)
        return b"".join([a for a, _ in found]), b"".join([b for _, b in found])


class Aligned(NamedTuple):
    #: Numbers of the token that covers each token's start on the other side, and whether both start there.
    b_of_a: np.ndarray
    a_of_b: np.ndarray
    a_begins: np.ndarray
    b_begins: np.ndarray


def align(lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """Covering tokens in both directions, for tokens that lie on one axis of bytes."""
    side = lambda n: pd.DataFrame({"start": np.cumsum(n) - n, "token": np.arange(len(n))})
    a, b = side(lengths_a), side(lengths_b)
    covered = lambda x, y: pd.merge_asof(x[["start"]], y.assign(begin=y["start"]), on="start")
    by_b, by_a = covered(a, b), covered(b, a)
    begins = lambda m: (m["begin"] == m["start"]).to_numpy()
    return Aligned(by_b["token"].to_numpy(), by_a["token"].to_numpy(), begins(by_b), begins(by_a))


@lru_cache(maxsize=1)
def _numbers() -> list[bytes]:
    """Every id in decimal digits, three times: before another id of its side, before the other side, before a group."""
    return [b"%d" % i + mark for mark in (b",", b"|", b";") for i in range(1 << 16)]


def _group_texts(a: np.ndarray, b: np.ndarray, found: Aligned, ends_a: np.ndarray, ends_b: np.ndarray) -> list[bytes]:
    """Per document the ids by group, `a1,a2|b1;a3|b2,b3`."""
    group_a, group_b = np.cumsum(found.a_begins) - 1, np.cumsum(found.b_begins) - 1
    # tokens of A go before those of B that have their group or a later one
    many = int(group_a[-1]) + 1
    before_b, upto_a = np.cumsum(np.bincount(group_b, minlength=many)), np.cumsum(np.bincount(group_a, minlength=many))
    before_b = np.concatenate([[0], before_b[:-1]])
    last = lambda begins: np.append(begins[1:], True)
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    codes[np.arange(len(a)) + before_b[group_a]] = a + (last(found.a_begins) << 16)
    codes[np.arange(len(b)) + upto_a[group_b]] = b + (last(found.b_begins).astype(np.int64) << 17)
    digits, codes = _numbers(), codes.tolist()
    out, begin = [], 0
    for end in (ends_a + ends_b).tolist():
        out.append(b"".join(map(digits.__getitem__, codes[begin:end]))[:-1] if end > begin else b"")
        begin = end
    return out


def _block(number: int, ids: list, tokens: list[tuple[bytes, bytes] | None], both_lengths) -> pa.RecordBatch:
    a, b = (np.frombuffer(b"".join(t[k] for t in tokens if t), dtype="<u2").astype(np.int64) for k in (0, 1))
    n_a, n_b = (np.array([len(t[k]) // 2 if t else 0 for t in tokens], dtype=np.int64) for k in (0, 1))
    many = len(tokens)
    texts, n_groups, n_links = [b""] * many, np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
    pairs = holders = np.zeros(0, dtype=np.int64)
    places = times = [b""] * many
    if len(a):
        found = align(both_lengths[0][a], both_lengths[1][b])
        texts = _group_texts(a, b, found, np.cumsum(n_a), np.cumsum(n_b))
        of_a, of_b = np.repeat(np.arange(many), n_a), np.repeat(np.arange(many), n_b)
        n_groups = np.bincount(of_a[found.a_begins], minlength=many)
        # where both start the pair is found in both directions
        only_b = ~found.b_begins
        document = np.concatenate([of_a, of_b[only_b]])
        pair = np.concatenate([a << 16 | b[found.b_of_a], a[found.a_of_b[only_b]] << 16 | b[only_b]])
        n_links = np.bincount(document, minlength=many)
        each, often = np.unique(document << 32 | pair, return_counts=True)
        pairs, place, holders = np.unique(each & 0xFFFFFFFF, return_inverse=True, return_counts=True)
        cuts = np.searchsorted(each >> 32, np.arange(1, many))
        places = [np.diff(p, prepend=0).astype("<u4").tobytes() for p in np.split(place, cuts)]
        times = [t.astype("<u4").tobytes() for t in np.split(often, cuts)]
    first = lambda x: pa.array([x, *[None] * (many - 1)], pa.list_(pa.int64()))
    columns = {
        "doc_id": pa.array(ids, pa.int64()), "n_a": n_a, "n_b": n_b, "n_groups": n_groups.astype(np.int64), "n_links": n_links.astype(np.int64),
        "groups": pa.array(texts, pa.binary()).cast(pa.string()), "block": pa.array([number] * many, pa.int64()),
        "at": pa.array(range(many), pa.int32()), "places": pa.array(places, pa.binary()), "times": pa.array(times, pa.binary()),
        "pairs": first(pairs), "holders": first(holders.astype(np.int64)),
    }
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def _blocks(path_a: str, path_b: str, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(path_a, path_b)
        lengths = tuple(np.array([len(t) for t in spelt], dtype=np.int64) for spelt in (both.bytes_a, both.bytes_b))
        encode = Encoder(both)
        number = TaskContext.get().partitionId() << 32
        ids, tokens, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = encode(text.as_py())
                size = len(found[0]) // 2 if found else 0
                if ids and (held + size > block_tokens or len(ids) >= block_tokens // 16):
                    yield _block(number, ids, tokens, lengths)
                    number, ids, tokens, held = number + 1, [], [], 0
                ids.append(doc_id)
                tokens.append(found)
                held += size
        if ids:
            yield _block(number, ids, tokens, lengths)

    return run


def aligned(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = BYTE_LEVEL, b: str = PIECES, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups; and its links as blocks hold them."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    return rows.mapInArrow(_blocks(vocabulary(a), vocabulary(b), block_tokens), f"{_DOCUMENT}, {_IN_BLOCK}")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, documents) over all blocks of ``aligned`` rows; a pair is the id of A times 65,536 plus that of B."""
    held = rows.filter("pairs is not null").select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    return held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("documents"))


def _summed(rows: pa.Table, counted: pa.Table) -> pa.Table:
    """Sums over the links of each document of one block."""
    many = counted.num_rows
    count, best = np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
    place = counted.column("place").to_numpy()
    count[place], best[place] = counted.column("documents").to_numpy(), counted.column("best").to_numpy()
    sums, bests = [], []
    for places, times in zip(rows.column("places").to_pylist(), rows.column("times").to_pylist()):
        at, often = np.cumsum(np.frombuffer(places, "<u4").astype(np.int64)), np.frombuffer(times, "<u4").astype(np.int64)
        sums.append(int(often @ count[at]))
        bests.append(int(often @ best[at]))
    return pa.table({"block": rows.column("block"), "at": rows.column("at"), "n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())})


def scored(rows: DataFrame) -> DataFrame:
    """(block, at, n_best, count_sum) for each document of written ``aligned`` rows that has links."""
    counts = materialise(pair_counts(rows), "pair-counts")
    a_id = F.shiftright("pair", 16)
    # one row per id of A at most: bounded by the vocabulary
    highest = counts.groupBy(a_id.alias("a_id")).agg(F.max("documents").alias("highest"))
    judged = counts.join(F.broadcast(highest), a_id == F.col("a_id")).select("pair", "documents", (F.col("documents") == F.col("highest")).cast("int").alias("best"))
    held = rows.filter("pairs is not null").select(F.col("block").alias("in_block"), F.posexplode("pairs").alias("place", "pair"))
    counted = held.join(judged, "pair").select("in_block", "place", "documents", "best")
    links = rows.filter("n_links > 0").select("block", "at", "places", "times")
    return links.groupBy("block").cogroup(counted.groupBy("in_block")).applyInArrow(_summed, "block long, at int, n_best long, count_sum long")


def alignment(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", a: str = BYTE_LEVEL, b: str = PIECES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = aligned(documents, id_col, text_col, a, b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rows = packed(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    zero = F.lit(0).cast("long")
    return rows.join(scored(rows), ["block", "at"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
