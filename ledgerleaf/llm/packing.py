"""Best-fit packing: the plan is made over counts of lengths, then each piece takes the slot its rank points to.

The tokenising pass cuts long documents into pieces of the sequence length and numbers the pieces of each length within
its task. From the histogram of lengths (at most one count for every length up to the sequence length) the driver packs
best fit, longest first, treating all pieces of one length and all sequences with one fill as one number. The plan is a
list of runs: "the pieces of this length with ranks from r on go to the sequences from s on, q to a sequence, from this
offset". A fill is touched at most once for a length, so the plan is bounded by the sequence length alone, not by the
data. Pieces then get their global rank (their task's base for the length plus their own number) and look up their run.
No window or group ever holds the pieces of a common length.

Defined cases. A null text counts as empty: one piece with the end id only. Repeated rows and ids are packed as often as
they come; a null id is carried along. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import text_of
from ledgerleaf.llm.tokenise import encoder, vocabulary
from ledgerleaf.session import materialise

SEQUENCE_TOKENS = 2048


class Run(NamedTuple):
    """Pieces of ``length`` with ranks ``rank`` to ``rank + count - 1`` fill ``each`` slots a sequence from ``offset`` on."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int
    each: int


def plan(histogram: dict[int, int], capacity: int = SEQUENCE_TOKENS) -> list[Run]:
    """Best fit, longest first, over counts. Sequences are numbered without gaps from 0."""
    runs: list[Run] = []
    free: list[int] = []  # the fills in use, by room left
    groups: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, how many)
    sequences = 0

    def keep(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in groups:
                bisect.insort(free, room)
                groups[room] = []
            groups[room].append((first, many))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(free, length)
            if at < len(free):
                room = free[at]
                first, many = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    free.pop(at)
            else:
                room, first = capacity, sequences
                many = -(-left // (capacity // length))
                sequences += many
            each = room // length
            full = min(many, left // each)  # sequences that take as many as fit
            if full:
                runs.append(Run(length, rank, full * each, first, capacity - room, each))
                rank, left = rank + full * each, left - full * each
                keep(room - each * length, first, full)
            rest = min(left, each) if full < many else 0
            if rest:
                runs.append(Run(length, rank, rest, first + full, capacity - room, rest))
                rank, left = rank + rest, left - rest
                keep(room - rest * length, first + full, 1)
            keep(room, first + full + bool(rest), many - full - bool(rest))
    return runs


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        tail = np.array([end_id], dtype="<u2").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows: list[tuple] = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder(path).encode([t or "" for t in part.column("text").to_pylist()])):
                    whole = np.frombuffer(ids + tail, dtype="<u2").astype("<u4")
                    for piece, start in enumerate(range(0, len(whole), capacity)):
                        held = whole[start : start + capacity]
                        length = len(held)
                        rows.append((doc_id, piece, start, length, zlib.crc32(held.tobytes()), task, int(met[length])))
                        met[length] += 1
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "own_rank"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _place(runs: list[Run]):
    """Slots by search in the sorted runs, which are bounded by the sequence length."""
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)
    wide = 1 << 45  # ranks of one length; lengths take the bits above
    keys = table[:, 0] * wide + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            _, first_rank, _, sequence, offset, each = table[np.searchsorted(keys, length * wide + rank, side="right") - 1].T
            own = rank - first_rank
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(sequence + own // each, pa.int64()), pa.array(offset + own % each * length, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_file: str = "word_bpe_49k.json",
    end_id: int = 0,
    capacity: int = SEQUENCE_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # written once: own ranks depend on the task that gave them
    pieces = materialise(
        documents.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text")).mapInArrow(
            _pieces(vocabulary(vocabulary_file), end_id, capacity),
            "doc_id long, piece int, start long, length long, ids_crc32 long, task int, own_rank long",
        ),
        "pieces",
    )
    cells = materialise(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("many")), "lengths")
    # at most ``capacity`` rows
    histogram = {r.length: r.many for r in cells.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    # a row for each task that met the length, however many pieces it met
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select("length", "task", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("base"))
    ranks = pieces.join(bases, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("own_rank")).alias("rank")
    )
    return ranks.mapInArrow(
        _place(plan(histogram, capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
