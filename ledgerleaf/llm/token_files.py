"""Token ids in binary files: each document a zstandard frame of its own, compressed with one shared dictionary.

A file holds, in this order: the magic ``LLTOK1\\0\\0``, the dictionary's SHA-256, the frames one after another, and the
offset index: five little-endian 64-bit integers a document (id, whether the id is null, first byte, bytes, tokens).
The last sixteen bytes give the number of documents and the byte where the index starts. A short document is read by its
index entry alone: one range of bytes, decompressed with the dictionary of that hash.

Ids are little-endian unsigned 16-bit integers inside the frames. Files are range-partitioned by document id, null ids
first, and sorted; tasks write under names of their own, and only the names that reach the written manifest count. So a
task that is run again, or twice, leaves at most a file that nobody reads.

The dictionary is fitted on a bounded sample, as the zstandard trainer works on one machine: of the texts of at most
``SAMPLE_BYTES``, which are those a dictionary helps, the ``SAMPLE_ROWS`` with the smallest hashes. It changes the size of files and never their content; every document is encoded and written.

Defined cases. A null text counts as empty and holds the end id only. Repeated rows and ids are kept, in an order fixed
by their texts' hashes. Null ids come first. An empty table gives a manifest without rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import text_of
from ledgerleaf.llm.tokenise import crc32_of, encoder, vocabulary
from ledgerleaf.session import materialise, new_path

MAGIC = b"LLTOK1\0\0"
#: Parameters of the dictionary's sample and size.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 64_000
DICTIONARY_BYTES = 64 * 1024
LEVEL = 1
#: Compressed bytes of a file, about.
FILE_BYTES = 64 << 20

ENTRY = np.dtype([("doc_id", "<i8"), ("no_id", "<i8"), ("at", "<i8"), ("size", "<i8"), ("tokens", "<i8")])


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that pyarrow reaches; a path without a scheme is local."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; with too little to learn from, the samples themselves serve as raw content."""
    if sum(map(len, samples)) > 20 * 1024 and len(samples) > 50:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[:size] or b"\0" * 8


def _samples(documents: DataFrame, text_col: str, path: str, end_id: int) -> list[bytes]:
    hashed = F.xxhash64("text")
    texts = documents.select(text_of(F.col(text_col)).alias("text")).filter(F.octet_length("text") <= SAMPLE_BYTES)
    least = texts.select(hashed.alias("h")).distinct().orderBy("h").limit(SAMPLE_ROWS).agg(F.max("h")).first()[0]
    if least is None:
        return []
    # bounded: SAMPLE_ROWS hashes, one text of at most SAMPLE_BYTES each
    rows = texts.filter(hashed <= least).groupBy(hashed.alias("h")).agg(F.min("text").alias("text"))
    texts = [r.text for r in rows.orderBy("h").collect()]
    tail = np.array([end_id], dtype="<u2").tobytes()
    return [ids + tail for ids in encoder(path).encode(texts)]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True, write_checksum=True)


@lru_cache(maxsize=4)
def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


def _encode(path: str, dictionary: bytes, end_id: int):
    tail = np.array([end_id], dtype="<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            compress = _compressor(dictionary).compress
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = encoder(path).encode([t or "" for t in part.column("text").to_pylist()])
                frames = [compress(x + tail) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("tie"),
                        pa.array([len(x) // 2 + 1 for x in ids], pa.int64()),
                        pa.array(frames, pa.binary()),
                    ],
                    names=["doc_id", "tie", "n_tokens", "frame"],
                )

    return run


def _write(folder: str, dictionary_hash: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = filesystem(folder)
        part, out, index, at, done = TaskContext.get().partitionId(), None, [], 0, []
        name = ""

        def close() -> None:
            nonlocal out, index
            if out is None:
                return
            entries = np.array(index, dtype=ENTRY)
            out.write(entries.tobytes())
            out.write(struct.pack("<qq", len(entries), at))
            out.close()
            done.append((part, len(done), name, len(entries), int(entries["tokens"].sum()), at + entries.nbytes + 16))
            out, index = None, []

        for batch in batches:
            for doc_id, n, frame in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "frame"))):
                if out is None:
                    name = f"part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.tok"
                    out, at = store.open_output_stream(f"{base}/{name}"), len(MAGIC) + len(dictionary_hash)
                    out.write(MAGIC + dictionary_hash)
                out.write(frame)
                index.append((doc_id or 0, doc_id is None, at, len(frame), n))
                at += len(frame)
                if at >= FILE_BYTES:
                    close()
        close()
        columns = list(zip(*done)) or [[]] * 6
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "file_no", "name", "documents", "tokens", "bytes"]
        )

    return run


def write(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_file: str = "byte_bpe_50k.json",
    end_id: int = 2,
    folder: str | None = None,
) -> tuple[str, DataFrame]:
    """Writes all documents; returns the folder and the manifest: one row per file, with the ids before its first."""
    spark = documents.sparkSession
    path = vocabulary(vocabulary_file)
    folder = folder or new_path(spark, "tokens")
    dictionary = train_dictionary(_samples(documents, text_col, path, end_id))
    digest = hashlib.sha256(dictionary).digest()
    store, base = filesystem(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{digest.hex()}.dict") as out:
        out.write(dictionary)
    text = text_of(F.col(text_col))
    frames = materialise(
        documents.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie")).mapInArrow(
            _encode(path, dictionary, end_id), "doc_id long, tie long, n_tokens long, frame binary"
        ),
        "frames",
    )
    size = frames.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    files = max(spark.sparkContext.defaultParallelism, size // FILE_BYTES + 1)
    written = materialise(
        frames.repartitionByRange(files, F.asc_nulls_first("doc_id"), "tie")
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie")
        .mapInArrow(_write(folder, digest), "part int, file_no int, name string, documents long, tokens long, bytes long"),
        "manifest",
    )
    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return folder, written.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def read_index(data, size: int) -> np.ndarray:
    """The offset index of an open file."""
    documents, at = struct.unpack("<qq", data.read_at(16, size - 16))
    return np.frombuffer(data.read_at(documents * ENTRY.itemsize, at), dtype=ENTRY)


def _dictionary(folder: str, digest: bytes) -> bytes:
    store, base = filesystem(folder)
    with store.open_input_stream(f"{base}/{digest.hex()}.dict") as held:
        dictionary = held.read()
    if hashlib.sha256(dictionary).digest() != digest:
        raise ValueError("the dictionary is not the one the file was written with")
    return dictionary


def read_document(folder: str, name: str, doc_id: int) -> np.ndarray:
    """The ids of one document, by its index entry."""
    store, base = filesystem(folder)
    with store.open_input_file(f"{base}/{name}") as data:
        entries = read_index(data, data.size())
        entry = entries[np.flatnonzero((entries["doc_id"] == doc_id) & (entries["no_id"] == 0))[0]]
        dictionary = _dictionary(folder, data.read_at(32, len(MAGIC)))
        return np.frombuffer(_decompressor(dictionary).decompress(data.read_at(int(entry["size"]), int(entry["at"]))), dtype="<u2")


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = filesystem(folder)
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                with store.open_input_file(f"{base}/{name}") as data:
                    if data.read_at(len(MAGIC), 0) != MAGIC:
                        raise ValueError(f"{name} is not a token file")
                    unpack = _decompressor(_dictionary(folder, data.read_at(32, len(MAGIC)))).decompress
                    entries = read_index(data, data.size())
                    for at in range(0, len(entries), 2000):
                        part = entries[at : at + 2000]
                        starts = start + np.cumsum(part["tokens"]) - part["tokens"]
                        start += int(part["tokens"].sum())
                        sums, counts = [], []
                        for entry in part:
                            ids = np.frombuffer(unpack(data.read_at(int(entry["size"]), int(entry["at"]))), dtype="<u2")
                            sums.append(crc32_of(ids))
                            counts.append(len(ids))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part["doc_id"], pa.int64(), mask=part["no_id"] != 0),
                                pa.array(starts, pa.int64()),
                                pa.array(counts, pa.int64()),
                                pa.array(sums, pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return run


def read_digests(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Reads every file back: doc_id, start, n_tokens and the crc32 of each document's ids."""
    manifest = materialise(manifest.select("name", "start"), "manifest")
    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
