"""SimHash fingerprints of word shingles, linked by covering locality-sensitive hashing, and their components.

Each of the 64 bits has a label of three bits; for each of the seven non-zero vectors, a mask keeps the bits whose label
is odd against it. Two fingerprints that differ in two bits or fewer have two labels or fewer to be orthogonal to, so
some vector is, and in that vector's table both have the same key: no pair within the radius can be missed. Masks keep
about 37 bits, so a table's buckets hold little else.

Equal fingerprints are one node, however many documents have them. Within a bucket of few fingerprints the pairs are
compared. The fingerprints of larger buckets are instead keyed once by every choice of two bits to leave out: at most
four fingerprints share such a key, and all of them are linked, so the work is linear and no link is lost.

Defined cases. A null text counts as empty; texts without words have the fingerprint zero and are linked like any other.
A text with fewer words than a shingle is one shingle. A component is named after its smallest id; null ids are smaller
than none and name it only if it has no other. Repeated rows are linked by their fingerprint. An empty table gives an
empty result. Other columns are carried along by ``representatives`` and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import text_of, whole_rows
from ledgerleaf.llm.components import components
from ledgerleaf.session import materialise

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
#: Fingerprints of a bucket that are compared in pairs; larger buckets take the linear way.
PAIRED = 48
#: Words hashed at a time, which bounds a worker's memory on very long texts.
BLOCK_WORDS = 20_000


def masks() -> list[int]:
    """Seven masks of the covering family for radius 2, as signed 64-bit integers. Labels run through 1 to 7."""
    out = []
    for vector in range(1, 8):
        mask = sum(1 << bit for bit in range(64) if bin((bit % 7 + 1) & vector).count("1") % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def fingerprint(text: str, width: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """A bit is set if it is set in over half of the shingles' XXH64 values."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six white-space characters only
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    total, counts = len(words) - width + 1, np.zeros(64, dtype=np.int64)
    for at in range(0, total, BLOCK_WORDS):
        part = words[at : at + BLOCK_WORDS + width - 1]
        shingles = map(b" ".join, zip(*(islice(part, i, None) for i in range(width))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * counts > total))


def _fingerprints(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t or "", width, seed) for t in batch.column("text").to_pylist()), dtype="<u8", count=batch.num_rows)
            kept = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found.view("<i8"), pa.int64())], names=[*names, "fp"])

    return run


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all of ``nodes`` (fp, distinct) within the radius."""
    tables = F.array(*[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(mask).alias("key")) for i, mask in enumerate(masks())])
    keyed = nodes.select("fp", F.explode(tables).alias("at")).select("fp", "at.table", "at.key")
    buckets = keyed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("many"), F.min("fp").alias("low"), F.max("fp").alias("high"))
    buckets = materialise(buckets.filter("many > 1"), "buckets")
    pairs = buckets.filter("many = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    pairs = pairs.filter(_apart(F.col("a"), F.col("b")) <= RADIUS)
    more = buckets.filter("many > 2").select("table", "key", "many")
    if more.isEmpty():
        return pairs
    members = materialise(keyed.join(more, ["table", "key"]), "members")
    gathered = members.filter(F.col("many") <= PAIRED).groupBy("table", "key").agg(F.collect_list("fp").alias("all"))  # PAIRED at most
    near = lambda x, rest: F.filter(rest, lambda y: (y > x) & (_apart(x, y) <= RADIUS))
    found = gathered.select(F.explode(F.flatten(F.transform("all", lambda x: F.transform(near(x, F.col("all")), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("e"))
    hot = members.filter(F.col("many") > PAIRED).select("fp").distinct()
    return pairs.unionByName(found.select("e.a", "e.b")).unionByName(_dense_links(hot))


def _dense_links(hot: DataFrame) -> DataFrame:
    """Links among many close fingerprints: those that agree when two bits are left out are at most four, all linked."""
    first = hot.select("fp", F.explode(F.sequence(F.lit(0), F.lit(62))).alias("i"))
    choices = first.select("fp", "i", F.explode(F.sequence(F.col("i") + 1, F.lit(63))).alias("j"))
    bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), F.col(place))
    key = F.col("fp").bitwiseAND(F.bitwise_not(bit("i").bitwiseOR(bit("j"))))
    groups = choices.groupBy("i", "j", key.alias("key")).agg(
        F.count(F.lit(1)).alias("many"), F.min("fp").alias("low"), F.max("fp").alias("high"), F.bit_xor("fp").alias("odd")
    )
    # two are the ends, a third is what remains of the exclusive or, and four are all there can be
    third = F.col("odd").bitwiseXOR(F.col("low")).bitwiseXOR(F.col("high"))
    four = F.array(F.col("key"), F.col("key").bitwiseOR(bit("i")), F.col("key").bitwiseOR(bit("j")), F.col("key").bitwiseOR(bit("i")).bitwiseOR(bit("j")))
    others = F.when(F.col("many") == 2, F.array("high")).when(F.col("many") == 3, F.array(F.col("high"), third)).otherwise(four)
    return groups.filter("many > 1").select(F.col("low").alias("a"), F.explode(others).alias("b")).filter("a <> b").distinct()


def _labelled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (.., fp) as written, and (fp, root) of the nodes that have a link."""
    rows = materialise(rows, "fingerprints")
    return rows, materialise(components(links(rows.select("fp").distinct())), "components")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, fingerprint in hexadecimal, component_id."""
    signed = documents.select(F.col(id_col).cast("long").alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    rows, roots = _labelled(signed.mapInArrow(_fingerprints(width, seed), "doc_id long, fp long"))
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    classes = materialise(classes.select("fp", "least", F.coalesce("root", "fp").alias("root")), "classes")
    named = classes.join(classes.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """The rows that stay, one of each component: that with the smallest id, a null id last, then the smallest row hash."""
    row = whole_rows(documents)
    doc_id, text = F.col(f"row.`{id_col}`").cast("long"), text_of(F.col(f"row.`{text_col}`"))
    row_hash = F.xxhash64("row")
    signed = row.select(doc_id.alias("doc_id"), row_hash.alias("row_hash"), text.alias("text"))
    rows, roots = _labelled(signed.mapInArrow(_fingerprints(width, seed), "doc_id long, row_hash long, fp long"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")).alias("best")
    # one row per fingerprint before components meet: most of a large component is folded where it lies
    classes = rows.groupBy("fp").agg(best).join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    kept = classes.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best")).select("best.doc_id", "best.row_hash")
    return staying(row, doc_id, row_hash, rows, materialise(kept, "kept"))


def staying(row: DataFrame, doc_id: Column, row_hash: Column, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows that ``kept`` (doc_id, row_hash) names, one each. ``rows`` has the doc_id and row_hash of every row."""
    marked = row.withColumn("keep_id", doc_id).withColumn("keep_hash", row_hash)
    match = F.col("keep_id").eqNullSafe(F.col("doc_id")) & (F.col("keep_hash") == F.col("row_hash"))
    stays = marked.join(kept, match, "left_semi")
    twins = rows.groupBy("doc_id", "row_hash").count().filter("count > 1").join(kept, ["doc_id", "row_hash"], "left_semi")
    if twins.isEmpty() and rows.filter("doc_id is null").isEmpty():
        return stays.select("row.*")
    return stays.groupBy("keep_id", "keep_hash").agg(F.first("row").alias("row")).select("row.*")
