"""Every stage of the pipeline against plain Python on its own input."""

import random
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerleaf.llm import quality
from ledgerleaf.llm.tokenise import vocabulary

SF = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, fp long, `bucket` int"


def rows_of():
    """Distinct texts, equal ones but for white space, near copies, repeats, texts without words, null ids."""
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "su") for b in ("r", "st", "nd", "la", "vo", "x")]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 120))) for _ in range(90)]
    texts += [t.replace(" ", "\n") for t in texts[:12]] + [t + " " for t in texts[5:9]]
    texts += [" ".join([*t.split()[:-1], "end"]) for t in texts[20:50]]
    texts += [None, "", " \t", "one", "One", "one two"]
    rows = [(i, t) for i, t in enumerate(rng.sample(texts, len(texts)))] + [(None, texts[3]), (None, "only here")]
    return [(i, t, "en", None if k % 7 == 0 else f"s{k % 4}", None, "row", 1, 2) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def key(row):
    return tuple(map(str, row))


def first(i):
    return (i is None, i or 0)


def bare(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\f\r")


def test_exact_dedup(spark, documents, rows):
    groups = {}
    for r in rows:
        groups.setdefault(bare(r[1]), []).append(r)
    want = [min(g, key=lambda r: (-len(r[1] or ""), first(r[0]))) for g in groups.values()]
    got = corpus_pipeline.exact_dedup_stage(spark, documents, "")
    assert got.columns == documents.columns and sorted(map(key, got.collect())) == sorted(map(key, want))


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_dedup(spark, documents, rows):
    """One row of each component of fingerprints that lie two bits apart or less."""
    left = sorted(rows, key=lambda r: first(r[0]))
    marks = [fingerprint(r[1]) for r in left]
    kept, seen = [], set()
    for at in range(len(left)):
        if at in seen:
            continue
        kept.append(left[at])
        front = [at]
        seen.add(at)
        while front:
            here = marks[front.pop()]
            near = [j for j in range(len(left)) if j not in seen and (marks[j] ^ here).bit_count() <= 2]
            seen.update(near)
            front += near
    got = corpus_pipeline.near_dedup(spark, documents, "")
    assert got.columns == documents.columns and len(kept) < len(rows) - 10
    assert sorted(key(r) for r in got.collect() if r.doc_id is not None) == sorted(key(r) for r in kept if r[0] is not None)
    assert got.count() == len(kept)


def targets(sizes):
    """By source: shares of the total by weight, 5, 2, 1 and again, none above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, out = set(order), {}
    while True:
        rest = sum(sizes.values()) - sum(out.values())
        share = {s: Fraction(weight[s] * rest, sum(weight[t] for t in left)) for s in left}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        out |= {s: Fraction(3 * sizes[s]) for s in over}
        left -= set(over)


def test_source_mix(spark, documents, rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    wanted = targets(sizes)
    got = corpus_pipeline.source_mix(spark, documents, "")
    assert got.columns == documents.columns
    times = Counter(map(key, got.collect()))
    held = Counter(map(key, rows))
    assert set(times) <= set(held) and all(times[k] <= 3 * held[k] for k in times)
    for source in sizes:
        mine = [r for r in rows if r[3] == source]
        taken = sum(times[key(r)] // held[key(r)] * len((r[1] or "").split()) for r in mine)
        assert abs(taken - wanted[source]) <= max(len((r[1] or "").split()) for r in mine), source
        # all are repeated as often, or once more
        assert len({times[key(r)] // held[key(r)] for r in mine}) <= 2


def test_sequence_packing(spark, documents, rows):
    whole = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter()
    for r in rows:
        ids = np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[r[0], piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    got = corpus_pipeline.sequence_packing(spark, documents, "").collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    total, used = sum(r.length for r in got), len({r.sequence_id for r in got})
    assert used == -(-total // 2048)  # short pieces leave no room over


@pytest.mark.skipif(not SF.exists(), reason="driver tables not present")
def test_quality_filter(spark, monkeypatch):
    """What stays is what the network, run on each text alone, scores from the threshold on."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    monkeypatch.setattr(quality, "train", lambda *a, **k: network)
    got = corpus_pipeline.quality_filter(spark, docs, str(SF))
    assert got.columns == docs.columns
    want = {r.doc_id for r in docs.collect() if network.scores([r.text or ""])[0] >= quality.THRESHOLD}
    kept = {r.doc_id for r in got.collect()}
    assert kept == want and 0 < len(kept) < docs.count()
