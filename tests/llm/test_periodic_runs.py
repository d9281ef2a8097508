"""Periodic runs against their definition, and the query against plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerleaf.llm import periodic_runs, queries

SCHEMA = "doc_id long, text string, runs string, n_words int, `start` string"


def brute_runs(words, least=24):
    """Every maximal stretch for every period; kept if the period is its smallest."""
    found, n = [], len(words)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            start, length = at, end + q - at
            stretch = words[start : start + length]
            smaller = any(stretch[p:] == stretch[:-p] for p in range(1, q))
            if length >= max(least, 3 * q) and not smaller:
                found.append((start, length, q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def repetitive(rng, n):
    out = []
    while len(out) < n:
        block = [rng.choice("abcdefgh") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 21]))]
        part = block * rng.choice([1, 1, 3, 7, 20])
        out += part[: len(part) - rng.randrange(len(block))] or block
    return out[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs_of_repetitive_words(seed):
    rng = random.Random(seed)
    words = repetitive(rng, rng.choice([30, 100, 400]))
    got = periodic_runs.find(np.array([ord(w) for w in words]))
    assert [tuple(r) for r in got.tolist()] == brute_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=8), st.integers(1, 40), st.lists(st.integers(0, 2), max_size=30), st.integers(1, 12))
def test_runs_of_few_letters(block, times, rest, least):
    words = rest[:3] + block * times + rest
    got = periodic_runs.find(np.array(words, dtype=np.int64), min_words=least)
    assert [tuple(r) for r in got.tolist()] == brute_runs(words, least)


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.find(np.zeros(4, dtype=np.int64), min_periods=2)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_agrees_with_plain_python(spark, tmp_path):
    rng = random.Random(7)
    texts = [" ".join(repetitive(rng, rng.randrange(1, 300))) for _ in range(150)]
    texts += [None, "", " \t\n", "x " * 500, "\x0bone\r\ntwo\x0c" * 30, "Ü x " * 40, "a  b\tc\n" * 9, "漢 字 😀 " * 12, "y"]
    rows = [(i, t, "r", 1, "s") for i, t in enumerate(texts)] + [(None, "z z " * 20, "r", 1, "s"), (3, texts[3], "r", 1, "s"), (3, texts[3], "r", 1, "s")]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)
    assert sum(r.n_runs for r in got) > 100


def test_documents_together_are_as_alone(spark, monkeypatch):
    text = " ".join(repetitive(random.Random(1), 200))
    many = spark.createDataFrame([(i, text if i % 2 else text + " b") for i in range(40)], "doc_id long, text string").coalesce(1)
    together = {r.doc_id: (r.runs, r.collapsed) for r in periodic_runs.periodic_runs(many).collect()}
    alone = {r.doc_id: (r.runs, r.collapsed) for r in periodic_runs.periodic_runs(many.repartition(40, "doc_id")).collect()}
    assert together == alone


def test_very_long_text(spark):
    rng = random.Random(5)
    words = [str(rng.randrange(5000)) for _ in range(300_000)]
    words[1000:1000] = ["p", "q", "r"] * 50_000
    found = periodic_runs.periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    assert found.n_words == 450_000 and [tuple(r) for r in found.runs] == [(1000, 150_000, 3)]
    assert found.collapsed.split()[995:1010] == words[995:1003] + words[151_000:151_007]


def test_nothing(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0
