"""Every operator on odd rows, on nothing, and against plain brute force."""

import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerleaf.llm import (
    components,
    exact_dedup,
    imatch,
    licenses,
    mixing,
    packing,
    page_text,
    quality,
    queries,
    simhash,
    token_files,
    toxicity,
)
from ledgerleaf.llm.tokenise import Encoder, vocabulary

SF = Path("/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, sha string, fp long, size int, `candidate` string"
WORDS = "the of and tion er ing lower upper stone river cloud".split()


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(["th", "er", "on", "an", "re", "ti"], k=rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def odd_rows():
    long = prose(1, 60_000)
    texts = [
        (1, prose(2, 80)), (2, prose(2, 80).replace(" ", "\n ")), (3, prose(3, 50)), (None, prose(4, 30)), (None, None), (4, None), (5, ""), (6, " \t\n"),
        (7, long), (8, "one"), (9, "one two"), (9, "one two"), (10, "Ünïcode 漢字 \x00 <|endoftext|>"), (11, "a\tb  c\r\n\nd"), (12, prose(5, 40)),
        (13, prose(5, 40)), (13, prose(5, 40)), (14, "All rights reserved.\n\nReleased under the MIT License\nx"),
    ]
    return [(i, t, "en", None if k % 5 == 0 else f"src{k % 3}", None, "row", "sha", 1, 2, None) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def normal(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\f\r")


def test_exact_dedup_keeps_the_longest_then_the_smallest(odd, odd_rows):
    found = exact_dedup.duplicates(odd).collect()
    assert len(found) == len(odd_rows)
    groups = {}
    for row in odd_rows:
        groups.setdefault(hashlib.sha256(normal(row[1]).encode()).hexdigest(), []).append(row)
    for sha, rows in groups.items():
        mine = [r for r in found if r.text_sha256 == sha]
        best = min(rows, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        assert {r.keep_id for r in mine} == {best[0]}
        assert {r.group_size for r in mine} == {len(rows)}
        assert sum(r.kept for r in mine) == 1
        assert [r.doc_id for r in mine if r.kept] == [best[0]]


def test_exact_dedup_rows_that_stay(odd, odd_rows):
    kept = exact_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert Counter(texts) == Counter({normal(r[1]) for r in odd_rows})


def test_bloom_filter_never_misses_a_repeat(spark):
    rows = [(bytes([i % 251, i % 7]),) for i in range(2000)]
    hashes = spark.createDataFrame(rows, "sha binary")
    repeated, blocks = exact_dedup.repeat_filter(hashes, 64)
    passed = {bytes(r.sha) for r in exact_dedup.probe(hashes, repeated, blocks).filter("candidate").collect()}
    assert {sha for (sha,), n in Counter(rows).items() if n > 1} <= passed


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_give_the_ids_of_the_whole_text(name):
    rng = random.Random(7)
    parts = ["a", "The", "é", "ẞx", "'s", "don't", " ", "  ", "\n", "\n\n", "\t", " ", "<|endoftext|>", "12", "!?", "é", "́", "\x1f", "\x85", "漢字", "\x00", "İ", ",", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    plain = [p for p in parts if p.strip() and "<" not in p and p not in "\x1f\x85"]
    texts += [" ".join("".join(rng.choice(plain) for _ in range(rng.randint(1, 3))) for _ in range(9)) for _ in range(3000)]
    encoder, whole = Encoder(vocabulary(name), cache_words=300), Tokenizer.from_file(vocabulary(name))
    got = [ids for at in range(0, len(texts), 500) for ids in encoder.encode(texts[at : at + 500])]
    assert got == [np.array(whole.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]


def test_token_files_round_trip(spark, odd, odd_rows):
    folder, manifest = token_files.write(odd)
    rows = token_files.read_digests(spark, folder, manifest).orderBy("start").collect()
    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    ids = lambda t: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((r[0], len(ids(r[1])), zlib.crc32(ids(r[1]).tobytes())) for r in odd_rows)
    assert [r.doc_id for r in rows] == sorted((r[0] for r in odd_rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]
    for file in manifest.collect():
        for row in rows:
            if row.doc_id == 3 and file.start <= row.start < file.start + file.tokens:
                assert token_files.read_document(folder, file.name, 3).tolist() == ids(prose(3, 50)).tolist()


def test_token_files_of_nothing(spark, nothing):
    assert token_files.read_digests(spark, *token_files.write(nothing)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan_places_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = 64
    histogram = {rng.randint(1, capacity): rng.randint(1, 400) for _ in range(rng.randint(1, 40))}
    slots = Counter()
    for run in packing.plan(histogram, capacity):
        for k in range(run.count):
            for at in range(run.length):
                slots[run.sequence + k // run.each, run.offset + k % run.each * run.length + at] += 1
    assert set(slots.values()) == {1}
    filled = Counter(s for s, _ in slots)
    assert set(filled) == set(range(len(filled)))
    assert all(slots[s, at] for s, n in filled.items() for at in range(n)) and max(filled.values()) <= capacity
    total = sum(k * n for k, n in histogram.items())
    assert sum(slots.values()) == total
    # best fit, one piece after the other
    rooms = []
    for length in sorted(Counter(histogram).elements(), reverse=True):
        fits = [r for r in rooms if r >= length]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - length)
        else:
            rooms.append(capacity - length)
    assert len(filled) == len(rooms)


def test_packing_of_odd_rows(odd, odd_rows, nothing):
    rows = packing.pack(odd).collect()
    whole = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    for sequence in {r.sequence_id for r in rows}:
        inside = sorted((r.offset, r.length) for r in rows if r.sequence_id == sequence)
        assert [o for o, _ in inside] == [sum(n for _, n in inside[:k]) for k in range(len(inside))]
        assert sum(n for _, n in inside) <= 2048
    assert packing.pack(nothing).count() == 0


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_of_odd_rows(odd, odd_rows, nothing):
    got = {(r.doc_id, r.fingerprint) for r in simhash.near_duplicates(odd).collect()}
    assert got == {(i, f"{plain_simhash(t):016x}") for i, t, *_ in odd_rows}
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns
    prints = [plain_simhash(r.text) for r in kept.collect()]
    assert len(prints) == len(set(prints)) == len({r.component_id for r in simhash.near_duplicates(odd).collect()})


def test_masks_cover_every_pair_of_bits():
    pairs = [(i, j) for i in range(64) for j in range(i + 1)]
    assert all(any(not mask >> i & 1 and not mask >> j & 1 for mask in simhash.masks()) for i, j in pairs)


@pytest.mark.parametrize("paired", [48, 3])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(10)]
    prints = set(base)
    for b in base[:3]:
        for _ in range(120):
            x = b
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(10 if b == base[0] else 64)
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    parent = {x: x for x in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(signed):
        for y in signed[:i]:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= 2:
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    linked = Counter(find(x) for x in signed)
    want = {x: find(x) for x in signed if linked[find(x)] > 1}
    found = components.components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")))
    assert {r.node: r.root for r in found.collect()} == want


def test_imatch_compares_with_the_next(odd, odd_rows, nothing):
    rows = imatch.fingerprints(odd).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows}
    texts = {i: t or "" for i, t, *_ in odd_rows}
    for own, following in [(14, 13), (12, 11), (8, 7), (4, 3), (2, 1)]:
        changed = imatch.edited(texts[own], texts[following])
        assert by_id[own].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert by_id[own].n_chars == len(texts[own])
    prints = {}
    for r in rows:
        prints.setdefault(hashlib.sha256(r.fingerprint.encode()).hexdigest() if r.doc_id is None else texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert all(0 <= x <= 1 for r in rows for x in (r.near_edited, r.near_next))
    assert imatch.fingerprints(nothing).count() == 0
    alone = imatch.fingerprints(odd.filter("doc_id = 1")).first()
    assert alone.edited_sha256 == hashlib.sha256(imatch.edited(texts[1], texts[1]).encode()).hexdigest() and alone.near_next == 1


def test_likeness_falls_with_the_edit():
    words = imatch.Lexicon(imatch.terms(prose(9, 5000)), np.array([], dtype=np.uint64))
    text, other = prose(10, 400), prose(11, 400)
    own = imatch.fingerprint(text, words)
    steps = [imatch.likeness(own, imatch.fingerprint(text[: int(len(text) * k)] + other[: int(len(text) * (1 - k))], words)) for k in (1, 0.9, 0.6, 0)]
    assert steps[0] == 1 and steps[0] > steps[1] > steps[2] > steps[3]


def test_mixing_hits_targets(spark, odd, nothing):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 60))), None if i % 11 == 0 else "abcde"[min(4, int(rng.expovariate(0.7)))]) for i in range(3000)]
    found = mixing.mixture(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in {r[2] for r in rows}}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    low, high = 0.0, 1e9
    for _ in range(200):  # the level by bisection
        level = (low + high) / 2
        low, high = (level, high) if sum(min(weights[s] * level, 3 * sizes[s]) for s in order) < sum(sizes.values()) else (low, level)
    source = {i: s for i, _, s in rows}
    for s in order:
        mine = found[found.doc_id.map(lambda i, s=s: source[i] == s)]
        target = mine.target.iloc[0]
        assert target == pytest.approx(min(weights[s] * low, 3 * sizes[s]))
        assert abs(mine.taken.sum() - target) <= 60
        assert (mine.taken <= 3 * mine["size"]).all()
    assert mixing.mixture(nothing).count() == 0 and mixing.mixed(nothing).count() == 0
    got = mixing.mixture(odd).orderBy("size").select("size", "taken").collect()
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    assert sum(r.taken for r in got) == sum(len((r.text or "").split()) for r in mixed.select(F.translate("text", "\x00", "x").alias("text")).collect())


def test_licenses(odd, nothing):
    rows = {(r.doc_id, r.kind, r.unit_no, r.license, r.dice) for r in licenses.scan(odd).collect()}
    assert rows == {(14, "line", 0, "all-rights-reserved", 1.0), (14, "line", 2, "mit", 1.0), (14, "paragraph", 1, "mit", 16 / 18)}
    assert licenses.scan(nothing).count() == 0


def test_pages_keep_the_article_and_drop_the_rest(spark):
    page = lambda n: (
        f"<html><head><title>t</title><style>x</style></head><body><div>Same words on every page</div><header>H</header><nav>n<a>1</a></nav>"
        f"<div class='ad'>buy</div><article><h1>Title {n}</h1><p>One &amp; two<br>x<p><b>Three</b> shared <script>var a='</p>';</script>end"
        f"<div id=comments>hey</div></article><div>Only here {n}<form>f</form></div><footer>&copy;</footer>"
    )
    rows = [(k, f"http://h/{k}", page(k)) for k in range(6)]
    rows += [(9, None, None), (None, "http://Other:80/x", "<p>Alone"), (10, "x", "plain  &lt;b&gt; "), (0, "http://h/0", page(0)), (11, "http://q/", "<nav>only")]
    got = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = {k: f"Title {k}\n\nOne & two x\n\nThree shared end\n\nOnly here {k}" for k in range(6)} | {9: "", None: "Alone", 10: "plain <b>", 11: ""}
    assert len(got) == len(rows)
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)
    assert page_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def labelled(n):
    rows = []
    for k in range(n):
        text = prose(k, 40 + k % 30)
        bad, rude = k % 3 == 0, k % 4 == 1
        text = " ".join(w.upper() + "!!" for w in text.split()) if bad else text
        if rude:
            words = text.split()
            for at in range(5, len(words), 9):
                words[at] = ("idiot", "scumbag", "worthless")[at % 3]
            text = " ".join(words)
        rows.append((k, text, int(not bad), int(rude)))
    return rows


def test_learners_on_held_out_rows(spark, odd, nothing):
    rows = labelled(900)
    documents = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows] + [(None, 1, 1), (5000, 0, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    truth = {i: (q, x) for i, _, q, x in rows}
    network, model = quality.train(documents, labels), toxicity.train(documents, labels)
    for at, found in enumerate((quality.scored(documents, network), toxicity.scored(documents, model))):
        got = found.collect()
        assert len(got) == len(rows) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
        assert np.mean([r.predicted == truth[r.doc_id][at] for r in got if r.held_out]) > 0.95
    for scored in (quality.scored(odd, network), toxicity.scored(odd, model)):
        got = scored.collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.scored(nothing, network).count() == toxicity.scored(nothing, model).count() == 0
    assert quality.keep_good(odd, network).columns == odd.columns
    none = labels.filter("quality = 1 and toxic = 1")
    assert quality.train(documents, none) is None and toxicity.train(documents, none) is None
    assert {r.score for r in quality.scored(odd, None).collect()} == {0.5} and {r.score for r in toxicity.scored(odd, None).collect()} == {0.0}


def test_long_texts_score_as_their_blocks_do():
    network = quality.ByteNetwork()
    long = prose(3, 20_000)
    together = network.scores(["", long, "short", prose(4, 300)])
    assert np.allclose(together, [network.scores([t])[0] for t in ("", long, "short", prose(4, 300))])


@pytest.mark.skipif(not SF.exists(), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    ours, theirs = queries.QUERIES[name](spark, str(SF)).toPandas(), con.execute(queries.ORACLES[name]).fetchdf()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = lambda frame: sorted(tuple(map(str, r)) for r in frame[columns].astype(object).itertuples(index=False))
    assert rows(ours) == rows(theirs)
