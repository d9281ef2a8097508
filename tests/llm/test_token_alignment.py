"""Alignment against brute force over all token pairs."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerleaf.llm import queries, token_alignment
from ledgerleaf.llm.tokenise import vocabulary

SCHEMA = "doc_id long, text string, block int, at string, pairs string, groups string"


@pytest.fixture(scope="module")
def plain():
    """Tokens as (id, bytes) of both sides, by the libraries on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    byte_level.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    letters = token_alignment._byte_letters()

    def tokens(text):
        if not text:
            return [], []
        a = [(i, bytes(letters[c] for c in t)) for i, t in zip(*(lambda e: (e.ids, e.tokens))(byte_level.encode(" " + text, add_special_tokens=False)))]
        b = []
        for i in pieces.encode(text):
            piece = pieces.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
        spelt = b" " + text.encode()
        if b"".join(x for _, x in a) != spelt or b"".join(x for _, x in b) != spelt:
            return [], []
        return a, b

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, x in tokens:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(rows, tokens):
    """All pairs whose ranges overlap, counted over documents."""
    per, holders = [], Counter()
    for doc_id, text in rows:
        a, b = map(spans, tokens(text))
        links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        before, groups = 0, []
        for end in ends:
            inside = lambda side: ",".join(str(i) for i, s, e in side if before <= s and e <= end)  # noqa: E731,B023
            groups.append(f"{inside(a)}|{inside(b)}")
            before = end
        holders.update(set(links))
        per.append((doc_id, len(a), len(b), groups, links))
    highest = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    return [
        (doc_id, n_a, n_b, len(groups), len(links), sum(holders[p] == highest[p[0]] for p in links), sum(holders[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc_id, n_a, n_b, groups, links in per
    ]


def odd_texts():
    rng = random.Random(3)
    words = "the cat sat on unbelievable Größenwahn 漢字 don't 12,345.67 <|endoftext|> <s> </s> x\ny É caf́e 😀 http://a.b/c?d=e".split(" ")
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(60)]
    texts += [None, "", " ", "  two", "two  spaces", "end ", "\n", "a\n\nb", "a \n b", "tab\there", "▁", "a▁b", "\x00", "  x", "x  y", "ﬁ Å ½", "\r\n x \r\n"]
    texts += ["é" * 300, "a" * 2000, "the " * 50 + "the", "﻿bom", "​ zero", "0" * 50, "<0x41> <unk>"]
    return texts


def test_query_agrees_with_brute_force(spark, tmp_path, plain):
    texts = odd_texts()
    rows = [*enumerate(texts), (None, texts[0]), (5, texts[5]), (5, texts[5])]
    spark.createDataFrame([(i, t, 1, "a", "p", "g") for i, t in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_token_alignment(spark, str(tmp_path)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, plain), key=key)
    assert sum(r.n_links > 0 for r in got) > 60


def test_small_blocks_give_the_same(spark):
    documents = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string").coalesce(2)
    sums = []
    for size in (16, 700, 400_000):
        rows = token_alignment.materialise(token_alignment.aligned(documents, block_tokens=size), "blocks")
        sums.append(sorted(tuple(r) for r in rows.join(token_alignment.scored(rows), ["block", "at"]).select("doc_id", "n_best", "count_sum", "groups").collect()))
        assert rows.select("block").distinct().count() >= (30 if size == 16 else 2)
    assert sums[0] == sums[1] == sums[2]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t▁  'a b.1<>|é漢"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_words_apart_are_as_the_whole_text(text):
    both = token_alignment.vocabularies(vocabulary(token_alignment.BYTE_LEVEL), vocabulary(token_alignment.PIECES))
    encode = token_alignment.Encoder(both)
    assert encode(text) == encode.whole(text)


def test_byte_level_ids_are_the_tokenizers_own(plain):
    both = token_alignment.vocabularies(vocabulary(token_alignment.BYTE_LEVEL), vocabulary(token_alignment.PIECES))
    for text in odd_texts():
        if text and plain(text)[0]:
            assert both.encode_a(" " + text) == [i for i, _ in plain(text)[0]]


def test_pattern_is_the_vocabulary_s():
    spec = json.load(open(vocabulary(token_alignment.BYTE_LEVEL), encoding="utf-8"))
    assert spec["pre_tokenizer"]["type"] == "ByteLevel" and spec["pre_tokenizer"]["use_regex"]


def test_very_long_text_and_nothing(spark):
    text = " ".join(f"word{i % 977} and" for i in range(60_000))
    found = token_alignment.alignment(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert found.n_links == found.n_a + found.n_b - found.n_groups and found.count_sum == found.n_links == found.n_best > 0
    assert token_alignment.alignment(spark.createDataFrame([], SCHEMA)).count() == 0
