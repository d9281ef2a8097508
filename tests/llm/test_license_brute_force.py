"""Windows against plain Python over every stretch of words."""

import random
from collections import Counter

from ledgerleaf.llm import licenses

TEMPLATES = {"a": "one two three four five", "b": "six seven six seven six eight", "c": "one two nine"}
VOCABULARY = "one two three four five six seven eight nine other".split()


def dice(words, template):
    x, y = (Counter(zip(w, w[1:])) for w in (words, template))
    return 2 * (x & y).total() / (x.total() + y.total())


def best_windows(words, threshold):
    """From each start the best end of each template; then those that overlap none better."""
    found = []
    for name, text in TEMPLATES.items():
        template = licenses.words_of(text)
        own = set(zip(template, template[1:]))
        for start in range(len(words) - 1):
            if (words[start], words[start + 1]) not in own:
                continue
            ends = [e for e in range(start + 1, len(words)) if (words[e - 1], words[e]) in own and dice(words[start : e + 1], template) >= threshold]
            if ends:
                end = min(ends, key=lambda e: (-dice(words[start : e + 1], template), e))
                found.append((-dice(words[start : end + 1], template), start, name, end))
    taken = []
    for w in sorted(found):
        if all(w[3] < t[1] or t[3] < w[1] for t in taken):
            taken.append(w)
    return [(t[1], t[2], round(-t[0], 9)) for t in taken]


def test_windows_of_one_long_line(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        words = []
        while len(words) < rng.randrange(5, 60):
            part = licenses.words_of(TEMPLATES[rng.choice("abc")]) if rng.random() < 0.4 else rng.choices(VOCABULARY, k=3)
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = rng.choice(VOCABULARY)
            words += part
        rows.append((i, " ".join(words)))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=TEMPLATES).collect()
    windows = sorted((r.doc_id, r.unit_no, r.license, round(r.dice, 9)) for r in got if r.kind == "window")
    whole = {r.doc_id for r in got if r.kind == "line"}
    want = sorted((i, *w) for i, text in rows if i not in whole for w in best_windows(text.split(), licenses.THRESHOLD))
    assert windows == want and len(want) > 100


def test_odd_texts(spark):
    texts = [None, "", " ", "\n", "one", "one two three four five " * 3000, "漢字 one two", "ONE—two, three\r\nfour  five!"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x x x one two three four five x")] + [(1, "y one two three four five")] * 2
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=TEMPLATES).collect()
    found = Counter((r.doc_id, r.license, r.kind) for r in got)
    assert found[(None, "a", "window")] == 1 and found[(1, "a", "window")] + found[(1, "a", "line")] == 2 and found[(5, "a", "window")] == 3000
    assert found[(7, "a", "text")] + found[(7, "a", "paragraph")] == 1
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string"), templates=TEMPLATES).count() == 0


def test_bigrams_that_cannot_all_be_missing():
    for t in licenses.compiled():
        least, _ = licenses.needed(licenses.words_of(licenses.TEMPLATES[t["name"]]), licenses.THRESHOLD)
        held = set(licenses.telling(t["grams"], least))
        assert sum(g not in held for g in t["grams"]) < least
