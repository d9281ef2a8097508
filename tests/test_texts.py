import io
import re
import zipfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerleaf import schemas
from ledgerleaf.operators import chunk, classify, embed, extract, models, state

AS_OF = "2024-03-01 12:00:00"


# -- extraction ---------------------------------------------------------------------------------------------------
def test_csv_text():
    assert extract.csv_text("﻿Name,Note\r\nAnn,\r\nBob, x \r\n".encode()) == "Columns: Name, Note\nName: Ann\nName: Bob | Note:  x "
    assert extract.csv_text(b"A,B\n") == "Columns: A, B"
    assert extract.csv_text(b"A\n1,2,3\n,\n") == "Columns: A\nA: 1 | _extra: 2, 3\n"
    assert extract.csv_text("A\ncafé\n".encode("latin-1")) == "Columns: A\nA: café"
    assert extract.csv_text(b"") == "Columns: "
    long = "word " * 400_000
    assert extract.csv_text(f'A\n"{long}"\n'.encode()) == f"Columns: A\nA: {long}"
    assert extract.csv_text(b"A,B\n\t,x\n") == "Columns: A, B\nB: x"


def workbook(sheets):
    """A minimal XLSX file: numbers, shared strings, inline strings, booleans and dates."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as book:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f"<workbook {ns} {rel}><sheets>{names}</sheets></workbook>")
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        book.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>shared</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>")
        book.writestr("xl/styles.xml", f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f"<row>{r}</row>" for r in rows)
            book.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return data.getvalue()


def test_xlsx_text():
    data = workbook(
        {
            "First": [
                '<c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c>',
                '<c r="A2"><v>12</v></c><c r="B2"><v>1.5</v></c><c r="C2" t="b"><v>1</v></c>',
                '<c r="A3"/>',
            ],
            "Second": ['<c r="A1" t="inlineStr"><is><t>inline</t></is></c><c r="B1" s="1"><v>45292</v></c>'],
        }
    )
    assert extract.xlsx_text(data) == (
        "=== Sheet: First ===\nshared\t\trich\n12\t1.5\tTrue\n=== Sheet: Second ===\ninline\t2024-01-01 00:00:00"
    )


def test_extraction_isolates_failures(spark):
    todo = spark.createDataFrame(
        [("1", "CSV", "s/1"), ("2", "PDF", "s/2"), ("3", "json", "s/3"), ("4", "xlsx", "s/4"), ("5", "CSV", "s/5"), ("6", "PDF", "s/6")],
        "file_id string, file_format string, current_location string",
    )
    files = spark.createDataFrame(
        [("s/1", b"A\n1  2\n"), ("s/2", b"ok"), ("s/3", b"{}"), ("s/4", b"no zip"), ("s/6", b"bad"), ("s/9", b"not asked for")],
        "location string, content binary",
    )

    def pdf(data):
        if data == b"bad":
            raise ValueError("cannot read page")
        return "page one\n\n\n\npage two"

    for rows in (None, 1):  # broadcast, then the shuffle join beyond the bound
        got = {r.file_id: r for r in extract.extract_text(todo, files, {"PDF": pdf}, broadcast_rows=rows).collect()}
        assert len(got) == 6
        assert (got["1"].extracted_text, got["1"].char_count, got["1"].error) == ("Columns: A\nA: 1 2", 17, None)
        assert got["2"].extracted_text == "page one\n\npage two"
        assert got["3"].error == "Unsupported file format: json"
        assert got["4"].error == "File is not a zip file"
        assert got["5"].error == "File not found: s/5"
        assert got["6"].error == "cannot read page"


def test_texts_are_handed_on_in_bounded_pieces(spark, monkeypatch):
    """However many documents an Arrow batch holds, a task keeps few of their texts."""
    monkeypatch.setattr(extract, "CHARS_AT_ONCE", 20)
    sizes = spark.sparkContext.accumulator(0)
    made = extract._record_batch

    def counted(read):
        sizes.add(1)
        return made(read)

    monkeypatch.setattr(extract, "_record_batch", counted)
    todo = spark.range(0, 50, numPartitions=1).select(F.col("id").cast("string").alias("file_id"), F.lit("X").alias("file_format"), F.col("id").cast("string").alias("current_location"))
    files = todo.select(F.col("current_location").alias("location"), F.lit(b"0123456789").alias("content"))
    found = extract.extract_text(todo, files, {"X": bytes.decode}).collect()
    assert {(r.file_id, r.extracted_text) for r in found} == {(str(i), "0123456789") for i in range(50)}
    assert sizes.value == 25


def test_document_bytes_are_never_broadcast(spark, capsys):
    """Beyond the bound Spark would guess the bytes to be small, however many Python makes of a short row."""
    todo = spark.range(3).select(F.col("id").cast("string").alias("file_id"), F.lit("CSV").alias("file_format"), F.col("id").cast("string").alias("current_location"))
    files = spark.range(3).select(F.col("id").cast("string").alias("location"), F.lit(b"A\n1\n").alias("content"))
    found = extract.extract_text(todo, files, broadcast_rows=1)
    found.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert {(r.file_id, r.extracted_text) for r in found.collect()} == {(str(i), "Columns: A\nA: 1") for i in range(3)}


# -- chunking -----------------------------------------------------------------------------------------------------
def squeezed(text):
    return "".join(text.split())


def chunks_of(spark, texts, **kw):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, extracted_text string")
    return {r.i: r.chunks for r in chunk.with_chunks(df, **kw).select("i", "chunks").collect()}


piece = st.text(alphabet="ab.!? \n\té", max_size=30)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(piece, max_size=12).map("\n\n".join), min_size=1, max_size=40), st.integers(5, 60), st.integers(1, 12))
def test_chunks_lose_nothing_and_are_cut_late(spark, texts, target, overlap):
    for i, chunks in chunks_of(spark, texts, target=target, overlap=overlap).items():
        kept = squeezed(chunks[0]) if chunks else ""
        for before, after in zip(chunks, chunks[1:]):
            tail = squeezed(before[-overlap:])
            assert squeezed(after).startswith(tail)
            fresh = squeezed(after)[len(tail) :]
            # nothing is cut off while the next piece still fits; blanks only make it longer
            assert fresh and len(before) + len(after) - min(overlap, len(before)) >= target - 1
            kept += fresh
        assert kept == squeezed(texts[i])
        assert all(c.strip() for c in chunks)


def test_a_text_that_fits_is_one_chunk(spark):
    texts = ["one\n\ntwo", "  one \n\n\n two  ", "x" * 19, "\n\n"]
    assert chunks_of(spark, texts, target=20, overlap=4) == {0: ["one\n\ntwo"], 1: ["one\n\ntwo"], 2: ["x" * 19], 3: []}


def test_the_tail_leads_the_next_chunk(spark):
    got = chunks_of(spark, ["aaaa bbbb\n\ncccc dddd\n\neeee"], target=12, overlap=3)
    assert got == {0: ["aaaa bbbb", "bbb\n\ncccc dddd", "ddd\n\neeee"]}


def test_chunk_cases(spark):
    sentences = " ".join(f"Sentence number {i} has words." for i in range(200))
    texts = [
        "",
        "Short one.\n\nShort two.",
        "\n\n".join(["p" * 601] * 10),
        "\n\n".join(f"Entry {i}" for i in range(100)),
        sentences,
        "x" * 5000,
        "tiny\n\n" + "y" * 9000,
    ]
    got = chunks_of(spark, texts)
    assert all("".join(c.split()) in "".join(t.split()) for i, t in enumerate(texts[:2]) for c in got[i])
    assert got[0] == [] and len(got[1]) == 1 and len(got[2]) >= 3 and len(got[4]) >= 2
    assert all(f"Entry {i}" in " ".join(got[3]) for i in range(100))
    assert got[5] == ["x" * 5000] and len(got[6][1]) > 9000


def test_chunk_rows(spark):
    df = spark.createDataFrame([("a", "One.\n\nTwo."), ("b", "  "), ("c", None)], "file_id string, extracted_text string")
    rows = chunk.chunk(df).collect()
    assert [(r.file_id, r.chunk_index, r.chunk_text, r.token_count) for r in rows] == [("a", 0, "One.\n\nTwo.", 3)]


# -- embedding ----------------------------------------------------------------------------------------------------
def test_embedding_is_deterministic_and_scaled(spark):
    model = models.hashing_embedder(32)
    df = spark.createDataFrame([("Alpha beta beta",), ("alpha BETA, beta!",), ("",), (None,)], "t string")
    rows = [r.embedding for r in embed.embed(df, "t", model).collect()]
    assert rows[0] == rows[1] and len(rows[0]) == 32
    assert abs(sum(x * x for x in rows[0]) - 1) < 1e-6
    assert set(rows[2]) == {0.0} and set(rows[3]) == {0.0}


# -- classification -----------------------------------------------------------------------------------------------
@pytest.mark.parametrize(
    "reply, want",
    [
        ('{"document_type": "tax_profile", "confidence": "high", "key_indicators": ["a", 1], "summary": "s"}', ("TAX_PROFILE", "high", '["a",1]', "s")),
        ('```json\n{"document_type": " INCOME_REPORT "}\n```', ("INCOME_REPORT", "low", "[]", "")),
        ('{"document_type": "POEM", "confidence": "medium"}', ("UNKNOWN", "medium", "[]", "")),
        ('{"document_type": null, "summary": "%s"}' % ("z" * 3000), ("UNKNOWN", "low", "[]", "z" * 3000)),
        ('{"document_type": ["x"]}', ("UNKNOWN", "low", "[]", "Parse error: unexpected JSON shape")),
        ("null", ("UNKNOWN", "low", "[]", "Parse error: unexpected JSON shape")),
        ("[1]", ("UNKNOWN", "low", "[]", "")),
        ("certainly!", ("UNKNOWN", "low", "[]", "Parse error: reply is not valid JSON")),
        ("", ("UNKNOWN", "low", "[]", "Parse error: reply is not valid JSON")),
    ],
)
def test_classification_replies(spark, reply, want):
    row = classify.with_parsed_reply(spark.createDataFrame([(reply,)], "reply string"), "reply").first()
    assert (row.document_type, row.classification_confidence, row.key_indicators, row.doc_summary) == want


def test_classification_job(spark):
    registry = spark.createDataFrame(
        [("1", "tax_profile_x.csv", "EMBEDDED"), ("2", "misc.csv", "EMBEDDED"), ("3", "b.csv", "STAGED"), ("4", "d.csv", "EMBEDDED")],
        "file_id string, file_name string, processing_status string",
    ).withColumns({"document_type": F.lit(None).cast("string"), "updated_ts": F.lit(None).cast("timestamp_ntz")})
    texts = spark.createDataFrame([(str(i), "FATCA status " + "x" * 2000) for i in range(1, 5)], "file_id string, extracted_text string")
    done = spark.createDataFrame([("4", "TAX_PROFILE")], "file_id string, document_type string")
    todo = classify.pending(registry, texts, done)
    assert {r.file_id: (len(r.excerpt), len(r.extracted_text)) for r in todo.collect()} == {"1": (1500, 2013), "2": (1500, 2013)}

    def refuse_second(prompt):
        if "misc.csv" in prompt:
            raise RuntimeError("model is down")
        assert "tax_profile_x.csv" in prompt and "SURCHARGE_STATEMENT" in prompt
        return '{"document_type": "TAX_PROFILE", "confidence": "high"}'

    model = models.CompletionModel("test-model", models.guarded(refuse_second))
    outcomes = classify.classify(todo, model)
    got = {r.file_id: (r.document_type, r.error) for r in outcomes.collect()}
    assert got["1"] == ("TAX_PROFILE", None) and got["2"][1] == "model is down"
    after = {r.file_id: (r.processing_status, r.document_type) for r in classify.registry_delta(registry, outcomes, AS_OF).collect()}
    assert after == {"1": ("AVAILABLE", "TAX_PROFILE"), "2": ("FAILED", None)}
    assert [r.file_id for r in classify.classification_rows(outcomes, AS_OF).collect()] == ["1"]
    counts = classify.counters(outcomes).first()
    assert (counts.classified, counts.failed) == (1, 1)
    default = {r.file_id: r.document_type for r in classify.classify(todo).collect()}
    assert default["1"] == "TAX_PROFILE"


def test_replacing_chunks(spark):
    base = spark.createDataFrame([("a", 0, "old"), ("a", 1, "old"), ("b", 0, "keep"), ("c", 0, "old")], "file_id string, chunk_index int, chunk_text string")
    delta = spark.createDataFrame([("a", 0, "new")], base.schema)
    replaced = spark.createDataFrame([("a",), ("c",)], "file_id string")
    once = state.replace_by_key(base, delta, ["file_id"], replaced)
    twice = state.replace_by_key(once, delta, ["file_id"], replaced)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 0, "new"), ("b", 0, "keep")]


def test_vocabulary_is_closed():
    assert len(schemas.DOCUMENT_TYPES) == 10 and "UNKNOWN" in schemas.DOCUMENT_TYPES
