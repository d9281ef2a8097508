"""Text extraction: pending documents to clean text, one outcome per document."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator, Mapping
from datetime import datetime, timedelta
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import text as tx
from ledgerleaf.functions.times import ts_literal
from ledgerleaf.operators import sizing, state

Extractor = Callable[[bytes], str]

# Longest cell of a CSV file: the parser's own default would refuse cells over 131,072 characters.
CELL_CHARS = 2**31 - 1
# Characters of extracted text that a task holds before it hands them on.
CHARS_AT_ONCE = 4 << 20


def decode(data: bytes) -> str:
    """UTF-8 with or without a byte order mark, else Latin-1."""
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def csv_text(data: bytes) -> str:
    """A header line, then ``name: value`` pairs per row; blank cells are left out, surplus cells are ``_extra``."""
    csv.field_size_limit(CELL_CHARS)
    rows = csv.reader(io.StringIO(decode(data)))
    header = next(rows, [])
    lines = ["Columns: " + ", ".join(header)]
    for row in filter(None, rows):
        surplus = row[len(header) :]
        cells = list(zip(header, row)) + ([("_extra", ", ".join(surplus))] if surplus else [])
        lines.append(" | ".join(f"{name}: {value}" for name, value in dict(cells).items() if value.strip()))
    return "\n".join(lines)


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that show a date or time (fixed values of the file format).
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
_EPOCH = datetime(1899, 12, 30)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that format numbers as dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")).lower()
        for f in root.iter(_NS + "numFmt")
    }
    xfs = root.find(_NS + "cellXfs")
    found = set()
    for i, xf in enumerate(xfs if xfs is not None else []):
        fmt = int(xf.get("numFmtId", 0))
        if fmt in _DATE_FORMATS or re.search(r"[dmyhs]", custom.get(fmt, "")):
            found.add(i)
    return found


def _cell_text(cell: ElementTree.Element, shared: list[str], dates: set[int]) -> str:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(_NS + "t"))
    raw = cell.findtext(_NS + "v")
    if raw is None:
        return ""
    if kind == "s":
        return shared[int(raw)]
    if kind == "b":
        return str(raw == "1")
    if kind != "n":
        return raw
    number = float(raw)
    if int(cell.get("s", 0)) in dates:
        return str(_EPOCH + timedelta(seconds=round(number * 86400)))
    return str(int(number)) if re.fullmatch(r"[-+]?\d+", raw) else str(number)


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]*", reference).group():
        number = number * 26 + ord(letter) - 64
    return number


def xlsx_text(data: bytes) -> str:
    """Each sheet as a title line and tab-joined rows; blank rows are left out."""
    lines = []
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            strings = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in si.iter(_NS + "t")) for si in strings.iter(_NS + "si")]
        dates = _date_styles(book)
        links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target") for r in links}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(_NS + "sheet"):
            lines.append(f"=== Sheet: {sheet.get('name')} ===")
            target = targets[sheet.get(_REL)]
            name = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
            for row in ElementTree.fromstring(book.read(name)).iter(_NS + "row"):
                cells: dict[int, str] = {}
                for cell in row.iter(_NS + "c"):
                    at = _column_number(cell.get("r", "")) or max(cells, default=0) + 1
                    cells[at] = _cell_text(cell, shared, dates)
                line = "\t".join(cells.get(i, "") for i in range(1, max(cells, default=0) + 1)).strip()
                if line:
                    lines.append(line)
    return "\n".join(lines)


def no_pdf_text(data: bytes) -> str:
    raise ValueError("No PDF extractor configured")


DEFAULT_EXTRACTORS: Mapping[str, Extractor] = {"CSV": csv_text, "XLSX": xlsx_text, "PDF": no_pdf_text}


def pending(registry: DataFrame, texts: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """STAGED documents without text; with ``mapping`` only those of a mapped client (no fan-out)."""
    staged = registry.where(F.col("processing_status") == "STAGED")
    if mapping is not None:
        staged = staged.join(mapping.select("client_account_id"), "client_account_id", "left_semi")
    return state.missing_from(staged, texts, ["file_id"]).select(
        "file_id", "file_name", "file_format", "client_account_id", "current_location"
    )


def _record_batch(read: list[tuple[str | None, str | None, str | None]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*read)], names=["file_id", "raw", "error"])


def extract_text(
    todo: DataFrame,
    files: DataFrame,
    extractors: Mapping[str, Extractor] | None = None,
    broadcast_rows: int | None = None,
    max_chars: int | None = None,
) -> DataFrame:
    """(file_id, extracted_text, char_count, error), one row per pending document.

    ``files`` holds (location, content). The pending side is counted and broadcast when small, so bytes go from the
    scan straight into extraction; a large one meets the files in one shuffle join. A document that cannot be read, or
    whose file is absent, gets an error and never fails the run. ``extractors`` adds or replaces formats, for example a
    PDF parser. Texts are kept whole unless ``max_chars`` cuts them; ``char_count`` is the length before the cut.
    """
    table = {**DEFAULT_EXTRACTORS, **{k.upper(): v for k, v in (extractors or {}).items()}}

    def read_one(fmt: str | None, place: str | None, there: bool, data: bytes | None) -> tuple[str | None, str | None]:
        try:
            if not there:
                raise FileNotFoundError(f"File not found: {place or ''}")
            extractor = table.get(str(fmt).upper())
            if extractor is None:
                raise ValueError(f"Unsupported file format: {fmt}")
            return extractor(bytes(data)), None
        except Exception as problem:  # one bad document must not fail its batch
            return None, str(problem) or type(problem).__name__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One document at a time; texts are handed on as soon as they come to ``CHARS_AT_ONCE``."""
        for batch in batches:
            read: list[tuple[str | None, str | None, str | None]] = []
            chars = 0
            for row in zip(*(batch.column(c) for c in ("file_id", "file_format", "current_location", "there", "content"))):
                file_id, *given = (value.as_py() for value in row)
                text, error = read_one(*given)
                read.append((file_id, text, error))
                chars += len(text or "")
                if chars >= CHARS_AT_ONCE:
                    yield _record_batch(read)
                    read, chars = [], 0
            if read:
                yield _record_batch(read)

    wanted = todo.select("file_id", "file_format", "current_location")
    contents = files.select(F.col("location").alias("current_location"), "content")
    if sizing.is_small(wanted, broadcast_rows or sizing.BROADCAST_ROWS):
        found = contents.join(F.broadcast(wanted), "current_location")
        # cut down to the wanted places before the anti join, which may broadcast them
        there = contents.select("current_location").join(F.broadcast(wanted.select("current_location")), "current_location", "left_semi")
        absent = wanted.join(there.distinct(), "current_location", "left_anti").withColumn("content", F.lit(None).cast("binary"))
        read = found.withColumn("there", F.lit(True)).unionByName(absent.withColumn("there", F.lit(False)))
    else:
        # one pass over the files; without the hint Spark may take their bytes for small enough to be broadcast
        held = contents.withColumn("there", F.lit(True)).hint("merge")
        read = wanted.join(held, "current_location", "left").withColumn("there", F.coalesce("there", F.lit(False)))
    raw = read.select("file_id", "file_format", "current_location", "there", "content").mapInArrow(run, "file_id string, raw string, error string")
    clean = raw.withColumn("clean", tx.clean_text(F.col("raw")))
    return clean.select(
        "file_id",
        tx.truncate(F.col("clean"), max_chars).alias("extracted_text"),
        F.length("clean").cast("bigint").alias("char_count"),
        "error",
    )


def text_rows(outcomes: DataFrame, as_of) -> DataFrame:
    """Document text rows of the documents that were read."""
    return outcomes.where(F.col("error").isNull()).select(
        "file_id", "extracted_text", "char_count", ts_literal(as_of).alias("extracted_ts")
    )


def registry_delta(registry: DataFrame, outcomes: DataFrame, as_of) -> DataFrame:
    return state.transition(registry, outcomes.select("file_id", "error"), "TEXT_EXTRACTED", as_of)


NAMES = ("extracted", "failed")


def outcome_name() -> Column:
    return F.when(F.col("error").isNull(), F.lit("extracted")).otherwise(F.lit("failed"))


def counters(outcomes: DataFrame) -> DataFrame:
    return state.counters(outcomes.select(outcome_name().alias("outcome")), "outcome", NAMES)
