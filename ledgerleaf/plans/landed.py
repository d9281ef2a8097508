"""Real files: rows of the driver's tables are written as files of their own, scanned as files, and taken through the jobs."""

from __future__ import annotations

import io
import math
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from ledgerleaf.operators import extract, validate
from ledgerleaf.plans.adapters import Tables, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.schemas import CUSTODY_REPORTS
from ledgerleaf.session import materialise, new_path, spread
from ledgerleaf.sources import custody, files, sidecars

# -- one CSV file per supplier --------------------------------------------------------------------------------------------
_CSV = "'id,name,nation' || chr(10) || s_suppkey || ',' || s_name || ',' || s_nationkey || chr(10)"


#: Folders that files are dealt to. One for each file would take a store twice as long, and far longer to list.
_FOLDERS = 16


def _csv_rows(t: Tables) -> DataFrame:
    return t.raw("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))


def _file_per_row(rows: DataFrame, key: str, *columns: str) -> DataFrameWriter:
    """A writer of one file for each row, in folders ``folder=<number>``; a store's time for each file is shared by all cores."""
    dealt = spread(rows, key).withColumn("folder", F.col(key) % _FOLDERS)
    return dealt.select("folder", *columns).write.mode("append").option("maxRecordsPerFile", 1).partitionBy("folder")


def _write_files(rows: DataFrame, folder: str, encoding: str = "UTF-8") -> str:
    """A folder with one CSV file for each row, whose first cell is ``id``."""
    _file_per_row(rows, "id", *rows.columns).option("header", "true").option("encoding", encoding).csv(folder)
    return folder


def _number(content: str = "content") -> Column:
    """The first cell below the header, whatever the encoding."""
    return F.regexp_extract(F.decode(content, "ISO-8859-1"), r"\n(\d+),", 1).cast("bigint")


@query(
    "files_scanned",
    f"SELECT s_suppkey AS file, strlen({_CSV}) AS file_size, sha256({_CSV}) AS actual_hash FROM supplier",
)
def files_scanned(t: Tables) -> DataFrame:
    """Files written, scanned and hashed next to the scan."""
    folder = _write_files(_csv_rows(t), new_path(t.spark, "incoming"))
    return _fingerprints(t, folder).select("file", "file_size", "actual_hash")


def _fingerprints(t: Tables, folder: str) -> DataFrame:
    scanned = files.scan_documents(t.spark, folder, "*.csv").withColumn("file", _number())
    return files.fingerprint(scanned, folder, keep=("file",))


@query(
    "landing_batches",
    f"""SELECT s_suppkey AS file, strlen({_CSV}) AS file_size, count(*) OVER () AS listed,
  1 + CASE WHEN (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0) > 1 THEN 1 ELSE 0 END + 1 AS batches
FROM supplier""",
)
def landing_batches(t: Tables) -> DataFrame:
    """A stream over files in two batches, started again without news, then with more files: every file once."""
    folder, out, checkpoint = (new_path(t.spark, n) for n in ("landing-files", "landing", "landing-checkpoint"))
    rows = _csv_rows(t)
    first, later = rows.where("id % 2 = 0"), rows.where("id % 2 = 1")
    _write_files(first, folder)
    # half of the files at a time; a file is a row here
    at_once = max(1, math.ceil(first.count() / 2))
    batches = 0
    for _ in range(2):
        batches += _drain(t, folder, out, checkpoint, at_once)
    _write_files(later, folder)
    batches += _drain(t, folder, out, checkpoint, later.count())
    landed = t.spark.read.schema("file bigint, file_size bigint").parquet(out)
    return landed.withColumns({"listed": F.lit(landed.count()), "batches": F.lit(batches).cast("bigint")})


def _drain(t: Tables, folder: str, out: str, checkpoint: str, at_once: int) -> int:
    """Runs the landing stream until nothing is left; gives the number of batches that had files."""
    listed = files.landing_stream(t.spark, folder, at_once, content=True).withColumn("file", _number()).drop("content")
    stream = files.start_landing(listed, out, checkpoint).start()
    stream.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in stream.recentProgress)


# -- sidecars and registry by keys that are there, absent or null -------------------------------------------------------------
_CASES = 7


def _sidecar_json(i: Column, entity: Column) -> Column:
    """By case: both spellings, the first absent, the first null, both absent, a number in quotes, no object, no file id."""
    digest = F.concat(F.lit('"hash'), i.cast("string"), F.lit('"'))
    case = i % _CASES
    pieces = [
        F.when(case != 6, F.concat(F.lit('"file_id": "'), i.cast("string"), F.lit('"'))),
        F.concat(F.lit('"file_name": "f'), i.cast("string"), F.lit('.csv"')),
        F.when(case.isin(0, 4), F.concat(F.lit('"filehash": '), digest)).when(case == 2, F.lit('"filehash": null')),
        F.when(case != 3, F.concat(F.lit('"file_hash": "other"'))),
        F.when(case == 0, F.lit('"Destination": "Warehouse"')).when(case == 2, F.lit('"Destination": null')),
        F.when(case != 3, F.lit('"destination": "elsewhere"')),
        F.when(case == 4, F.lit('"file_size": "12"')).otherwise(F.lit('"file_size": 12')),
        F.when(case != 1, F.concat(F.lit('"Accountid": "'), entity, F.lit('"'))),
        F.lit('"allowed_formats": ["PDF", "CSV"]'),
    ]
    return F.when(case == 5, F.lit("[not an object")).otherwise(F.concat(F.lit("{"), F.concat_ws(", ", *pieces), F.lit("}")))


_SIDECAR_SQL = """SELECT {i} AS file_id, 'f' || {i} || '.csv' AS file_name,
  CASE {i} % 7 WHEN 0 THEN 'hash' || {i} WHEN 4 THEN 'hash' || {i} WHEN 1 THEN 'other' END AS file_hash,
  CASE {i} % 7 WHEN 0 THEN 'Warehouse' WHEN 1 THEN 'elsewhere' WHEN 4 THEN 'elsewhere' END AS destination,
  12 AS file_size, CASE WHEN {i} % 7 <> 1 THEN {entity} END AS account_id, 'PDF,CSV' AS allowed_formats
FROM {table} WHERE {i} % 7 NOT IN (5, 6)"""
_SIDECAR_COLUMNS = ("file_name", "file_hash", "destination", "file_size", "account_id", "allowed_formats")


@query("sidecar_keys", _SIDECAR_SQL.format(i="doc_id", entity="source", table="documents"))
def sidecar_keys(t: Tables) -> DataFrame:
    """A key that holds null is there; only one that is absent makes way for the next."""
    raw = t.raw("documents").select(_sidecar_json(F.col("doc_id"), F.col("source")).alias("value"))
    return sidecars.parse_sidecars(raw).select(F.col("file_id").cast("bigint").alias("file_id"), *_SIDECAR_COLUMNS)


@query("sidecar_files", _SIDECAR_SQL.format(i="s_suppkey", entity="s_name", table="supplier"))
def sidecar_files(t: Tables) -> DataFrame:
    """The same from one JSON file per supplier."""
    folder = new_path(t.spark, "metadata")
    rows = t.raw("supplier").select("s_suppkey", _sidecar_json(F.col("s_suppkey"), F.col("s_name")).alias("value"))
    _file_per_row(rows, "s_suppkey", "value").text(folder)
    found = sidecars.parse_sidecars(
        t.spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="part-*")
    )
    return found.select(F.col("file_id").cast("bigint").alias("file_id"), *_SIDECAR_COLUMNS)


@query(
    "collection_keys",
    """SELECT 'C' || c_nationkey AS custody_country, c_name AS legal_entity_id, 'S3' AS source,
  CASE c_custkey % 4 WHEN 0 THEN 'first' WHEN 1 THEN 'second' END AS destination, c_custkey % 3 = 0 AS active_flag,
  CASE WHEN c_custkey % 5 = 0 THEN 'PDF' END AS allowed_formats
FROM customer""",
)
def collection_keys(t: Tables) -> DataFrame:
    """Registry entries that write the destination in either way, as null, or not at all."""
    i = F.col("c_custkey")
    pieces = [
        F.concat(F.lit('"custody_country": "C'), F.col("c_nationkey").cast("string"), F.lit('"')),
        F.concat(F.lit('"legal_entity_id": "'), "c_name", F.lit('"')),
        F.lit('"Source": "S3"'),
        F.when(i % 4 == 0, F.lit('"destination": "first"')).when(i % 4 == 2, F.lit('"destination": null')),
        F.when(i % 4 != 3, F.lit('"Destination": "second"')),
        F.concat(F.lit('"active_flag": '), (i % 3 == 0).cast("string")),
        F.when(i % 5 == 0, F.lit('"allowed_formats": ["PDF"]')),
    ]
    path = new_path(t.spark, "collections")
    t.raw("customer").select(F.concat(F.lit("{"), F.concat_ws(", ", *pieces), F.lit("}")).alias("value")).write.text(path)
    return sidecars.scan_collections(t.spark, path)


# -- the landing zone as files, from scan to disposition -----------------------------------------------------------------------
@query(
    "files_validated",
    f"""SELECT s_suppkey AS file, CASE WHEN s_suppkey % 3 = 0 THEN 'hash_mismatch' WHEN s_nationkey % 2 = 1 THEN 'inactive_collection'
  ELSE 'OK' END AS reason
FROM supplier""",
)
def files_validated(t: Tables) -> DataFrame:
    """Scanned files against sidecars with their true or a wrong hash, matched by folder and name as it was scanned."""
    folder = _write_files(_csv_rows(t), new_path(t.spark, "incoming"))
    # listed once: the files are not read again for their names
    landed = materialise(_fingerprints(t, folder), "fingerprints")
    content = F.concat(F.lit("id,name,nation\n"), F.concat_ws(",", "s_suppkey", "s_name", "s_nationkey"), F.lit("\n"))
    nation = F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    known = t.raw("supplier").select(
        F.col("s_suppkey").alias("file"),
        F.col("s_suppkey").cast("string").alias("file_id"),
        nation.alias("custody_country"),
        F.lit("E").alias("legal_entity_id"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit("0")).otherwise(F.sha2(content, 256)).alias("file_hash"),
    )
    names = landed.select("file", F.split_part("path", F.lit("/"), F.lit(-2)).alias("account_id"), F.split_part("path", F.lit("/"), F.lit(-1)).alias("file_name"))
    meta = known.join(names, "file").drop("file").withColumns(
        {"file_format": F.lit("CSV"), "destination": F.lit(None).cast("string"), "branch_id": F.lit("B"), "file_size": F.lit(0).cast("bigint"), "source_system": F.lit("S3")}
    )
    collections = t.raw("supplier").select(
        nation.alias("custody_country"),
        F.lit("E").alias("legal_entity_id"),
        F.array(F.lit("CSV")).alias("allowed_formats"),
        F.lit("S3").alias("source"),
        F.lit("W").alias("destination"),
        (F.col("s_nationkey") % 2 == 0).alias("active_flag"),
    ).distinct()
    results = validate.validate(landed, meta, collections, match_on=("account_id", "file_name"))
    return results.join(landed.select("path", "file"), "path").select("file", "reason")


@query(
    "files_extracted",
    """SELECT s_suppkey AS file, 'Columns: id, name' || chr(10) || 'id: ' || s_suppkey || ' | name: Überweisung ' || s_name AS extracted_text,
  NULL::VARCHAR AS error
FROM supplier""",
)
def files_extracted(t: Tables) -> DataFrame:
    """CSV files in UTF-8 and, of odd suppliers, in Latin-1: scanned, decoded and labelled."""
    folder = new_path(t.spark, "stage")
    rows = t.raw("supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("Überweisung "), "s_name").alias("name")
    )
    _write_files(rows.where("id % 2 = 0"), folder)
    _write_files(rows.where("id % 2 = 1"), folder, "ISO-8859-1")
    scanned = files.scan_documents(t.spark, folder, "*.csv")
    todo = scanned.select(_number().cast("string").alias("file_id"), F.lit("CSV").alias("file_format"), F.col("path").alias("current_location"))
    found = extract.extract_text(todo, scanned.select(F.col("path").alias("location"), "content"))
    return found.select(F.col("file_id").cast("bigint").alias("file"), "extracted_text", "error")


_XML = '<?xml version="1.0" encoding="UTF-8"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def _workbook(sheets: list[tuple[str, list[list[object]]]]) -> bytes:
    """A workbook with inline texts and numbers."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        listed = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, (n, _) in enumerate(sheets, 1))
        office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        book.writestr("xl/workbook.xml", f'{_XML}<workbook xmlns="{_MAIN}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'{_XML}<Relationships xmlns="x">{links}</Relationships>')
        for i, (_, rows) in enumerate(sheets, 1):
            cell = lambda v: f"<c><v>{v}</v></c>" if isinstance(v, int) else f'<c t="inlineStr"><is><t>{v}</t></is></c>'
            body = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in rows)
            book.writestr(f"xl/worksheets/s{i}.xml", f'{_XML}<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def _workbooks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        made = [_workbook([("Orders", [["key", "total"], [r["o_orderkey"], r["cents"]]]), ("Status", [[r["o_orderstatus"]]])]) for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array([str(r["o_orderkey"]) for r in rows]), pa.array(made, pa.binary())], names=["location", "content"])


@query(
    "workbooks_extracted",
    """SELECT o_orderkey, '=== Sheet: Orders ===' || chr(10) || 'key total' || chr(10) || o_orderkey || ' ' || round(o_totalprice * 100)::BIGINT
  || chr(10) || '=== Sheet: Status ===' || chr(10) || o_orderstatus AS extracted_text, NULL::VARCHAR AS error
FROM orders""",
)
def workbooks_extracted(t: Tables) -> DataFrame:
    """A workbook of two sheets for every order, read back as text."""
    orders = t.heavy("orders", "o_orderkey").select("o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    books = orders.mapInArrow(_workbooks, "location string, content binary")
    todo = orders.select(F.col("o_orderkey").cast("string").alias("file_id"), F.lit("XLSX").alias("file_format"), F.col("o_orderkey").cast("string").alias("current_location"))
    found = extract.extract_text(todo, books)
    return found.select(F.col("file_id").cast("bigint").alias("o_orderkey"), "extracted_text", "error")


@query(
    "pdf_extracted",
    with_tables("docs")
    + """SELECT file_id, CASE WHEN doc_id % 3 <> 0 THEN 'PDF of ' || file_id END AS extracted_text,
  CASE WHEN doc_id % 3 = 0 THEN 'encrypted' END AS error FROM docs WHERE file_format = 'PDF'""",
)
def pdf_extracted(t: Tables) -> DataFrame:
    """A PDF extractor that the caller brings; a document that it refuses fails alone."""

    def read(data: bytes) -> str:
        number = data.decode().removeprefix("%PDF-")
        if int(number) % 3 == 0:
            raise ValueError("encrypted")
        return f"PDF of {number}"

    rows = t.docs.where(F.col("file_format") == "PDF")
    contents = rows.select(F.col("file_name").alias("location"), F.encode(F.concat(F.lit("%PDF-"), "file_id"), "utf-8").alias("content"))
    todo = rows.select("file_id", "file_format", F.col("file_name").alias("current_location"))
    return extract.extract_text(todo, contents, {"PDF": read}).select("file_id", "extracted_text", "error")


# -- custody reports as files ------------------------------------------------------------------------------------------------------
def _report(t: Tables, kind: str, cells: dict[str, Column]) -> DataFrame:
    """Line items written as a custody report of one kind, every cell as text, and scanned; other columns are left blank."""
    folder = new_path(t.spark, kind)
    rows = t.raw("lineitem").select(*[cells.get(c, F.lit("-")).cast("string").alias(c) for c in CUSTODY_REPORTS[kind]])
    rows.write.option("header", "true").csv(folder)
    return custody.scan_report(t.spark, folder, kind)


def _key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


_KEY = "l_orderkey || '-' || l_linenumber"


@query(
    "report_transactions",
    f"""SELECT {_KEY} AS txn_id, CAST(l_shipdate AS DATE)::VARCHAR AS trade_date, '0' || l_partkey AS cusip, l_quantity AS quantity,
  CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE AS gross_value_usd
FROM lineitem""",
)
def report_transactions(t: Tables) -> DataFrame:
    """Thousand separators, leading zeros and dates come back as what they are."""
    found = _report(
        t,
        "transactions",
        {
            "Txn_ID": _key(),
            "Trade_Date": F.col("l_shipdate").cast("date"),
            "CUSIP": F.concat(F.lit("0"), F.col("l_partkey").cast("string")),
            "Quantity": F.format_number("l_quantity", 0),
            "Gross_Value_USD": F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2)),
        },
    )
    return found.select("txn_id", "trade_date", "cusip", "quantity", "gross_value_usd")


@query(
    "report_surcharges",
    f"""SELECT {_KEY} AS surcharge_id, CASE WHEN l_linenumber = 1 THEN 'flat' ELSE round(l_discount * 100)::BIGINT || '%' END AS surcharge_rate,
  CASE WHEN l_linenumber <> 1 THEN round(l_discount * 100) END AS rate_pct, CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE AS base_amount_usd
FROM lineitem""",
)
def report_surcharges(t: Tables) -> DataFrame:
    percent = F.concat(F.round(F.col("l_discount") * 100).cast("bigint").cast("string"), F.lit("%"))
    found = _report(
        t,
        "surcharges",
        {
            "Surcharge_ID": _key(),
            "Surcharge_Rate": F.when(F.col("l_linenumber") == 1, F.lit("flat")).otherwise(percent),
            "Base_Amount_USD": F.col("l_extendedprice").cast("decimal(18,2)"),
        },
    )
    return found.select("surcharge_id", "surcharge_rate", "rate_pct", "base_amount_usd")


@query(
    "report_income",
    f"""SELECT {_KEY} AS income_id, CASE WHEN l_linenumber <> 2 THEN CAST(l_shipdate AS DATE)::VARCHAR END AS pay_date,
  CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE AS gross_amount_usd, NULL::DOUBLE AS tax_withheld_usd
FROM lineitem""",
)
def report_income(t: Tables) -> DataFrame:
    """Cells that are no date or no amount become null."""
    found = _report(
        t,
        "income",
        {
            "Income_ID": _key(),
            "Pay_Date": F.when(F.col("l_linenumber") == 2, F.lit("pending")).otherwise(F.col("l_shipdate").cast("date").cast("string")),
            "Gross_Amount_USD": F.col("l_extendedprice").cast("decimal(18,2)"),
        },
    )
    return found.select("income_id", "pay_date", "gross_amount_usd", "tax_withheld_usd")


@query("report_tax_profile", "SELECT c_name AS field, c_mktsegment || ' – \"' || c_custkey || '\", x' AS value FROM customer")
def report_tax_profile(t: Tables) -> DataFrame:
    """Values with quotes, commas and dashes that are no ASCII."""
    folder = new_path(t.spark, "tax-profile")
    value = F.concat("c_mktsegment", F.lit(' – "'), F.col("c_custkey").cast("string"), F.lit('", x'))
    t.raw("customer").select(F.col("c_name").alias("Field"), value.alias("Value")).write.option("header", "true").option("escape", '"').csv(folder)
    return custody.scan_report(t.spark, folder, "tax_profile")
