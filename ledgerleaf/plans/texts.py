"""Extraction, cleaning, chunking, embedding, classification and reply parsing over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import lookups
from ledgerleaf.functions import text as tx
from ledgerleaf.operators import chunk, classify, embed, extract, models, reports, search
from ledgerleaf.plans.adapters import Tables, pick, with_tables
from ledgerleaf.plans.catalog import query
from ledgerleaf.schemas import DOCUMENT_TYPES, TYPE_HINT_PREFIXES

# The character classes of functions.text, in the notation of DuckDB's regular expressions (fixed values).
_JS = r"\t\n\x0b\f\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
_ENDS = r"\r\x0b\f\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}"
_BLANKS = r"\t\x{1f} \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"


def sql_js_trim(text: str) -> str:
    return f"regexp_replace({text}, '^[{_JS}]+|[{_JS}]+$', '', 'g')"


def sql_clean(text: str) -> str:
    out = f"regexp_replace({text}, '\\r\\n|[{_ENDS}]', chr(10), 'g')"
    out = f"regexp_replace({out}, '[ \\t]+', ' ', 'g')"
    out = f"regexp_replace({out}, '(?m)^[{_BLANKS}]+|[{_BLANKS}]+$', '', 'g')"
    out = f"regexp_replace({out}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"regexp_replace({out}, '^\\n+|\\n+$', '', 'g')"


# Raw text with the irregularities the cleaner is for: tabs, odd line ends, runs of blank lines.
_MESSY_SQL = r"""'  ' || replace(replace(replace(text, '. ', '.' || chr(9) || '  '), chr(10),
  CASE doc_id % 4 WHEN 0 THEN chr(13) || chr(10) WHEN 1 THEN chr(10) || chr(10) || chr(10) || chr(10)
  WHEN 2 THEN ' ' || chr(12) ELSE chr(13) END), ',', ',' || chr(160)) || chr(10) || ' '"""


def _messy() -> Column:
    i = F.col("doc_id") % 4
    line_end = (
        F.when(i == 0, F.lit("\r\n")).when(i == 1, F.lit("\n\n\n\n")).when(i == 2, F.lit(" \f")).otherwise(F.lit("\r"))
    )
    text = F.replace(F.col("text"), F.lit(". "), F.lit(".\t  "))
    text = F.replace(F.replace(text, F.lit("\n"), line_end), F.lit(","), F.lit(",\u00a0"))
    return F.concat(F.lit("  "), text, F.lit("\n "))


@query("clean_text", f"SELECT doc_id, {sql_clean(_MESSY_SQL)} AS clean FROM documents")
def clean_text(t: Tables) -> DataFrame:
    return t.heavy("documents", "doc_id").select("doc_id", tx.clean_text(_messy()).alias("clean"))


@query(
    "labelled_text",
    """SELECT doc_id, 'Columns: doc_id, lang, source, text' AS header,
  concat_ws(' | ', 'doc_id: ' || doc_id, CASE WHEN trim(lang) <> '' THEN 'lang: ' || lang END,
    CASE WHEN trim(source) <> '' AND doc_id % 3 <> 0 THEN 'source: ' || source END,
    CASE WHEN trim(text, ' ') <> '' THEN 'text: ' || text END) AS labelled
FROM documents""",
)
def labelled_text(t: Tables) -> DataFrame:
    columns = ["doc_id", "lang", "source", "text"]
    rows = t.raw("documents").withColumn("source", F.when(F.col("doc_id") % 3 != 0, F.col("source")).otherwise(F.lit(" ")))
    return rows.select("doc_id", tx.labelled_header(columns).alias("header"), tx.labelled_row(columns).alias("labelled"))


@query(
    "extract_documents",
    with_tables("docs")
    + f"""SELECT file_id,
  CASE file_format WHEN 'CSV' THEN {sql_clean("'Columns: id, body' || chr(10) || 'id: ' || file_id || ' | body: ' || text")} END
    AS extracted_text,
  CASE file_format WHEN 'CSV' THEN length({sql_clean("'Columns: id, body' || chr(10) || 'id: ' || file_id || ' | body: ' || text")}) ELSE 0 END
    AS char_count,
  CASE file_format WHEN 'PDF' THEN 'No PDF extractor configured' WHEN 'XLSX' THEN 'File is not a zip file' WHEN 'TXT' THEN 'Unsupported file format: TXT'
    END AS error
FROM docs""",
)
def extract_documents(t: Tables) -> DataFrame:
    """Every document's text as the body cell of a small CSV; the other formats fail one by one."""
    cell = F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    data = F.concat(F.lit("id,body\r\n"), "file_id", F.lit(","), cell, F.lit("\r\n"))
    location = F.concat_ws("/", F.lit("stage"), "file_name")
    files = t.heavy_docs.select(location.alias("location"), F.encode(data, "utf-8").alias("content"))
    todo = t.docs.select("file_id", "file_format", location.alias("current_location"))
    return extract.extract_text(todo, files).withColumn("char_count", F.coalesce("char_count", F.lit(0)))


@query(
    "pending_extract",
    with_tables("registry", "texts", "mapping")
    + """SELECT file_id, file_name, file_format, client_account_id, current_location FROM registry r
WHERE processing_status = 'STAGED' AND client_account_id IN (SELECT client_account_id FROM mapping)
  AND NOT EXISTS (SELECT 1 FROM texts t WHERE t.file_id = r.file_id)""",
)
def pending_extract(t: Tables) -> DataFrame:
    return extract.pending(t.registry, t.texts, t.mapping)


@query(
    "pending_chunk",
    with_tables("registry", "texts")
    + """SELECT file_id, client_account_id, extracted_text FROM registry JOIN texts USING (file_id)
WHERE processing_status = 'TEXT_EXTRACTED'""",
)
def pending_chunk(t: Tables) -> DataFrame:
    return chunk.pending(t.registry, t.texts)


@query(
    "pending_classify",
    with_tables("registry", "texts", "classifications")
    + """SELECT file_id, file_name, substr(extracted_text, 1, 1500) AS excerpt FROM registry r JOIN texts USING (file_id)
WHERE processing_status = 'EMBEDDED' AND NOT EXISTS (SELECT 1 FROM classifications c WHERE c.file_id = r.file_id)""",
)
def pending_classify(t: Tables) -> DataFrame:
    return classify.pending(t.registry, t.texts, t.classifications).drop("extracted_text")


# Paragraph breaks are made by doubling some line ends, so that all branches of the chunker run.
_BROKEN_SQL = "CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(10) || chr(10)) ELSE text END"


def _broken() -> Column:
    doubled = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return F.when(F.col("doc_id") % 2 == 0, doubled).otherwise(F.col("text"))


def sql_chunks(source: str, key: str, text: str, target: int = 2000, overlap: int = 200) -> str:
    """CTEs that end in ``chunk_lists(key, chunks)``: the packing fold as ``list_reduce``."""
    piece = "{{'done': []::VARCHAR[], 'open': {t}, 'joiner': {j}}}"
    sentence = piece.format(t=sql_js_trim("s"), j="' '")
    paragraph = piece.format(t="p", j="chr(10) || chr(10)")
    return f"""paragraphs AS (
  SELECT {key}, list_filter(list_transform(regexp_split_to_array({text}, '\\n{{2,}}'), lambda x: {sql_js_trim("x")}),
    lambda x: x <> '') AS ps FROM {source}),
pieces AS (
  SELECT {key}, CASE WHEN length(ps[1]) + 1 > {target} THEN list_concat(
      list_transform(string_split(regexp_replace(ps[1], '([.!?])[{_JS}]+', '\\1' || chr(1), 'g'), chr(1)), lambda s: {sentence}),
      list_transform(ps[2:], lambda p: {paragraph}))
    ELSE list_transform(ps, lambda p: {paragraph}) END AS parts FROM paragraphs WHERE len(ps) > 0),
folded AS (
  SELECT {key}, list_reduce(parts, lambda a, x: CASE WHEN length(a.open) + length(x.open) + 1 <= {target}
    THEN {{'done': a.done, 'open': a.open || x.joiner || x.open, 'joiner': ''}}
    ELSE {{'done': list_append(a.done, a.open), 'open': right(a.open, {overlap}) || x.joiner || x.open, 'joiner': ''}}
    END) AS f FROM pieces),
chunk_lists AS (
  SELECT {key}, CASE WHEN {sql_js_trim("f.open")} <> '' THEN list_append(f.done, {sql_js_trim("f.open")}) ELSE f.done END
    AS chunks FROM folded)"""


@query(
    "chunk_documents",
    f"""WITH src AS (SELECT doc_id, {_BROKEN_SQL} AS body FROM documents),
{sql_chunks("src", "doc_id", "body")}
SELECT doc_id, i - 1 AS chunk_index, chunks[i] AS chunk_text, CAST(round(length(chunks[i]) / 4) AS BIGINT) AS token_count
FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM chunk_lists)""",
)
def chunk_documents(t: Tables) -> DataFrame:
    return chunk.chunk(t.heavy("documents", "doc_id").select("doc_id", _broken().alias("extracted_text")))


@query(
    "chunk_stats",
    f"""{with_tables("docs")}, {sql_chunks("docs", "file_id, file_name, file_format", "text")},
tokens AS (
  SELECT file_name, file_format, CAST(round(length(c) / 4) AS BIGINT) AS token_count
  FROM (SELECT file_name, file_format, unnest(chunks) AS c FROM chunk_lists))
SELECT file_name, file_format, count(*) AS total_chunks, min(token_count) AS min_tokens,
  CAST(round(avg(token_count)) AS BIGINT) AS avg_tokens, max(token_count) AS max_tokens
FROM tokens GROUP BY file_name, file_format""",
)
def chunk_stats(t: Tables) -> DataFrame:
    chunks = chunk.chunk(t.heavy_docs.select("file_id", F.col("text").alias("extracted_text")))
    return reports.chunk_stats(chunks, t.registry)


@query(
    "paragraph_explode",
    """SELECT doc_id, i - 1 AS chunk_index, lines[i] AS chunk_text,
  CAST(round(length(regexp_replace(lines[i], '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) / 4) AS BIGINT) AS token_count
FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
)
def paragraph_explode(t: Tables) -> DataFrame:
    return chunk.paragraphs(t.raw("documents").select("doc_id", F.col("text").alias("extracted_text")))


def sql_vectors(source: str, keys: str, text: str, width: int) -> str:
    """CTE body (keys, bucket, v): non-zero entries of the hashing embedding, in single precision."""
    return f"""SELECT {keys}, bucket, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {keys})) AS FLOAT) AS v FROM (
    SELECT {keys}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {width} AS bucket, CAST(count(*) AS DOUBLE) AS n
    FROM (SELECT {keys}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {source})
    GROUP BY ALL)"""


@query(
    "embed_hash",
    f"""WITH vectors AS ({sql_vectors("documents", "doc_id", "text", 256)})
SELECT doc_id, count(*) AS nonzero, round(sum(v::DOUBLE * v::DOUBLE), 5) AS squared_length,
  round(sum(v::DOUBLE * (bucket + 1)), 3) AS weighted_sum, 'hashing-256' AS model_name
FROM vectors GROUP BY doc_id""",
)
def embed_hash(t: Tables) -> DataFrame:
    """Fingerprint of each document's vector."""
    model = models.hashing_embedder(256)
    vectors = embed.embed(t.heavy("documents", "doc_id").select("doc_id", "text"), "text", model)
    total = F.aggregate(
        F.transform("embedding", lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x
    )
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    return vectors.select(
        "doc_id",
        F.size(F.filter("embedding", lambda v: v != 0)).cast("bigint").alias("nonzero"),
        F.round(squares, 5).alias("squared_length"),
        F.round(total, 3).alias("weighted_sum"),
        F.lit(model.name).alias("model_name"),
    )


def sql_classified(source: str, name: str, excerpt: str) -> str:
    """CTE body (source columns, best type, hits): the keyword rules as a chain of list filters."""
    scored = ", ".join(
        "{'hits': list_filter([" + ", ".join(f"'{k}'" for k in kws) + "]::VARCHAR[], lambda k: contains(hay, k)), "
        f"'type': '{name_}', 'description': '{description}'}}"
        for name_, (description, kws) in DOCUMENT_TYPES.items()
        if kws
    )
    none = f"{{'hits': []::VARCHAR[], 'type': 'UNKNOWN', 'description': '{DOCUMENT_TYPES['UNKNOWN'][0]}'}}"
    return f"""SELECT *, list_reduce([{none}, {scored}],
    lambda a, x: CASE WHEN len(x.hits) > len(a.hits) THEN x ELSE a END) AS best
  FROM (SELECT *, lower({name} || chr(10) || {excerpt}) AS hay FROM {source})"""


@query(
    "classify_rules",
    with_tables("docs", also=f"""scored AS ({sql_classified("docs", "file_name", "text")})""")
    + """SELECT file_id, best.type AS document_type, CASE WHEN len(best.hits) >= 2 THEN 'high'
    WHEN len(best.hits) = 1 THEN 'medium' ELSE 'low' END AS classification_confidence,
  CASE WHEN len(best.hits) = 0 THEN '[]' ELSE
    '["' || list_aggregate(best.hits, 'string_agg', '","') || '"]' END AS key_indicators,
  file_name || ': ' || best.description AS doc_summary, 'keyword-rules' AS model_name
FROM scored""",
)
def classify_rules(t: Tables) -> DataFrame:
    todo = t.heavy_docs.select("file_id", "file_name", F.col("text").alias("extracted_text"))
    return classify.classify(todo).drop("error")


@query(
    "classification_mix",
    with_tables("classifications")
    + """SELECT document_type, classification_confidence, model_name, count(*) AS file_count
FROM classifications GROUP BY ALL""",
)
def classification_mix(t: Tables) -> DataFrame:
    return reports.classification_mix(t.classifications)


@query(
    "type_hint",
    with_tables("docs")
    + "SELECT file_name, CASE "
    + " ".join(f"WHEN starts_with(lower(file_name), '{p}') THEN '{v}'" for p, v in TYPE_HINT_PREFIXES)
    + " ELSE 'UNKNOWN' END AS document_type FROM docs",
)
def type_hint(t: Tables) -> DataFrame:
    return t.docs.select("file_name", lookups.type_hint(F.col("file_name")).alias("document_type"))


# Model replies of many shapes; R is filled with text from the events.
_RERANK_REPLIES = (
    '{"best_candidate_index": 2, "confidence": "high", "reason": "R"}',
    '```json\n{"best_candidate_index": 1, "confidence": "low", "reason": "R"}\n```',
    '{"best_candidate_index": 999, "reason": "R"}',
    '{"best_candidate_index": "3", "confidence": "medium"}',
    '{"best_candidate_index": 2.7, "confidence": "high", "reason": "R"}',
    '{"best_candidate_index": null, "confidence": "high", "reason": "R"}',
    "no JSON here R",
    '{"confidence": "medium", "reason": "R"}',
    '{"best_candidate_index": -4, "confidence": "high", "reason": "R"}',
    "[1, 2]",
)


@query(
    "parse_rerank",
    f"""WITH replies AS (
  SELECT event_id, event_id % {len(_RERANK_REPLIES)} AS shape, repeat(event_type, 120) AS r FROM events)
SELECT event_id, CAST(CASE shape WHEN 0 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 2 WHEN 4 THEN 1 ELSE 0 END AS BIGINT) AS choice,
  CASE WHEN shape IN (0, 4, 8) THEN 'high' WHEN shape IN (2, 3, 7) THEN 'medium' ELSE 'low' END AS confidence,
  CASE WHEN shape IN (5, 6, 9) THEN '{search.PARSE_FAILED}' WHEN shape = 3 THEN '' ELSE r END AS reason,
  shape IN (5, 6, 9) AS fallback
FROM replies""",
)
def parse_rerank(t: Tables) -> DataFrame:
    reply = F.replace(pick(_RERANK_REPLIES, F.col("event_id")), F.lit("R"), F.repeat("event_type", F.lit(120)))
    replies = t.heavy("events", "event_id").select("event_id", reply.alias("reply"), F.lit(5).alias("n"))
    return search.with_parsed_rerank(replies, "reply", "n").drop("reply", "n")


@query(
    "completion_replies",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'reply to ' || event_type || ' ' || props END AS reply
FROM events""",
)
def completion_replies(t: Tables) -> DataFrame:
    """Replies taken out of service responses; a third of the responses has none."""
    reply = F.concat(F.lit("reply to "), "event_type", F.lit(" "), "props")
    choice = F.when(F.col("event_id") % 3 != 0, F.struct(reply.alias("messages")))
    response = F.to_json(F.struct(F.array_compact(F.array(choice)).alias("choices")))
    return t.raw("events").select("event_id", tx.completion_text(response).alias("reply"))


_CLASS_REPLIES = (
    '{"document_type": "tax_profile ", "confidence": "high", "key_indicators": ["K", "b"], "summary": "S"}',
    '```JSON\n{"document_type": "INCOME_REPORT", "summary": "S"}\n```',
    '{"document_type": "POEM", "confidence": "medium", "key_indicators": [], "summary": ""}',
    '{"document_type": "", "confidence": "", "key_indicators": null, "summary": "S"}',
    '{"document_type": 7, "confidence": "high"}',
    "S is not JSON",
    "null",
    "{}",
)


@query(
    "parse_classification",
    f"""WITH replies AS (
  SELECT event_id, event_id % {len(_CLASS_REPLIES)} AS shape, repeat(event_type, 500) AS s, event_type AS k FROM events)
SELECT event_id, CASE shape WHEN 0 THEN 'TAX_PROFILE' WHEN 1 THEN 'INCOME_REPORT' ELSE 'UNKNOWN' END AS document_type,
  CASE shape WHEN 0 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS classification_confidence,
  CASE shape WHEN 0 THEN '["' || k || '","b"]' ELSE '[]' END AS key_indicators,
  CASE WHEN shape IN (0, 1, 3) THEN s WHEN shape = 5 THEN 'Parse error: reply is not valid JSON'
    WHEN shape IN (4, 6) THEN 'Parse error: unexpected JSON shape' ELSE '' END AS doc_summary
FROM replies""",
)
def parse_classification(t: Tables) -> DataFrame:
    shape = pick(_CLASS_REPLIES, F.col("event_id"))
    reply = F.replace(shape, F.lit('"S"'), F.concat(F.lit('"'), F.repeat("event_type", F.lit(500)), F.lit('"')))
    reply = F.replace(reply, F.lit('"K"'), F.concat(F.lit('"'), "event_type", F.lit('"')))
    replies = t.heavy("events", "event_id").select("event_id", reply.alias("reply"))
    return classify.with_parsed_reply(replies, "reply").drop("reply")

