"""Document classification: prompt, model reply, controlled vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.functions import lookups
from ledgerleaf.functions import text as tx
from ledgerleaf.functions.times import ts_literal
from ledgerleaf.operators import models, state
from ledgerleaf.schemas import DOCUMENT_TYPES

# Of a document's text, for the prompt of a language model; rules see all of it.
EXCERPT_CHARS = 1500


def prompt(file_name: Column, excerpt: Column) -> Column:
    """Asks for one type of the vocabulary as a JSON object."""
    vocabulary = "\n".join(f"- {name}: {description}" for name, (description, _) in DOCUMENT_TYPES.items())
    head = "Assign one document type to this custody document.\n\nFilename: "
    tail = (
        "\n\nAllowed types:\n"
        + vocabulary
        + '\n\nAnswer with one JSON object and nothing else: {"document_type": one allowed type, '
        + '"confidence": "high", "medium" or "low", "key_indicators": [up to three strings], '
        + '"summary": one sentence}'
    )
    return F.concat(F.lit(head), file_name, F.lit("\nExcerpt:\n"), excerpt, F.lit(tail))


REPLY_FIELDS = ("document_type", "confidence", "key_indicators", "summary")


def with_parsed_reply(df: DataFrame, reply: str) -> DataFrame:
    """Adds document_type, classification_confidence, key_indicators and doc_summary from a model reply.

    Empty or missing fields take defaults (UNKNOWN, low, [], ''). A reply that is no JSON, or whose type or summary
    is no text, gives UNKNOWN / low and a summary that starts with ``Parse error:``. The reply is parsed once: every
    later step only looks at columns of the one before.
    """
    body = df.withColumn("__body", F.try_parse_json(tx.strip_fences(F.col(reply))))
    picked = body.withColumns({f"__{n}": F.try_variant_get("__body", f"$.{n}", "variant") for n in REPLY_FIELDS})
    typed = picked.withColumns(
        {
            **{f"__{n}_kind": F.coalesce(F.schema_of_variant(f"__{n}"), F.lit("VOID")) for n in REPLY_FIELDS},
            **{f"__{n}_text": F.try_variant_get(f"__{n}", "$", "string") for n in REPLY_FIELDS},
        }
    )

    def text(name: str) -> Column:
        return F.col(f"__{name}_text")

    def falsy(name: str) -> Column:
        return (F.col(f"__{name}_kind") == "VOID") | F.coalesce(text(name), F.lit("x")).isin("", "0", "false")

    def no_text(name: str) -> Column:
        return ~falsy(name) & (F.col(f"__{name}_kind") != "STRING")

    no_json = F.col("__body").isNull()
    broken = no_json | F.is_variant_null("__body") | no_text("document_type") | no_text("summary")
    message = F.when(no_json, F.lit("Parse error: reply is not valid JSON")).otherwise(
        F.lit("Parse error: unexpected JSON shape")
    )
    checked = typed.withColumn("__broken", broken)
    bad = F.col("__broken")
    return checked.withColumns(
        {
            "document_type": F.when(bad | falsy("document_type"), F.lit("UNKNOWN")).otherwise(
                lookups.controlled_type(text("document_type"))
            ),
            "classification_confidence": F.when(bad | falsy("confidence"), F.lit("low")).otherwise(text("confidence")),
            "key_indicators": F.when(bad | falsy("key_indicators"), F.lit("[]")).otherwise(
                F.to_json("__key_indicators")
            ),
            "doc_summary": F.when(bad, message)
            .when(falsy("summary"), F.lit(""))
            .otherwise(text("summary")),
        }
    ).select(
        *df.columns, "document_type", "classification_confidence", "key_indicators", "doc_summary"
    )


def pending(registry: DataFrame, texts: DataFrame, classifications: DataFrame) -> DataFrame:
    """EMBEDDED documents without a classification, with their text and its start."""
    ready = registry.where(F.col("processing_status") == "EMBEDDED").select("file_id", "file_name")
    ready = state.missing_from(ready, classifications, ["file_id"])
    excerpt = tx.truncate(F.col("extracted_text"), EXCERPT_CHARS).alias("excerpt")
    excerpts = texts.select("file_id", excerpt, "extracted_text")
    return ready.join(excerpts, "file_id")


def classify(todo: DataFrame, model: models.CompletionModel | None = None) -> DataFrame:
    """One row per document: type, confidence, indicators, summary, or an error from the model.

    ``todo`` holds (file_id, file_name, extracted_text). The prompt has the start of the text; the fact ``haystack`` has
    the file name and the whole text.
    """
    model = model or models.keyword_classifier()
    whole = F.coalesce("extracted_text", F.lit(""))
    excerpt = tx.truncate(whole, EXCERPT_CHARS)
    asked = todo.select(
        "file_id",
        "file_name",
        excerpt.alias("excerpt"),
        F.lower(F.concat_ws("\n", "file_name", whole)).alias("haystack"),
        prompt(F.col("file_name"), excerpt).alias("prompt"),
    )
    facts = F.struct("file_name", "excerpt", "haystack")
    answered = asked.withColumn("__raw", model.complete(F.col("prompt"), facts))
    reply = models.as_reply(F.col("__raw"), answered.schema["__raw"].dataType)
    replies = answered.select("file_id", F.coalesce(reply["reply"], F.lit("")).alias("reply"), reply["error"].alias("error"))
    parsed = with_parsed_reply(replies, "reply").withColumn("model_name", F.lit(model.name))
    return parsed.select(
        "file_id",
        "document_type",
        "classification_confidence",
        "key_indicators",
        "doc_summary",
        "model_name",
        "error",
    )


def classification_rows(outcomes: DataFrame, as_of) -> DataFrame:
    return (
        outcomes.where(F.col("error").isNull()).drop("error").withColumn("classified_ts", ts_literal(as_of))
    )


def registry_delta(registry: DataFrame, outcomes: DataFrame, as_of) -> DataFrame:
    """EMBEDDED goes straight to AVAILABLE and takes the type along."""
    return state.transition(registry, outcomes.select("file_id", "document_type", "error"), "AVAILABLE", as_of)


NAMES = ("classified", "failed")


def outcome_name() -> Column:
    return F.when(F.col("error").isNull(), F.lit("classified")).otherwise(F.lit("failed"))


def counters(outcomes: DataFrame) -> DataFrame:
    return state.counters(outcomes.select(outcome_name().alias("outcome")), "outcome", NAMES)
