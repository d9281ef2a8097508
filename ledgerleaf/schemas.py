"""Table schemas, status sets and fixed vocabularies shared by every job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Tables
# ---------------------------------------------------------------------------
_S, _L, _I, _B, _TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)


def _table(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in cols])


# Column names of tables and reports are fixed values.
DOCUMENT_REGISTRY = _table(
    ("file_id", _S),
    ("file_name", _S),
    ("file_format", _S),
    ("client_account_id", _S),
    ("account_id", _S),
    ("branch_id", _S),
    ("document_type", _S),
    ("file_hash", _S),
    ("file_size", _L),
    ("current_location", _S),
    ("processing_status", _S),
    ("source_system", _S),
    ("created_ts", _TS),
    ("updated_ts", _TS),
)

DOCUMENT_TEXT = _table(
    ("file_id", _S),
    ("extracted_text", _S),
    ("char_count", _L),
    ("extracted_ts", _TS),
)

DOCUMENT_CHUNKS = _table(
    ("file_id", _S),
    ("client_account_id", _S),
    ("chunk_index", _I),
    ("chunk_text", _S),
    ("embedding", T.ArrayType(T.FloatType())),
    ("token_count", _L),
    ("model_name", _S),
    ("created_ts", _TS),
)

DOCUMENT_CLASSIFICATION = _table(
    ("file_id", _S),
    ("document_type", _S),
    ("classification_confidence", _S),
    ("key_indicators", _S),
    ("doc_summary", _S),
    ("model_name", _S),
    ("classified_ts", _TS),
)

CLIENT_MAPPING = _table(
    ("account_id", _S),
    ("branch_id", _S),
    ("client_name", _S),
    ("client_account_id", _S),
    ("client_stage_name", _S),
    ("active_flag", _B),
)

PROCESSING_AUDIT = _table(
    ("file_id", _S),
    ("step_name", _S),
    ("status", _S),
    ("start_ts", _TS),
    ("end_ts", _TS),
    ("error_message", _S),
)

SEARCH_AUDIT = _table(
    ("client_account_id", _S),
    ("search_term", _S),
    ("result_file_id", _S),
    ("search_confidence", _S),
    ("result_count", _L),
    ("execution_time_ms", _L),
    ("search_ts", _TS),
)

STEP_RUNS = _table(
    ("name", _S),
    ("state", _S),
    ("scheduled_time", _TS),
    ("completed_time", _TS),
    ("return_value", _S),
    ("error_message", _S),
    ("batch_id", _L),
)

LANDING_FILES = _table(
    ("relative_path", _S),
    ("file_size", _L),
    ("last_modified", _TS),
    ("loaded_ts", _TS),
)

COLLECTION_REGISTRY = _table(
    ("custody_country", _S),
    ("legal_entity_id", _S),
    ("allowed_formats", T.ArrayType(_S)),
    ("source", _S),
    ("destination", _S),
    ("active_flag", _B),
)

SIDECAR = _table(
    ("file_id", _S),
    ("file_name", _S),
    ("file_format", _S),
    ("custody_country", _S),
    ("legal_entity_id", _S),
    ("allowed_formats", T.ArrayType(_S)),
    ("source", _S),
    ("destination", _S),
    ("account_id", _S),
    ("branch_id", _S),
    ("file_hash", _S),
    ("file_size", _L),
    ("source_system", _S),
    ("document_type_hint", _S),
    ("upload_ts", _S),
    ("period", _S),
    ("client_name", _S),
)

# Custody report columns: every cell is read as text (CUSIPs keep their leading zeros).
CUSTODY_REPORTS: dict[str, tuple[str, ...]] = {
    "transactions": (
        "Txn_ID", "Account_No", "Trade_Date", "Settlement_Date", "Security_Name", "CUSIP", "Txn_Type",
        "Quantity", "Price_USD", "Gross_Value_USD", "Commission_USD", "Settlement_Fee_USD", "Net_Value_USD",
    ),
    "surcharges": (
        "Surcharge_ID", "Account_No", "Invoice_Ref", "Surcharge_Type", "Description", "Applied_Date",
        "Base_Amount_USD", "Surcharge_Rate", "Surcharge_Amount_USD",
    ),
    "income": (
        "Income_ID", "Account_No", "Security_Name", "CUSIP", "Income_Type", "Ex_Date", "Pay_Date",
        "Gross_Amount_USD", "Tax_Withheld_USD", "Net_Amount_USD", "Processing_Fee_USD",
    ),
    "tax_profile": ("Field", "Value"),
}

# ---------------------------------------------------------------------------
# Status lifecycle (fixed values: the statuses and their sets)
# ---------------------------------------------------------------------------
SUPPORTED_FORMATS = ("PDF", "XLSX", "CSV")

# A document in one of these states is never overwritten by validation.
VALIDATION_FINAL = ("AVAILABLE", "CLASSIFIED", "ARCHIVED")
# A landed file whose document is already past staging is skipped by routing.
PAST_STAGING = ("TEXT_EXTRACTED", "CHUNKED", "EMBEDDED", "CLASSIFIED", "INDEXED", "AVAILABLE", "ARCHIVED")
# Everything outside this set counts as "in progress" for the stuck report.
SETTLED = ("AVAILABLE", "ARCHIVED", "FAILED")
# What a tenant may list.
TENANT_VISIBLE = ("AVAILABLE", "ARCHIVED")

# Fixed display order of the status summary; anything else sorts last.
STATUS_ORDER = ("RECEIVED", "VALIDATED", "STAGED", "TEXT_EXTRACTED", "EMBEDDED", "AVAILABLE", "FAILED", "ARCHIVED")
# Fixed display order of the four chained steps.
TASK_ORDER = ("ROUTING_TASK", "EXTRACT_TASK", "EMBED_TASK", "CLASSIFY_TASK")

# ---------------------------------------------------------------------------
# Document types: name (fixed value) -> (description and keywords of the stand-in classifier, free)
# ---------------------------------------------------------------------------
DOCUMENT_TYPES: dict[str, tuple[str, tuple[str, ...]]] = {
    "CUSTODY_BILLING_INVOICE": (
        "periodic invoice for safekeeping, settlement, income collection and filing services",
        ("billing_invoice", "invoice", "safekeeping", "net 30"),
    ),
    "PORTFOLIO_VALUATION": (
        "statement of holdings at market value with net asset value",
        ("valuation", "market value", "nav", "holdings"),
    ),
    "CUSTODY_TAX_SUMMARY": (
        "annual summary of dividends, capital gains and interest",
        ("tax_summary", "custody_tax", "1099", "capital gain"),
    ),
    "TAX_RECLAIM_APPLICATION": (
        "claim for withheld tax under a double tax treaty",
        ("tax_reclaim", "reclaim", "treaty", "withholding"),
    ),
    "CORPORATE_ACTIONS_BILLING": (
        "bill for processing corporate action events",
        ("corporate_actions_billing", "corporate action", "rights issue", "tender offer"),
    ),
    "TRANSACTION_REPORT": (
        "list of buy and sell trades with settlement dates, commissions and fees",
        ("billing_transactions", "txn_id", "trade_date", "settlement_date"),
    ),
    "SURCHARGE_STATEMENT": (
        "itemised surcharges such as late settlement or currency conversion",
        ("billing_surcharges", "surcharge_id", "surcharge_rate", "late settlement"),
    ),
    "INCOME_REPORT": (
        "income from corporate actions with gross, withheld and net amounts",
        ("actions_income", "income_id", "ex_date", "pay_date"),
    ),
    "TAX_PROFILE": (
        "client tax record: forms on file, reporting status, treaty rates",
        ("tax_profile", "fatca", "crs_status", "w8_w9"),
    ),
    "UNKNOWN": ("none of the above", ()),
}

# File-name prefixes (fixed values), tried in this order; the first match names the type.
TYPE_HINT_PREFIXES = (
    ("billing_invoice", "CUSTODY_BILLING_INVOICE"),
    ("billing_valuation", "PORTFOLIO_VALUATION"),
    ("custody_tax_document", "CUSTODY_TAX_SUMMARY"),
    ("tax_reclaim", "TAX_RECLAIM_APPLICATION"),
    ("custody_billing_corporate_actions", "CORPORATE_ACTIONS_BILLING"),
    ("billing_transactions", "TRANSACTION_REPORT"),
    ("billing_surcharges", "SURCHARGE_STATEMENT"),
    ("billing_corporate_actions_income", "INCOME_REPORT"),
    ("tax_profile", "TAX_PROFILE"),
)

# Content types by upper-case suffix (fixed values).
CONTENT_TYPES = {
    "PDF": "application/pdf",
    "XLSX": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "CSV": "text/csv",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"

# Seed rows of the client mapping (fixed values).
CLIENT_MAPPING_SEED = (
    ("GB-CUST-00421", "BRANCH-GLOBALBANK", "Apex Pension Fund LLC", "APEX_READER", "APEX_STAGE", True),
    ("GB-CUST-00532", "BRANCH-GLOBALBANK", "Meridian Asset Management", "MERIDIAN_READER", "MERIDIAN_STAGE", True),
    ("GB-CUST-00615", "BRANCH-GLOBALBANK", "Summit Endowment Fund", "SUMMIT_READER", "SUMMIT_STAGE", True),
)

# Client -> (country, legal entity, branch) of the upload manifest (fixed values); both client spellings.
MANIFEST_CLIENTS = (
    ("CLIENT_APEX", "US", "GB-CUST-00421", "BRANCH-GLOBALBANK"),
    ("CLIENT_MERIDIAN", "US", "GB-CUST-00532", "BRANCH-GLOBALBANK"),
    ("CLIENT_SUMMIT", "US", "GB-CUST-00615", "BRANCH-GLOBALBANK"),
    ("APEX_READER", "US", "GB-CUST-00421", "BRANCH-GLOBALBANK"),
    ("MERIDIAN_READER", "US", "GB-CUST-00532", "BRANCH-GLOBALBANK"),
    ("SUMMIT_READER", "US", "GB-CUST-00615", "BRANCH-GLOBALBANK"),
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table of the given schema."""
    return spark.createDataFrame([], schema)


def client_mapping_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CLIENT_MAPPING_SEED), CLIENT_MAPPING)


def manifest_clients(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(MANIFEST_CLIENTS), "client string, custody_country string, legal_entity_id string, branch_id string"
    )
