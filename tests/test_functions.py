from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerleaf.functions import lookups, money, paths, times, vectors
from ledgerleaf.functions import text as tx


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_paths(spark):
    path = F.lit("validated/ACC-1/some.report.csv")
    got = one(
        spark,
        paths.file_name(path),
        paths.file_extension(paths.file_name(path)),
        paths.file_extension(F.lit("README")),
        paths.file_extension(F.lit("odd.")),
        paths.account_folder(path),
        paths.part(path, 1),
        paths.part(path, 9),
        paths.stage_key(F.lit("STAGE"), path),
        paths.archive_key(F.lit("A"), F.lit("id"), F.lit("n.pdf")),
    )
    assert got == (
        "some.report.csv", "CSV", "", "", "ACC-1", "validated", "", "@STAGE/some.report.csv", "archive/A/id/n.pdf",
    )


@pytest.mark.parametrize(
    "unit, start, end, crossed",
    [
        ("minute", "2024-01-01 10:00:59", "2024-01-01 10:01:01", 1),
        ("minute", "2024-01-01 10:00:00", "2024-01-01 10:00:59", 0),
        ("second", "2024-01-01 10:00:00.9", "2024-01-01 10:00:01.1", 1),
        ("hour", "2024-01-01 11:00:00", "2024-01-01 10:59:59", -1),
        ("day", "2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
    ],
)
def test_boundaries_are_counted(spark, unit, start, end, crossed):
    literal = lambda t: F.lit(t).cast("timestamp_ntz")
    assert one(spark, times.boundary_diff(unit, literal(start), literal(end))) == (crossed,)


def test_look_back_is_strict(spark):
    as_of = datetime(2024, 1, 31)
    edge = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert one(spark, times.older_than(edge, as_of, days=30), times.within_last(edge, as_of, days=30)) == (False, False)
    assert one(spark, times.older_than(edge, "2024-01-31T00:00:01+00:00", days=30)) == (True,)


def test_boundaries_ignore_clock_changes(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ntz = lambda t: F.lit(t).cast("timestamp_ntz")
        assert one(
            spark,
            times.boundary_diff("day", ntz("2024-03-09 12:00:00"), ntz("2024-03-11 12:00:00")),
            times.boundary_diff("minute", ntz("2024-03-10 01:30:00"), ntz("2024-03-10 03:30:00")),
            times.boundary_diff("minute", ntz("2024-03-10 10:00:59"), ntz("2024-03-10 10:01:01")),
        ) == (2, 120, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_types_are_trimmed_of_all_white_space(spark):
    assert one(spark, lookups.controlled_type(F.lit("\ttax_profile\n"))) == ("TAX_PROFILE",)


def test_amounts(spark):
    got = one(spark, *[money.amount(F.lit(t)) for t in ("$92,600.00", "100,000", "flat", "")], money.rate(F.lit("0.25%")))
    assert [None if v is None else float(v) for v in got] == [92600.0, 100000.0, None, None, 0.25]


def test_money_rounds_half_up(spark):
    got = one(spark, *[money.cents(F.lit(v).cast("decimal(18,4)")) for v in ("45.005", "-45.005", "2.675")])
    assert [str(v) for v in got] == ["45.01", "-45.01", "2.68"]


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.text(alphabet="ab \t\n\r\x0b\x0c\x1c\x1e\x1f\x85\u00a0\u2003\u2028\u3000.", max_size=40), min_size=1, max_size=60
    )
)
def test_clean_text_properties(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    cleaned = rows.select("i", tx.clean_text(F.col("t")).alias("c")).select("i", "c", tx.clean_text(F.col("c")).alias("again"))
    for row in cleaned.collect():
        assert row.again == row.c
        assert row.c.split() == texts[row.i].split()
        assert "\n\n\n" not in row.c and "  " not in row.c and "\t" not in row.c
        assert all(line == line.strip() for line in row.c.split("\n"))
        assert row.c == row.c.strip()


def test_clean_text_keeps_paragraphs(spark):
    assert one(spark, tx.clean_text(F.lit("  Hello   world  \n\n\n\nNew para"))) == ("Hello world\n\nNew para",)


def test_token_estimates(spark):
    assert one(spark, tx.token_estimate(F.lit("x" * 10)), tx.token_estimate(F.lit("x" * 9))) == (3, 2)


def test_fences(spark):
    assert one(spark, tx.strip_fences(F.lit('```JSON\n{"a": 1}\n```'))) == ('{"a": 1}',)
    assert one(spark, tx.strip_fences(F.lit("```json{}```"), ignore_case=False)) == ("{}",)


def test_completion_text(spark):
    responses = [F.lit('{"choices": [{"messages": "{\\"a\\": 1}"}]}'), F.lit('{"choices": []}'), F.lit("oops")]
    assert one(spark, *[tx.completion_text(r) for r in responses]) == ('{"a": 1}', None, None)


def test_labelled_row_drops_blanks(spark):
    row = spark.createDataFrame([("x", " ", None, "5")], "a string, b string, c string, d string")
    assert row.select(tx.labelled_row(row.columns)).first()[0] == "a: x | d: 5"
    assert row.select(tx.labelled_header(row.columns)).first()[0] == "Columns: a, b, c, d"


def test_lookups(spark):
    got = one(
        spark,
        lookups.controlled_type(F.lit(" tax_profile ")),
        lookups.controlled_type(F.lit("poem")),
        lookups.type_hint(F.lit("Billing_Surcharges_Q1.csv")),
        lookups.type_hint(F.lit("notes.txt")),
        lookups.content_type(F.lit("csv")),
        lookups.content_type(F.lit("exe")),
        lookups.status_rank(F.lit("EMBEDDED")),
        lookups.status_rank(F.lit("ARCHIVING")),
        lookups.clamp_index(F.lit(999), F.lit(5)),
        lookups.clamp_index(F.lit(-3), F.lit(5)),
    )
    assert got == ("TAX_PROFILE", "UNKNOWN", "SURCHARGE_STATEMENT", "UNKNOWN", "text/csv", "application/octet-stream", 5, 9, 4, 0)


@pytest.mark.parametrize(
    "failed, stuck, state, health",
    [(0, 0, "RUNNING", "HEALTHY"), (1, 0, "RUNNING", "NEEDS ATTENTION"), (0, 2, "PAUSED", "NEEDS ATTENTION"), (0, 0, "PAUSED", "WARNING")],
)
def test_health(spark, failed, stuck, state, health):
    assert one(spark, lookups.health(F.lit(failed), F.lit(stuck), F.lit(state))) == (health,)


def test_cosine(spark):
    a, b, zero = (F.lit(v) for v in ([1.0, 0.0], [1.0, 1.0], [0.0, 0.0]))
    got = one(spark, F.round(vectors.cosine_similarity(a, b), 6), vectors.cosine_similarity(a, zero), vectors.cosine_similarity(a, F.lit([1.0])))
    assert got == (0.707107, None, None)
