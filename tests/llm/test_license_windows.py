"""Notices that do not fill a line, a paragraph or a text."""

from ledgerleaf.llm import licenses

SCHEMA = "doc_id long, text string"
PROSE = "stone river cloud upper lower water under the old bridge by night"


def found(spark, text):
    rows = licenses.scan(spark.createDataFrame([(1, text)], SCHEMA)).collect()
    return sorted((r.kind, r.unit_no, r.license, round(r.dice, 3)) for r in rows)


def test_notice_inside_a_line(spark):
    assert found(spark, f"{PROSE} Released under the MIT License. Contact {PROSE}") == [("window", 12, "mit", 1.0)]
    assert found(spark, "Copyright 2020 X Corp and its contributors. All rights reserved.") == [("window", 7, "all-rights-reserved", 1.0)]


def test_notice_wrapped_over_lines_of_a_larger_paragraph(spark):
    assert found(spark, f"{PROSE}\n{PROSE} Released under\nthe MIT License {PROSE}\n{PROSE}") == [("window", 24, "mit", 1.0)]


def test_text_without_line_ends_holds_a_changed_permission_twice(spark):
    notice = licenses.TEMPLATES["mit-permission"].replace("free of charge", "without charge")
    rows = found(spark, f"{PROSE} {notice} {PROSE} {PROSE} {notice} {PROSE}")
    assert [r[:3] for r in rows] == [("window", 12, "mit-permission"), ("window", 12 + len(licenses.words_of(notice)) + 24, "mit-permission")]


def test_units_are_not_told_twice(spark):
    assert found(spark, f"{PROSE}\nReleased under the MIT License.\n{PROSE}") == [("line", 1, "mit", 1.0)]
    assert found(spark, f"{PROSE} released under a license {PROSE}") == []


def test_anchors_cannot_all_be_missing():
    for text in licenses.TEMPLATES.values():
        words = licenses.words_of(text)
        least, anchors = licenses.needed(words, licenses.THRESHOLD)
        assert sum(not {a, b} & set(anchors) for a, b in zip(words, words[1:])) < least
