"""Column functions against hand-written expectations and plain-Python brute force."""

from __future__ import annotations

import datetime as dt
import html
import itertools
from datetime import date, datetime
from decimal import ROUND_CEILING, Decimal

import pytest
from pyspark.sql import functions as F

from hazardbook.functions import cvss, identifiers, jsontext, markup, nested, strings, times


def values(spark, inputs, build, kind="string"):
    """One output per input, in order."""
    frame = spark.createDataFrame(list(enumerate(inputs)), f"i int, x {kind}")
    return [r.y for r in frame.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


def test_iso_timestamp_any_session_zone(spark):
    texts = [
        "2024-01-02T03:04:05Z",
        "2024-01-02T03:04:05.678901+09:00",
        "2024-01-02T03:04:05-0330",
        "2024-01-02T03:04:05",
        "2024-01-02",
        "2024-1-2",
        "nonsense",
        "",
        None,
    ]
    expected = [
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 1, 18, 4, 5, 678901),
        datetime(2024, 1, 2, 6, 34, 5),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2),
        None,
        None,
        None,
        None,
    ]
    assert values(spark, texts, times.iso_timestamp) == expected
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert values(spark, texts, times.iso_timestamp) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iso_dates(spark):
    texts = ["2024-02-29", "2023-02-29", "2024", "2024-1-2", " 2024-01-02", None]
    assert values(spark, texts, times.iso_date) == [date(2024, 2, 29)] + [None] * 5
    trimmed = values(spark, texts, lambda x: times.iso_date(x, trim=True))
    assert trimmed[4] == date(2024, 1, 2)
    found = values(spark, ["on 2024-01-02 and 2025-01-01", "2024-13-01", "no"], times.first_iso_date)
    assert found == [date(2024, 1, 2), None, None]


def test_text_helpers(spark):
    assert values(spark, [" 12 ", "-3", "1.5", "", "x", None], strings.parse_int) == [12, -3, None, None, None, None]
    assert values(spark, ["a, b ,, c\n", "", None], strings.comma_items) == [["a", "b", "c"], [], []]
    assert values(spark, ["1", " 1 ", "0", None], strings.is_one) == [True, True, False, False]
    codes = ["CVE-2024-1;X;CVE-2024-1", "", None]
    assert values(spark, codes, strings.find_cve_ids) == [["CVE-2024-1", "CVE-2024-1"], [], []]
    signed = ["id: a\n# digest: 1\n", "id: a\n# digest: 22", "id: a\n"]
    assert len(set(values(spark, signed, strings.content_digest))) == 1


def test_identifiers(spark):
    text = (
        "CVE:CVE-2026-1281, cve-2026-1340 GHSA-abcd-1234-wxyz GO-2024-12 PYSEC-2023-45 "
        "RUSTSEC-2024-0001 CVE-2026-1281 xCVE-2024-1111 éCVE-2024-2222 CVE-2024-333a"
    )
    assert values(spark, [text], identifiers.extract_identifiers)[0] == [
        "CVE-2026-1281",
        "CVE-2026-1340",
        "GHSA-ABCD-1234-WXYZ",
        "GO-2024-12",
        "PYSEC-2023-45",
        "RUSTSEC-2024-0001",
    ]


def test_excerpt_matches_slicing(spark):
    texts = ["a" * 100 + " cve-2024-1234 " + "b" * 100, "CVE-2024-1234", "x" * 300, "ß" * 70 + "CVE-2024-1234 end"]

    def slice_around(text, wanted="CVE-2024-1234", size=120):
        at = text.upper().find(wanted)
        if at < 0:
            return text[:size]
        return text[max(0, at - 60) : min(len(text), at + len(wanted) + 60)].strip()

    built = values(
        spark, texts, lambda x: identifiers.excerpt_around(x, F.lit("CVE-2024-1234"), F.upper(x))
    )
    assert built == [slice_around(t) for t in texts]


def test_markup(spark):
    texts = [
        'a<RuleID id="1" />b &amp;lt; <b>&eacute;&#x41;&notit;</b>  &nbsp;\n end ',
        "plain",
        None,
    ]
    expected = " ".join(html.unescape("a b &amp;lt;  &eacute;&#x41;&notit; end").split())
    assert values(spark, texts, markup.plain_text) == [expected, "plain", None]


def test_frontmatter_last_value_wins(spark):
    page = "---\ntitle: 'One'\n  title: indented\ntitle: \"Two: three\"\nempty: \n---\nbody"
    entries = lambda x: markup.frontmatter_entries(markup.frontmatter_block(x))
    build = lambda x: F.array(*[markup.frontmatter_value(entries(x), k) for k in ("title", "empty", "none")])
    assert values(spark, [page, "no block"], build) == [["Two: three", None, None], [None] * 3]
    assert values(spark, [page, "no block"], markup.page_body) == ["body", "no block"]


def test_json_types_are_strict(spark):
    docs = ['{"s":"x","n":5,"b":true,"l":["a",1],"t":" 2.5 "}', '{"s":"","b":"true"}', "[]"]
    v = F.try_parse_json
    assert values(spark, docs, lambda x: jsontext.json_string(v(x), "$.s")) == ["x", None, None]
    assert values(spark, docs, lambda x: jsontext.json_string(v(x), "$.n"))[0] is None
    assert values(spark, docs, lambda x: jsontext.json_number(v(x), "$.t"))[0] == 2.5
    assert values(spark, docs, lambda x: jsontext.json_number(v(x), "$.b"))[0] is None
    assert values(spark, docs, lambda x: jsontext.json_true(v(x), "$.b")) == [True, False, False]
    assert values(spark, docs, lambda x: jsontext.json_items(v(x), "$.l"))[0] == ["a", "1"]
    assert values(spark, ['{"b": 1, "a": {"z": 2, "c": 3}}'], jsontext.canonical_json) == ['{"a":{"c":3,"z":2},"b":1}']


def _exact_score(version, av, ac, pr, ui, scope, c, i, a):
    """The published formula in exact decimals."""
    d = lambda x: Decimal(str(x))
    w = cvss.WEIGHTS
    loss = 1 - (1 - d(w["C"][c])) * (1 - d(w["I"][i])) * (1 - d(w["A"][a]))
    privileges = cvss.PRIVILEGES_CHANGED if scope == "C" else cvss.PRIVILEGES_UNCHANGED
    if scope == "C":
        impact = d("7.52") * (loss - d("0.029")) - d("3.25") * (loss - d("0.02")) ** 15
    else:
        impact = d("6.42") * loss
    if impact <= 0:
        return 0.0
    exploit = d("8.22") * d(w["AV"][av]) * d(w["AC"][ac]) * d(privileges[pr]) * d(w["UI"][ui])
    raw = min((d("1.08") if scope == "C" else 1) * (impact + exploit), Decimal(10))
    if version == "3.1":
        whole = int((raw * 100000).to_integral_value(rounding="ROUND_HALF_UP"))
        return whole / 100000 if whole % 10000 == 0 else (whole // 10000 + 1) / 10
    return float((raw * 10).to_integral_value(rounding=ROUND_CEILING) / 10)


def test_cvss_scores_of_every_base_vector(spark):
    names = cvss.BASE_METRICS
    combos = [
        (version, *letters)
        for version in ("3.0", "3.1")
        for letters in itertools.product(*[cvss.ALLOWED_3X[n] for n in names])
    ]
    vectors = [
        f"CVSS:{c[0]}/" + "/".join(f"{n}:{x}" for n, x in zip(names, c[1:], strict=True))
        for c in combos
    ]
    assert len(vectors) == 2 * 2592
    assert values(spark, vectors, cvss.v3_base_score) == [_exact_score(*c) for c in combos]


@pytest.mark.parametrize(
    "vector",
    [
        "CVSS:3.1/broken",
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H",  # one missing
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H/A:H",  # repeated
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:X",  # bad letter
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H/",  # trailing slash
        "CVSS:2.0/AV:N",
    ],
)
def test_broken_vectors_have_no_score(spark, vector):
    build = lambda x: F.struct(cvss.v3_base_score(x).alias("s"), cvss.vector_version(x).alias("v"))
    assert values(spark, [vector], build) == [(None, None)]


def test_optional_metrics_and_any_order(spark):
    vector = "CVSS:3.1/A:H/I:H/C:H/S:U/UI:N/PR:N/AC:L/AV:N/E:P/RL:O/MAV:X/MC:N"
    assert values(spark, [vector], cvss.v3_base_score) == [9.8]
    four = "CVSS:4.0/AV:N/AC:L/AT:N/PR:N/UI:N/VC:H/VI:H/VA:H/SC:N/SI:N/SA:N"
    assert values(spark, [four], cvss.vector_version) == ["4.0"]


# Events of a range (i introduced, f fixed, l last affected, numbered from 0) and the ranges
# they mean: (introduced, fixed, last affected).
RANGES = {
    "": [(None, None, None)],
    "i": [("0", None, None)],
    "f": [(None, None, None)],
    "l": [(None, None, None)],
    "if": [("0", "1", None)],
    "il": [("0", None, "1")],
    "ii": [("0", None, None), ("1", None, None)],
    "fi": [("1", None, None)],
    "li": [("1", None, None)],
    "ifl": [("0", "1", "2")],
    "iff": [("0", "2", None)],
    "ill": [("0", None, "2")],
    "ifi": [("0", "1", None), ("2", None, None)],
    "fif": [("1", "2", None)],
    "ifif": [("0", "1", None), ("2", "3", None)],
    "ilil": [("0", None, "1"), ("2", None, "3")],
    "iifl": [("0", None, None), ("1", "2", "3")],
    "lfil": [("2", None, "3")],
}
KINDS = {"i": "introduced", "f": "fixed", "l": "last_affected"}


def test_affected_ranges(spark):
    event = "struct<introduced:string,fixed:string,last_affected:string>"
    kind = (
        "array<struct<package:struct<ecosystem:string,name:string>,"
        f"ranges:array<struct<events:array<{event}>>>>>"
    )

    def ranges(letters):
        return [{"events": [{KINDS[x]: str(i)} for i, x in enumerate(letters)]}]

    package = {"ecosystem": "e", "name": "p"}
    cases = [[{"package": package, "ranges": ranges(letters)}] for letters in RANGES]
    built = values(spark, cases, nested.affected_ranges, kind)
    plain = [[(r.introduced, r.fixed, r.last_affected) for r in row] for row in built]
    assert plain == list(RANGES.values())
    two = [{"package": package, "ranges": ranges("if") + ranges("il")},
           {"package": {"ecosystem": "e", "name": "q"}, "ranges": None}]
    built = values(spark, [two, None], nested.affected_ranges, kind)
    assert [(r.package, r.introduced, r.fixed, r.last_affected) for r in built[0]] == [
        ("p", "0", "1", None), ("p", "0", None, "1"), ("q", None, None, None)]
    assert built[1] == []


def test_iso_forms(spark):
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    accepted = {
        "20240102T030405Z": moment,
        "2024-01-02T03": dt.datetime(2024, 1, 2, 3),
        "2024-01-02 0304": dt.datetime(2024, 1, 2, 3, 4),
        "2024-01-02T03:04:05,5Z": dt.datetime(2024, 1, 2, 3, 4, 5, 500000),
        "2024-01-02T03:04:05.1234567+01": dt.datetime(2024, 1, 2, 2, 4, 5, 123456),
        "2024-W01-1": dt.datetime(2024, 1, 1),
        "2024W011T03:04": dt.datetime(2024, 1, 1, 3, 4),
        "2020-W53": dt.datetime(2020, 12, 28),
        "2021-W01": dt.datetime(2021, 1, 4),
        "20240102": dt.datetime(2024, 1, 2),
        "2024-01-02Z": dt.datetime(2024, 1, 2),
        "2024-01-02x03:04:05-00:00:05": dt.datetime(2024, 1, 2, 3, 4, 10),
        "2024-01-02T23:00-0130": dt.datetime(2024, 1, 3, 0, 30),
    }
    rejected = ["2021-W53", "2024-W00", "2024-W01-8", "2024-W01-0", "2024-013", "2024-01", "2024", "2024-1-2", "2024-02-30",
                "2024-01-02T24:00", "2024-01-02T03:0405", "2024-01-02T3", "2024-01-02T03:04:05z", "2024-01-02T03:04:05+1",
                "2024-01-02T", "", " 2024-01-02", "2024-01-02T03:04:60", "2024-01-02T03:04:05.Z", None]
    assert values(spark, [*accepted, *rejected], times.iso_timestamp) == [*accepted.values(), *[None] * len(rejected)]
    dates = {"20240102": dt.date(2024, 1, 2), "2024-W01-1": dt.date(2024, 1, 1), "2024W01": dt.date(2024, 1, 1), "2024-02-29": dt.date(2024, 2, 29)}
    wrong = ["2023-02-29", "20230229", "2024-01-02T03", "2024-W54-1", "2024", "202401", None]
    assert values(spark, [*dates, *wrong], times.iso_date) == [*dates.values(), *[None] * len(wrong)]


def test_number_texts(spark):
    texts = ["1.5", " 2 ", "1_000", "1e3", ".5", "5.", "-0", "inf", "9.8d", "9.8f", "0x1", "1__0", "_1", "1e", "", "x", None]
    numbers = [1.5, 2.0, 1000.0, 1000.0, 0.5, 5.0, 0.0, float("inf"), *[None] * 9]
    assert values(spark, texts, jsontext.number_text) == numbers


def test_malformed_v4_vectors_have_no_version(spark):
    four = "CVSS:4.0/AV:N/AC:L/AT:N/PR:N/UI:N/VC:H/VI:H/VA:H/SC:N/SI:N/SA:N"
    good = [four, four + "/E:A/U:Red/MSI:S", "CVSS:4.0/SA:N" + four[8:].replace("/SA:N", "")]
    bad = [four[: -len("/SA:N")], four + "/SA:N", four + "/", four + "/E:Q", four + "/ZZ:N", four.replace("AV:N", "AV:X"), four.replace("4.0", "4.1")]
    assert values(spark, good + bad, cvss.vector_version) == ["4.0"] * 3 + [None] * 7
