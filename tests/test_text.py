from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricetrail.functions import months, numbers, text

NBSP = " "


@pytest.mark.parametrize("raw, want", [
    ("  a \t b\n", "a b"), (f"a{NBSP}{NBSP}b{NBSP}", "a b"), (" \x1c ", None), ("", None), (None, None),
])
def test_normalize_text(value, raw, want):
    assert value(text.normalize_text, raw) == want


@pytest.mark.parametrize("raw, want", [
    ("a;b:c|d/e", "a, b, c, d, e"), ("a , , b", "a, b"), ("a,,,b", "a, b"), ("a ,b", "a, b"),
    (",", ","), (", , ,", ", ,"), ("", None), (None, None), (f"x{NBSP};y", "x, y"),
])
def test_normalize_punct(value, raw, want):
    assert value(text.normalize_punct, raw) == want
    via_array = value(lambda c: text.identifier_texts(F.array(c))[0], raw)
    assert via_array == want


@pytest.mark.parametrize("raw, want", [
    ("75 mg, 0.5 mL", "75 mg 0.5 mL"), ("1,000 mg", "1,000 mg"), ("injection, solution", "injection solution"),
    ("2, 3", "2, 3"), ("a,5", "a,5"), (None, None),
])
def test_amt_pack(value, raw, want):
    assert value(text.amt_pack, raw) == want


@pytest.mark.parametrize("raw, want", [
    (" Film  Coated Tablets, 30 ", "film-coated tablet 30"), ("Capsules: 5.5 mL", "capsule 55 ml"),
    ("NaN", ""), ("None", ""), ("none.", "none"), (None, ""), ("multitablets", "multitablets"), ("a . b", "a b"),
])
def test_canon_value(value, raw, want):
    assert value(text.canon_value, raw) == want


@pytest.mark.parametrize("x, y, want", [("a ", " b", "a_b"), (None, "b", "b"), ("a", " ", "a"), (None, None, "")])
def test_joined_label(value, x, y, want):
    assert value(text.joined_label, x, y) == want


@pytest.mark.parametrize("raw, want", [
    ("1", "F1"), ("F1 ", "F1"), ("60", "F2"), ("F2", "F2"), ("cDl", "CDL"), ("", None), (None, None), (" X ", "X"),
])
def test_formulary(value, raw, want):
    assert value(text.formulary, raw) == want


@pytest.mark.parametrize("code, want", [
    ("A_15_YR_F1", "15-year anniversary"), ("A_5_YR_F1", "5-year anniversary"), ("10_YR_F1", "10-year anniversary"),
    ("X_PD_FLOWON_5_YR_F1", "X_PD_FLOWON_5_YR_F1"), ("APA_NB", "APA_NB"), ("LEGIS", "15-year anniversary (1.48%)"),
    ("Q_NB", "First new brand"), ("Q_PD", "Price disclosure"), ("Q", "Q"), (None, None),
])
def test_event_label(value, code, want):
    assert value(text.event_label, code) == want


@pytest.mark.parametrize("raw, want", [
    ("14797T, 14825g", ["14797t", "14825g"]), ("a1 b2", ["a1", "b2"]), ("a1 two", ["a1 two"]), (" A1 ", ["a1"]),
    ("a1;\n;b2", ["a1", "b2"]), ("", []), (",", []),
])
def test_search_tokens(value, raw, want):
    assert value(text.search_tokens, raw) == want


def test_display_name_skips_empty_parts(value):
    assert value(lambda *c: text.display_name(c), "a ", None, " ", "nan", "b") == "a · b"


def test_hashed_key_keeps_parts_apart(value):
    def key(*c):
        return text.hashed_key(c)

    assert value(key, "a:1", "b") != value(key, "a", "1:b")
    assert value(key, "a", None) == value(key, "a", "")


@pytest.mark.parametrize("raw, want", [
    ("102.0", "102"), ("102", "102"), (" 102 ", "102"), ("ORG7", "ORG7"), ("102.5", "102.5"), ("1e2", "1e2"), ("", None),
    ("9007199254740993", "9007199254740993"), ("9007199254740992.0", "9007199254740992"), (None, None),
])
def test_whole_id(value, raw, want):
    assert value(text.whole_id, raw) == want


@pytest.mark.parametrize("raw, single, multi", [
    ("1,234.50", 1234.5, 1234.5), ("$5.00", None, 5.0), ("nan", None, None), ("1d", None, None), ("inf", None, None),
    ("", None, None), (" .5 ", 0.5, 0.5), ("1e3", 1000.0, 1000.0), (None, None, None), ("-7.", -7.0, -7.0),
])
def test_price_number(value, raw, single, multi):
    assert value(numbers.price_number, raw) == single
    assert value(lambda c: numbers.price_number(c, currency_sign=True), raw) == multi


def test_too_large_price_is_null(value):
    assert value(lambda c: numbers.to_price(numbers.price_number(c)), "1e15") is None


def test_changes(value):
    assert value(lambda s, e: numbers.percent_change(s, e), "0", "5") is None
    assert value(lambda s, e: numbers.two_places(numbers.percent_change(s, e)), "8", "9") == Decimal("12.50")
    assert value(numbers.two_places, "0.125") == Decimal("0.13")


def test_money_and_percent_text(value):
    assert value(lambda c: numbers.money_text(c.cast("double")), "1234.5") == "$1,234.50"
    assert value(lambda c: numbers.percent_text(c.cast("double"), signed=True), "1.234") == "+1.23%"
    assert value(lambda c: numbers.percent_text(c.cast("double"), signed=True), "-1234.5") == "-1234.50%"


@pytest.mark.parametrize("label, want", [
    ("AEMP Jan 95", "1995-01-01"), ("AEMP Feb 68", "2068-02-01"), ("AEMP Mar 69", "1969-03-01"), ("Jan 95", None),
])
def test_label_month(value, label, want):
    got = value(months.label_month, label)
    assert (got and got.isoformat()) == want


def test_labels_agree_on_both_sides(value):
    for m in months.months_between(*[months.month_of(x) for x in ("AEMP Nov 24", "AEMP Feb 25")]):
        assert value(lambda c: months.month_label(c.cast("date")), m.isoformat()) == months.label_of(m)
