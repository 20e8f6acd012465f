"""Keys, similarity and name evidence: fixed cases and properties."""

from __future__ import annotations

from difflib import SequenceMatcher

import pytest
from hypothesis import given
from hypothesis import strategies as st

from rosterline.functions import evidence, normalize, similarity

INITIALS, OMISSION = evidence.PATTERNS[True, False], evidence.PATTERNS[False, True]

WORDS = st.text("abcçğıiİIöşüÜ -.", max_size=18)


@pytest.mark.parametrize(("kind", "text", "want"), [
    ("match", "  ÇAĞRI  Işık-İlkokulu ", "cagri isik ilkokulu"), ("match", "Аhmеt Κaya", "ahmet kaya"), ("legacy", "Κaya x", "aya x"),
    ("availability", "İSTANBUL / Ilgaz!", "istanbul ilgaz"), ("duplicate", "Ali  -  Can", "ali - can"), ("comparison", "IŞIK  İL", "ışık il"),
    ("fuzzy", "IŞIK-İL", "isik il"), ("strict", "ali ışık i", "ALİ IŞIK İ"), ("loose", "ali ışık", "ALI ISIK"), ("search", "IŞIK İLKOKULU", "isik ilkokulu"),
    ("fold", "Ç.İyi  ğ", "C IYI G"), ("section", "4 - B Şubesi", "b"), ("section_letter", "i", "İ"), ("period_section", "4a", ""), ("roster", " A  B ", "a b"),
])
def test_keys(kind, text, want):
    assert normalize.NORMALISERS[kind](text) == want


def test_cells():
    assert [normalize.cell_text(x) for x in (None, 3.0, 3.5, " a ", True)] == ["", "3", "3.5", "a", "True"]
    assert normalize.typed_key(1) == normalize.typed_key(1.0) != normalize.typed_key(True) and normalize.typed_key("1") != normalize.typed_key(1)
    assert [normalize.is_score(x) for x in (3, "3,0", "3.00", True, "x", None, 2)] == [True, True, True, False, False, False, False]
    assert normalize.split_location("A / B / C") == ("A", "B / C") and normalize.split_location("A /") is None
    assert normalize.label_key("district", "Merkez İlçesi") == "MERKEZ" and normalize.repaired("Ã‡") != "" and normalize.is_formula(" =A1")
    assert [normalize.grade_matches(x, 3) for x in (3, "3,0", True, "", "4")] == [True, True, False, False, False]


@given(WORDS, WORDS)
def test_similarity_bounds(a, b):
    for rule in (similarity.ratio, similarity.sorted_ratio):
        assert 0 <= rule(a, b) <= 100
    base, better, _ = evidence.adjusted(normalize.match_key(a), normalize.match_key(b))
    assert better >= base
    if a and b and a != b:
        assert similarity.ratio(a, b) == SequenceMatcher(None, a, b, autojunk=False).ratio() * 100.0
        assert similarity.ratio(a, b) <= 200.0 * min(len(a), len(b)) / (len(a) + len(b)) + 1e-9


@given(WORDS)
def test_keys_are_stable(a):
    for kind in ("match", "fuzzy", "loose", "fold", "search"):
        once = normalize.NORMALISERS[kind](a)
        assert normalize.NORMALISERS[kind](once) == once


@pytest.mark.parametrize(("a", "b", "pattern", "score"), [
    ("k samed cil", "kaan samed cil", INITIALS, 97.0), ("ayse nur demir", "ayse nur demir kaya", OMISSION, 97.0),
    ("ayse nur demir", "ayse nur demir kaya oz", OMISSION, 94.0), ("a cil", "ali cil", INITIALS, None),
    ("ayse nur", "ayse nur kaya", OMISSION, None), ("ali veli can", "ali veli can ali", OMISSION, None),
    ("ali can", "ali can", "", None), ("ali can3 x", "ali can3 xy", "", None), ("ali veli", "can efe", "", None), ("", "a", "", None),
    ("a b can", "ali bora can", INITIALS, None), ("k abcde fghij", "kaan abcde fghij", INITIALS, 97.0),
])
def test_evidence(a, b, pattern, score):
    got = evidence.name_evidence(a, b)
    assert (got.pattern, got.rule_score) == (pattern, score)


def test_average_of_ninety_is_enough_with_initials():
    got = evidence.name_evidence("k abcde fghijk", "kaan abcdx fghijk")
    assert got.full_parts_similarity == 90.0 and got.rule_score == 94.0
    assert evidence.name_evidence("abcde fghij klmno", "abcdx fghij klmno pq").pattern == ""


def test_snapping():
    words = ["ÇOK İYİ", "İYİ", "GELİŞTİRİLMELİ"]
    assert [similarity.snapped(x, words) for x in ("COK IYl", "iyi", "GELISTlRILMELI", "", "zzz")] == ["ÇOK İYİ", "İYİ", "GELİŞTİRİLMELİ", "", ""]
