"""Operators against plain versions and small cases."""

from __future__ import annotations

import random

import pytest
from rosterline.functions.similarity import label_ratio, ratio
from rosterline.operators import discovery, extraction, linkage, review, tracking
from rosterline.plans.fixtures import derived
from rosterline.sinks.xlsx import write_xlsx
from rosterline.sources import units, xlsx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def roster(spark):
    return derived(spark, SF, "roster").cache()


@pytest.fixture(scope="module")
def src(spark):
    return derived(spark, SF, "src").cache()


def test_classification_equals_plain_search(src, roster):
    people = [r.asDict() for r in roster.collect()]
    places = {}
    for p in people:
        places[p["district"], p["school"]] = min(p["row_number"], places.get((p["district"], p["school"]), 10**9))
    want = {}
    for s in src.collect():
        best = None
        for (d, c), row in places.items():
            a, b = ratio(s["district"], d), ratio(s["school"], c)
            if a >= 95 and b >= 95:
                best = max(best or (), ((s["district"], s["school"]) == (d, c), min(a, b), (a + b) / 2, b, a, -row, d, c))
        if best is None:
            want[s["src_row"]] = ("red_location", None)
            continue
        hits = [(p["section"], p["student"]) for p in people if (p["district"], p["school"]) == best[-2:] and ratio(s["student"], p["student"]) > 90]
        if len(hits) == 1:
            want[s["src_row"]] = ("green" if hits[0][0] == s["section"] else "yellow", hits[0][1])
        else:
            want[s["src_row"]] = ("orange" if hits else "red_name", None)
    got = {r["src_row"]: (r["status"], r["matched_student"]) for r in linkage.classify_students(src, roster).collect()}
    assert got == want
    turns = linkage.resolve_locations(src, roster, rows=3).collect()
    assert sorted(map(str, turns)) == sorted(map(str, linkage.resolve_locations(src, roster).collect()))


def test_location_edges(spark):
    roster = spark.createDataFrame([(1, "a", "b", "x", "ali can")], "row_number long, district string, school string, section string, student string")
    src = spark.createDataFrame([(1, "a", "b", "x", "ali can"), (2, "", "b", "x", "y"), (3, None, "", "x", "y"), (4, "qq", "rr", "", "")], "src_row long, district string, school string, section string, student string")
    got = {r["district"] + "|" + r["school"]: r for r in linkage.resolve_locations(src, roster).collect()}
    assert got["a|b"]["accepted"] and got["|b"]["reason"] == "Missing source field(s): district." and not got["qq|rr"]["accepted"]
    none = {r["district"]: r["reason"] for r in linkage.resolve_locations(src, roster.limit(0)).collect()}
    assert none["a"].startswith("The ERC list contains no usable")
    assert linkage.classify_students(src.limit(0), roster).count() == 0


def test_promotions(spark):
    people = [(1, "d", "s", "a", "kaan samed cil"), (2, "d", "s", "b", "ayse nur demir kaya"), (3, "d", "s", "a", "veli can tas"), (4, "d", "s", "c", "veli can tas")]
    roster = spark.createDataFrame(people, "row_number long, district string, school string, section string, student string")
    rows = [(1, "d", "s", "a", "k samed cil"), (2, "d", "s", "a", "ayse nur demir"), (3, "d", "s", "a", "v can tas"), (4, "d", "s", "", "k samed cil"), (5, "d", "s", "a", "nobody here")]
    src = spark.createDataFrame(rows, "src_row long, district string, school string, section string, student string")
    decided = {r["src_row"]: r["decision"] for r in review.promote_unmatched(linkage.classify_students(src, roster), review.assess_candidates(src, roster)).collect()}
    assert decided == {1: "Green + review", 2: "Yellow + review", 3: "Review only", 4: "Review only", 5: "Unchanged red"}


def plain_matches(left, right, threshold=90.0, margin=5.0):
    left, right = dict(left), dict(right)
    out = []
    for name in set(left.values()) & set(right.values()):
        for x, y in zip(sorted(k for k in left if left[k] == name), sorted(k for k in right if right[k] == name), strict=False):
            out.append((x, y))
    for x, y in out:
        del left[x], right[y]
    while left and right:
        s = {(x, y): label_ratio(left[x], right[y]) for x in left for y in right}
        found = []
        for x in left:
            row = sorted((-s[x, y], y) for y in right)
            y = row[0][1]
            column = sorted((-s[z, y], z) for z in left)
            seconds = [-v[1][0] if len(v) > 1 else 0.0 for v in (row, column)]
            if column[0][1] == x and s[x, y] >= threshold and all(s[x, y] - t >= margin for t in seconds):
                found.append((s[x, y], x, y))
        if not found:
            break
        _, x, y = max(found)
        out.append((x, y))
        del left[x], right[y]
    return sorted(out)


def test_one_to_one_matching():
    rng = random.Random(1)
    for _ in range(30):
        names = ["".join(rng.choice("ABCD") for _ in range(8)) + " KAYA" for _ in range(6)]
        left = [(k, n) for k, n in enumerate(names + names[:1])]
        right = [(100 + k, n[:3] + rng.choice("ABX") + n[4:]) for k, n in enumerate(names)]
        got = tracking.match_one_to_one(left, right)
        assert sorted((x, y) for x, y, _, _ in got) == plain_matches(left, right)
        assert len({x for x, *_ in got}) == len(got) == len({y for _, y, *_ in got})


def test_clusters():
    seen = {"MERKEZ": (1, 1), "MERKEZ ILCESI": (1, 5), "MERKEZZ": (2, 1), "UZAK": (1, 2)}
    assert tracking.cluster_labels(seen, "district", 90, 5) == [["MERKEZ", "MERKEZ ILCESI", "MERKEZZ"], ["UZAK"]]
    assert tracking.cluster_labels({}, "school", 90, 5) == []


def test_periods_do_not_depend_on_partitions(spark):
    p = derived(spark, SF, "periods")
    keys = ["district", "school", "section"]
    a, b = p.where("period = 1"), p.where("period = 2")
    one = sorted(map(str, tracking.match_periods(a, b, keys).collect()))
    assert one == sorted(map(str, tracking.match_periods(a.repartition(7), b.repartition(3), keys).collect())) and len(one) > 100


def test_reconciliation_follows_matches(spark):
    from rosterline.plans import queries

    keys = ["district", "school", "section"]
    rows = [
        *((1, i, "d", "s", "a", n) for i, n in enumerate(["kaan samed cil", "ayse nur demir", "veli can tas"])),
        *((2, 10 + i, "d", "s", "a", n) for i, n in enumerate(["kaan samet cil", "ayse nur demir", "veli can tas"])),
        *((3, 20 + i, "d", "s", "a", n) for i, n in enumerate(["kaan samed cil", "zeki ozturk"])),
        (2, 30, "d", "s", "b", "ali kaya bulut"), (3, 31, "d", "s", "b", "ali kaya bulutt"), (3, 32, "d", "s", "b", "omer tan"), (1, 40, "d", "s", "c", " "), (2, 41, "d", "s", "c", "can er"),
    ]
    given = spark.createDataFrame(rows, "period int, row_number long, district string, school string, section string, student string")
    m = tracking.section_matches(given, keys)
    got = {r["section"]: r.asDict() for r in tracking.matched_reconciliation(given, m, keys).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["matched_second"], a["missing_second"], a["extra_second"], a["exact_roster_second"]) == (3, 0, 0, True)
    assert (a["matched_third"], a["missing_third"], a["extra_third"], a["exact_roster_third"], a["matched_both"], a["missing_either"]) == (1, 2, 1, False, 1, 2)
    assert (b["has_baseline"], b["matched_later"], b["only_second"], b["only_third"], b["matched_second"], b["exact_roster_later"]) == (False, 1, 0, 1, None, False)
    assert (c["has_baseline"], c["has_third"], c["baseline"], c["extra_second"]) == (True, False, 0, 1)
    faults = {(r["period"], r["row_number"]): (r["exception_type"], r["second_method"]) for r in tracking.matched_exceptions(given, m, keys).collect()}
    assert faults == {
        (1, 1): ("Missing from Sheet 3", "Exact"), (1, 2): ("Missing from Sheet 3", "Exact"), (3, 21): ("Not in Sheet 1, extra in Sheet 3", None),
        (3, 32): ("No baseline, only in Sheet 3", None), (2, 41): ("Not in Sheet 1, extra in Sheet 2", None),
    }
    # the fixture against the plain matcher
    sides = {}
    for r in derived(spark, SF, "periods").collect():
        sides.setdefault((r["district"], r["school"], r["section"]), {1: [], 2: [], 3: []})[r["period"]].append((r["row_number"], r["student"]))
    want = {k: tuple(len(plain_matches(v[1], v[p])) for p in (2, 3)) for k, v in sides.items() if v[1]}
    table = queries.section_reconciliation_matched(spark, SF).where("has_baseline").collect()
    assert {tuple(r[k] for k in keys): (r["matched_second"], r["matched_third"]) for r in table} == want
    exact = {tuple(r[k] for k in keys): r["matched_second"] for r in queries.section_reconciliation(spark, SF).collect()}
    assert sum(v[0] for v in want.values()) > sum(exact.values())


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5, "green"), (2, "=A1", None, "red_name"), (3, None, None, None)], "id int, text string, n double, status string")
    path = str(tmp_path / "r.xlsx")
    assert write_xlsx({"One": df, "Two": df.limit(1)}, path, order={"One": ["id"]}, status={"One": "status"}) == {"One": 3, "Two": 1}
    with pytest.raises(FileExistsError):
        write_xlsx({"One": df}, path)
    raw = xlsx.read_xlsx(spark, path, sheet="One", columns=4)
    got = xlsx.named_table(raw, ["id", "text", "status"]).orderBy("row_number").collect()
    assert [(r["id"], r["text"], r["status"]) for r in got] == [("1", "a", "green"), ("2", "'=A1", "red_name"), ("3", None, None)]
    assert xlsx.read_xlsx(spark, path, sheet=2).count() == 2 and {r["sheet"] for r in xlsx.read_xlsx(spark, path).select("sheet").collect()} == {"One", "Two"}
    with pytest.raises(ValueError, match="missing"):
        xlsx.named_table(raw, ["other"])


def test_units_and_candidates(spark, tmp_path):
    (tmp_path / "in/.git").mkdir(parents=True)
    (tmp_path / "in/a.csv").write_bytes("okul,IŞIK".encode())
    (tmp_path / "in/b.csv").write_bytes("okul,IŞIK".encode())
    (tmp_path / "in/~$c.csv").write_bytes(b"x")
    (tmp_path / "in/.git/d.csv").write_bytes(b"x")
    (tmp_path / "in/e.rtf").write_bytes(b"x")
    rows = spark.createDataFrame([("none",), ("the school",), ("a school",), ("x",), ("school",)], "v string").coalesce(1)
    write_xlsx({"S": rows}, str(tmp_path / "in/f.xlsx"))
    found = units.read_units(spark, str(tmp_path / "in"))
    by = {r["path"].rpartition("/")[2]: r["status"] for r in found.collect()}
    assert by == {"a.csv": "text_scanned", "b.csv": "text_scanned", "e.rtf": "error", "f.xlsx": "text_scanned"}
    words = spark.createDataFrame([("school",)], "keyword string")
    hits = discovery.keyword_hits(found, words)
    assert [r["location"] for r in discovery.candidate_locations(hits.where("kind = 'excel'"), ["path", "keyword"], "number").collect()] == ["rows 3-4; row 6"]


def test_keywords_move_no_text(spark):
    units = spark.createDataFrame([(1, "The end of the of the day"), (2, ""), (3, None), (4, "of a-the, DE LA mer"), (5, "the")], "n long, text string")
    words = spark.createDataFrame([("the",), ("of the",), ("of the day",), ("de la",), ("",), (" the",), ("of  the",), (None,)], "keyword string")
    hits = discovery.keyword_hits(units, words)
    assert sorted((r["n"], r["keyword"]) for r in hits.collect()) == [(1, "of the"), (1, "of the day"), (1, "the"), (2, ""), (4, "de la"), (4, "the"), (5, "the")]
    assert discovery.keyword_hits(units, words.limit(0)).count() == 0
    plan = hits.select("n", "keyword")._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and "BuildRight" in plan


def test_extraction_rules():
    page = "MERKEZ / ATATÜRK İLKOKULU MÜDÜRLÜĞÜ\n3. Sınıf / B Şubesi\n1 12 Ali Can ÇOK İYİ İYİ\n2 13 Veli İYİ\n3 14 Öğrenci Adı İYİ"
    assert extraction.header_info(page) == {"district": "MERKEZ", "school": "ATATÜRK İLKOKULU", "class_no": "3", "section": "B"}
    assert [extraction.two_term_line(x) for x in page.splitlines()[2:]] == [("12", "ALI CAN", "ÇOK İYİ", "İYİ"), ("13", "VELI", "İYİ", ""), None]
    assert extraction.numeric_line("1 22 Ali Can 85 90,5 100") == ("22", "Ali Can", ["85", "90.5", "100"])
    assert [extraction.symbol_score(x) for x in ("G", "Ç.İ", "İ", "3", "x")] == ["1", "3", "2", "3", ""]
    assert [extraction.word_score(x) for x in ("Çok İyi", "ÇO", "x ÇOK İYİ x", "?")] == [3, 3, 2, "?"]
    assert [extraction.term_pair(x) for x in ("Türkçe 5 80 90", "Türkçe 5 80", "Türkçe 5")] == [("80", "90"), ("80", ""), ("", "")]
    table = [["Sıra", "Okul No", "Adı Soyadı", "Notu"], ["1", "12", "Ali", "İYİ"], ["1", "12", "Ali", "İYİ"], ["", "x", "Toplam", ""]]
    assert extraction.table_rows(table) == [("12", "Ali", "İYİ")] and extraction.table_rows([["1", "7", "Can", "ORTA"]]) == [("7", "Can", "ORTA")] and extraction.table_rows([["1", "2"]]) == []
    assert extraction.twelve_cells([f"c{i}" for i in range(14)]) == ["c0", "c1", "c2", "c3 c4 c5", *[f"c{i}" for i in range(6, 14)]]
    assert extraction.twelve_cells(["1", None, " a  b "]) == ["1", "", "a b", *[""] * 9]


def test_legacy_policy_equals_plain_search(src, roster):
    from rosterline.functions.similarity import sorted_ratio

    people = [r.asDict() for r in roster.collect()]
    places = sorted({(p["district"], p["school"], p["section"]) for p in people})
    want = {}
    for s in src.collect():
        at = (s["district"], s["school"], s["section"])
        if any((p["district"], p["school"], p["section"], p["student"]) == (*at, s["student"]) for p in people):
            want[s["src_row"]] = ("exact", s["student"])
            continue
        if at not in places:
            scored = [(sorted_ratio(at[0], d), sorted_ratio(at[1], c), d, c) for d, c, sec in places if sec == at[2]]
            scored = [(-(0.35 * a + 0.65 * b), d, c) for a, b, d, c in scored if a >= 90 and b >= 90]
            at = (*min(scored)[1:], at[2]) if scored else None
        hits = [(-sorted_ratio(s["student"], p["student"]), p["student"]) for p in people if (p["district"], p["school"], p["section"]) == at]
        best = min(hits, default=(0, None))
        want[s["src_row"]] = ("fuzzy", best[1]) if best[0] <= -88 else ("unmatched", None)
    assert {r["src_row"]: (r["status"], r["matched_student"]) for r in linkage.legacy_classify(src, roster).collect()} == want
