"""Operators over texts against plain versions, with nulls, empty, long and repeated rows and no rows at all."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rosterline.llm import decontam, packing, pii, quality, repeats, sharding, simhash, tokencount


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    got = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in got) > len(got))


def classes(n, linked):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def test_simhash_groups_equal_brute_force(docs, nothing):
    found = rows(simhash.near_groups(docs, cap=2), "doc_id", "fingerprint", "component_id")
    given = pairs(docs)
    fps = [plain_fingerprint(t) for _, t in given]
    of = classes(len(given), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    least = {c: min((given[i][0] for i in range(len(given)) if of[i] == c and given[i][0] is not None), default=None) for c in of}
    want = sorted(((given[i][0], f"{fps[i]:016x}", least[of[i]]) for i in range(len(given))), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert found == want
    assert simhash.near_groups(nothing).count() == 0


@pytest.mark.parametrize("spread", [6, 64])
def test_gray_index_finds_every_near_pair(spread):
    rng = np.random.default_rng(spread)
    centre = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    codes = np.unique(centre[rng.integers(0, 4, 900)] ^ (np.uint64(1) << rng.integers(0, spread, 900).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, spread, 900).astype(np.uint64)))
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    got = {(a, b) for x, y in simhash.GrayIndex(codes, np.zeros(len(codes), int)).pairs(4, chunk=500) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    assert got == {(a, b) for a in range(len(codes)) for b in range(a + 1, len(codes)) if (int(codes[a]) ^ int(codes[b])).bit_count() <= 4}


def test_keep_one_leaves_one_row_per_group(docs, nothing):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {plain_fingerprint(t): None for _, t in pairs(docs)}
    fps = list(groups)
    of = classes(len(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    left = [of[fps.index(plain_fingerprint(t))] for _, t in pairs(kept)]
    assert sorted(left) == sorted(set(of))
    assert simhash.keep_one(nothing).count() == 0


def plain_repeats(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def plain_passages(texts, words):
    data = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(d[i : i + words]) for d in data for i in range(len(d) - words + 1))
    out = []
    for d in data:
        held = set()
        for i in range(len(d) - words + 1):
            if seen[tuple(d[i : i + words])] > 1:
                held.update(range(i, i + words))
        out.append(len(held))
    return out


@pytest.mark.parametrize(("words", "gram"), [(50, 8), (12, 3)])
def test_repeated_passages_equal_brute_force(docs, words, gram):
    given = pairs(docs)
    want = sorted(((i, n) for (i, _), n in zip(given, plain_passages([t for _, t in given], words), strict=True)), key=lambda r: tuple((x is None, str(x)) for x in r))
    got = rows(repeats.removed_bytes(docs, words=words, words_gram=gram), "doc_id", "n_repeated_words")
    assert got == want and sum(n > 0 for _, n in got) > 5


@pytest.mark.parametrize(("window", "gram", "cap"), [(400, 100, 1500), (60, 20, 1)])
def test_repeats_equal_brute_force(docs, nothing, window, gram, cap):
    given = pairs(docs)
    want = sorted(((i, *r) for (i, _), r in zip(given, plain_repeats([t for _, t in given], window), strict=True)), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(repeats.removed_bytes(docs, window=window, gram=gram, cap=cap), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    if window == 400:
        assert repeats.removed_bytes(nothing).count() == 0


def test_column_sort_is_a_suffix_order():
    rng = random.Random(2)
    for _ in range(40):
        segs = [np.array([rng.randint(1, 2) for _ in range(rng.randint(0, 25))], np.uint16) for _ in range(rng.randint(1, 9))]
        bwt, common, owner, length = repeats.column_sort(segs)
        suffixes = [segs[o][len(segs[o]) - n :].tolist() for o, n in zip(owner.tolist(), length.tolist(), strict=True)]
        assert suffixes == sorted(suffixes) and len(suffixes) == sum(len(s) + 1 for s in segs)
        for i in range(1, len(suffixes)):
            a, b = suffixes[i - 1], suffixes[i]
            same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[i] == same
        assert [0 if n == len(segs[o]) else segs[o][-n - 1] for o, n in zip(owner.tolist(), length.tolist(), strict=True)] == bwt.tolist()


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_patterns_equal_plain_ones(spark, docs, nothing):
    rng = random.Random(9)
    odd = ["".join(rng.choice("ab1.@+-_ %4(9é😀") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["4111-1111-1111-1111", "a@b.c.d_e@f.g", "1.2.3.4.5.6.7.8", "+12345678901234567", "7" * 3000, "a" * 3000 + "@"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(more)
    got = pii.personal_data(both)
    want = sorted(((i, hashlib.sha256(",".join(plain_spans(t)).encode()).hexdigest()) for i, t in pairs(both)), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(got, "doc_id", "base_sha256") == want
    assert pii.personal_data(nothing).count() == 0


def test_learned_contexts_find_what_no_pattern_knows(spark):
    known = [f"note {i} contact id: u{i}@mail.example.com end" for i in range(9)]
    texts = [*known, "note contact id: KX-4471-993 end", "ordinary: room 1234567 here", "contact 7654321 end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).where("n_learned > 0").collect()}
    start = texts[9].index("KX")
    assert found == {9: f"learned:{start}:{start + 11}"}
    masked = {r["doc_id"]: r["text"] for r in pii.mask_documents(docs).collect()}
    assert masked[9] == "note contact id: [LEARNED] end" and masked[0] == "note 0 contact id: [EMAIL] end" and masked[11] == texts[11]


def test_labels_in_running_text_are_learned(spark):
    known = [f"word{chr(97 + i)}.\nPhone: +1 (555) 555-010{i} end" for i in range(7)] + [f"please call me at +1 (555) 555-020{i} or {chr(97 + i)}x" for i in range(7)]
    hidden = {20: ("other text\nPhone: ", "555 123 4567", " end"), 21: ("now call me at ", "(555) 123-4567", ", thanks"), 22: ("Phone: ", "555.123.4567", ". End"), 23: ("your phone: ", "AB-5512-77", " 5th")}
    plain = {30: "room 555 123 4567 here", 31: "in 1234567 cases"}
    docs = spark.createDataFrame([*enumerate(known), *((i, "".join(t)) for i, t in hidden.items()), *plain.items()], "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).where("n_learned > 0").collect()}
    assert found == {i: f"learned:{len(a)}:{len(a) + len(b)}" for i, (a, b, _) in hidden.items()}
    masked = {r["doc_id"]: r["text"] for r in pii.mask_documents(docs).collect()}
    assert all(masked[i] == f"{a}[LEARNED]{c}" for i, (a, _, c) in hidden.items()) and all(masked[i] == t for i, t in plain.items())


def test_common_words_before_seeds_tell_nothing(spark):
    known = [f"see the u{i}@mail.example.com and the other the same the rest" for i in range(9)]
    docs = spark.createDataFrame([*enumerate(known), (20, "over the 7654321 rows")], "doc_id long, text string")
    assert pii.personal_data(docs).where("n_learned > 0").count() == 0


def test_words_beside_a_seed_stay_candidates(spark):
    known = [f"id: u{i}@mail.example.com" for i in range(9)]
    docs = spark.createDataFrame([*enumerate(known), (20, "id: 7654321 10.0.0.1")], "doc_id long, text string")
    assert {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).where("n_learned > 0").collect()} == {20: "ip:12:20,learned:4:11"}


def test_shards_are_even_and_places_gapless(spark, docs, nothing):
    many = spark.range(3000).select("id", F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text")).withColumnRenamed("id", "doc_id").withColumn("shard", F.lit("s"))
    got = sharding.shard_documents(many, 7, 512).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() / sums.min() < 1.02 and set(got["law"]) == {"bytes"}
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    small = {(r["doc_id"], r["size"], r["text_crc32"]) for r in sharding.shard_documents(docs).collect()}
    assert small == {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs(docs)}
    assert sharding.shard_documents(nothing).count() == 0


def test_maps_are_stored_and_edited(spark, tmp_path):
    maps = f"file://{tmp_path}/maps"
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    copies = spark.range(2000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same").alias("text"))
    first = sharding.shard_documents(many.union(copies), 8, 512, maps=maps).toPandas()
    second = sharding.shard_documents(many.union(copies), 9, 512, maps=maps).toPandas()
    assert set(first.map_version) == {1} and set(second.map_version) == {2}
    assert sharding.stored_map(spark, maps, 1).count() == sharding.stored_map(spark, maps).count() == 512
    for got, n in ((first, 8), (second, 9)):
        sums = got.groupby("shard")["size"].sum()
        assert len(sums) == n and sums.max() / sums.min() < 1.1
        assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    # copies of one row spread, and most slots stay where they were
    assert first[first.doc_id == 5].virtual_slot.nunique() > 400
    both = first.groupby("virtual_slot")["shard"].first().to_frame("a").join(second.groupby("virtual_slot")["shard"].first())
    assert (both.a != both["shard"]).mean() < 0.2


def test_rebalancing_edits_few_slots():
    loads = [(s, 100 + s % 7, 1) for s in range(1024)]
    first = sharding.plan_map(loads, 8, 1024)
    second = sharding.rebalance(first, loads, 9)
    moved = sum(a[2] != b[2] for a, b in zip(first, second, strict=True))
    assert {r[0] for r in second} == {2} and moved <= 1024 // 9 + 12
    sums = Counter()
    for _, _, k, b, _ in second:
        sums[k] += b
    assert max(sums.values()) / min(sums.values()) < 1.05


def test_packing_round_trip(docs, nothing):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(packing.tokenizer_path())
    special = docs.sparkSession.createDataFrame([(700, "a <|endoftext|> b"), (701, "<|endoftext|><|endoftext|>"), (702, "x<|endoftext|"), (703, "end <|ENDOFTEXT|> of")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(special)
    assert np.frombuffer(packing.BpeBytes()("a <|endoftext|> b"), "<u4").tolist() == [64, 220, 50256, 275]
    got = packing.pack_documents(docs, tokens=64, segments=5).toPandas()
    want = Counter()
    for i, t in pairs(docs):
        ids = [*encoder.encode(t or "", add_special_tokens=False).ids, 0]
        for s in range(0, len(ids), 64):
            want[i, s, len(ids[s : s + 64]), zlib.crc32(np.asarray(ids[s : s + 64], "<u4").tobytes()), len(ids)] += 1
    found = Counter((None if np.isnan(r.doc_id) else int(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got.itertuples())
    assert found == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= 64 and len(g) <= 5
    assert packing.pack_documents(nothing).count() == 0


def test_loss_limit_binds(spark, docs, nothing):
    got = packing.pack_documents(docs, tokens=64, segments=9, loss=40).toPandas()
    sums = got.groupby("sequence_id")[["length", "loss_tokens"]].sum()
    assert sums["loss_tokens"].max() == 40 and sums["length"].max() <= 64 and got["length"].sum() == packing.pack_documents(docs).toPandas()["length"].sum()
    turns = [(c, k, role, "w " * (5 * (c + k) % 90), "x", 1) for c in range(60) for k, role in enumerate(("user", "assistant", None))] + [(None, None, None, None, "y", 2)]
    talks = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, start string, offset int")
    got = packing.pack_conversations(talks, tokens=128, segments=6, loss=50).toPandas()
    assert (got["loss_tokens"].where(got["turn"] != 1, 0) == 0).all() and len(got.groupby(["conv_id", "turn"], dropna=False)) == len(turns)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["length"].sum() <= 128 and g["loss_tokens"].sum() <= 50 and len(g) <= 6
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]]
    assert got.groupby("sequence_id")["loss_tokens"].sum().max() > 45
    assert packing.pack_conversations(talks.limit(0)).count() == 0


def test_bins_keep_every_limit():
    rng = np.random.default_rng(0)
    n = rng.integers(1, 200, 500)
    sizes = np.stack([n, np.ones_like(n), n // 2], axis=1)
    bins, place = packing.dot_product_bins(sizes, np.array([256, 4, 100]))
    for b in np.unique(bins):
        assert (sizes[bins == b].sum(axis=0) <= [256, 4, 100]).all() and sorted(place[bins == b]) == list(range((bins == b).sum()))
    assert len(np.unique(bins)) <= 1.05 * max(sizes[:, 0].sum() / 256, sizes[:, 2].sum() / 100, 125) + 1


def test_token_counts_equal_plain_search(docs, nothing):
    counter = tokencount.UnigramCounter()

    def plain(word):
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            n = len(word[i - 1].encode())
            ways = [(best[i - 1][0] + n * counter.byte_score, best[i - 1][1] - n)]
            ways += [(best[j][0] + counter.pieces[word[j:i]], best[j][1] - 1) for j in range(max(0, i - counter.longest), i) if word[j:i] in counter.pieces]
            best.append(max(ways))
        return -best[-1][1]

    given = pairs(docs)
    want = sorted(((i, sum(plain("▁" + w) for w in (t or "").split())) for i, t in given), key=lambda r: tuple((x is None, str(x)) for x in r))
    assert rows(tokencount.token_counts(docs), "doc_id", "n_tokens") == want
    assert tokencount.token_counts(nothing).count() == 0


def test_shared_prefixes_are_counted_once():
    counter = tokencount.UnigramCounter(pieces={"a": -1.0, "ab": -1.5, "b": -1.0, "abc": -1.2})
    assert counter.count_sorted(["ab", "abc", "abd", "b"]) == [1, 1, 2, 1]
    assert counter.steps == 5


def test_leaks_equal_brute_force(spark, docs, nothing, texts):
    rng = random.Random(3)
    items = [" ".join(t.split()[:40]) for t in texts[8:12] if t and len(t.split()) >= 20] + ["", "und never seen words zzz yyy xxx www vvv", " ".join(f"q{rng.randint(0, 99)}" for _ in range(90))]
    hidden = items[-1].split()
    more = spark.createDataFrame([(500, "x y z " + items[-1].upper() + " tail"), (501, " ".join(hidden[:60])), (502, None)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)] + [(99, None, 1)], "item_id long, text string, core int")
    both = docs.select("doc_id", "text").union(more)

    def shingles(t):
        w = [x for x in map(decontam.normal, (t or "").split()) if x]
        return [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []

    want = set()
    for i, t in pairs(both):
        have = set(shingles(t))
        for k, item in enumerate(items):
            own = shingles(item)
            if own and sum(s in have for s in own) / len(own) >= 0.8:
                want.add((i, k))
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(both, benchmark).collect()} == want and want
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(both, benchmark, index_words=40).collect()} == want
    assert decontam.find_leaks(nothing, benchmark).count() == 0 and decontam.find_leaks(docs, benchmark.limit(0)).count() == 0
    gone = {i for i, _ in want}
    assert sorted(str(r["doc_id"]) for r in decontam.drop_leaks(both, benchmark).collect()) == sorted(str(i) for i, _ in pairs(both) if i not in gone)


def test_block_max_search_equals_full_scoring():
    rng = random.Random(4)
    items = [(i, " ".join(f"w{min(int(rng.expovariate(0.05)), 99)}" for _ in range(30))) for i in range(120)]
    index = decontam.Index(items, 0.3)
    for _ in range(40):
        terms = sorted({rng.randrange(len(index.vocabulary)) for _ in range(25)})
        full = np.zeros(index.n_units)
        for t in terms:
            full[index.docs[t]] += index.weights[t]
        got = dict(index.search(terms))
        assert set(got) == set(np.flatnonzero(full >= 0.3 - 1e-9).tolist())
        assert all(abs(got[u] - full[u]) < 1e-9 for u in got)


def test_quality_on_held_out_rows(spark, docs, nothing):
    sf = "/root/testdata/sf0.1"
    all_docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fitted, held = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    got = quality.rate_documents(all_docs, fitted).join(held, "doc_id").toPandas()
    clean, junk = got[(got.quality == 1) & (got.toxic == 0)], got[got.quality == 0]
    assert clean["kept"].mean() > 0.98 and junk["kept"].mean() < 0.05
    english_toxic = got[(got.quality == 1) & (got.toxic == 1)]
    assert english_toxic["kept"].mean() < 0.75
    some = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (7, 1, 1), (7, 1, 0), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    assert quality.rate_documents(docs, some).count() == docs.count()
    assert quality.rate_documents(docs, some.limit(0)).count() == docs.count() and quality.rate_documents(nothing, some).count() == 0


def test_thresholds_are_ordered():
    rng = np.random.default_rng(1)
    grade = rng.integers(0, 4, 400)
    model = quality.fit(np.zeros(400, int), grade + rng.normal(0, 0.3, 400), np.arange(400), grade, 4)
    assert (np.diff(model.thresholds) > 0).all() and model.weights[0] > 0
