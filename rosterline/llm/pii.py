"""Personal data by fixed patterns and by contexts learned from them; built-in functions only.

Matches of the fixed patterns are seeds. The last word before a match and the last two, each with and
without the marks at their end, are lexical patterns. Patterns and the identifiers seen in them form a
graph over the whole corpus on which confidence is passed back and forth; identifiers that no fixed
pattern knows are reported where a pattern of high confidence precedes them. A pattern that mostly precedes other things, such as a
common word, tells nothing and takes no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm.common import table, unused, written

#: Fixed patterns by kind. The look-behind and the possessive loops only spare search work: a match starts
#: where a run of its characters starts or right after a match, and no loop could give back what would help.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this pattern has no match worth keeping.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][ -]?+){12}[0-9]", "phone": r"\+[0-9]"}
KINDS = tuple(PATTERNS)
LEARNED = "learned"

#: Words with digits that could be identifiers, and runs of digit groups with a space, dot, hyphen or bracket between two.
WORD = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z._%+-]*+[0-9](?:[._%+-]*+[A-Za-z0-9]++)*+"
GROUPS = r"(?:(?<![A-Za-z0-9._%+-])|\G)\(?[0-9]++(?![A-Za-z_%+])(?:\)?+[ .-]?+\(?+[0-9]++(?![A-Za-z_%+]))++(?!-[A-Za-z])"
CANDIDATE = f"{GROUPS}|{WORD}"
#: Characters before a match that are looked at, the two words at their end, and the marks at the end of a word. A word is
#: known by its last LEFT_WORD characters, here and where its places are counted, so a longer one is a pattern too.
LEFT_CHARS = 48
LEFT_WORD = 24
LEFT = r"(?:\S{1,24}\s+)?(?:\S{1,24}\s+|\S{0,23}[:=#\"'(\[<])$"
#: Where a mark touches what follows, and the two are told apart.
GLUED = r"([:=#\"'(\[<])(?=[^\s:=#\"'(\[<])"
MARKS = r"[^\p{L}\p{N}]+$"
ROUNDS = 3
#: Matches of a text that are put together at a time.
BLOCK = 256
#: A pattern is believed with so many different identifiers, and such a share of known ones among them.
MIN_INSTANCES, MIN_CONFIDENCE = 5, 0.6
#: An identifier must follow at such a share of the places where a pattern stands.
MIN_SHARE = 0.5

SPAN = "struct<kind:string,start:bigint,end:bigint>"
FOUND = "struct<kind:string,start:bigint,end:bigint,value:string>"


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
        return F.forall(parts, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= F.lit("255"))))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == LEARNED:
        return (F.length(value) >= 6) & (F.length(digits) >= 3)
    return F.lit(True)


def matches(text: Column, kind: str, pattern: str, needs: str) -> Column:
    """Valid matches from left to right with their places in code points.

    The pieces between matches and the matches make up the text in turn, so their lengths give the
    places; a match that fails its check still moves on.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(F.split(text, pattern, -1), values, lambda p, v: F.struct(F.length(p).cast("long").alias("gap"), v.alias("value")))
    both = F.filter(both, lambda x: x["value"].isNotNull())
    none, no_blocks = F.array().cast(f"array<{FOUND}>"), F.array().cast(f"array<array<{FOUND}>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["value"].alias("value"))
        out = F.when(_valid(kind, x["value"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    def block(acc: Column, x: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), none.alias("out"))
        return F.aggregate(x, begin, step, lambda got: F.struct(got["at"].alias("at"), F.concat(acc["out"], F.array(got["out"])).alias("out")))

    def fold(pairs: Column) -> Column:
        start = F.lit(0).cast("long").alias("at")
        few = F.aggregate(pairs, F.struct(start, none.alias("out")), step, lambda acc: acc["out"])
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / F.lit(BLOCK)).cast("int")), lambda i: F.slice(pairs, i * F.lit(BLOCK) + 1, F.lit(BLOCK)))
        many = F.aggregate(blocks, F.struct(start, no_blocks.alias("out")), block, lambda acc: F.flatten(acc["out"]))
        return F.when(F.size(pairs) <= BLOCK, few).otherwise(many)

    # spans grow inside blocks and blocks are put together once, so many matches in a text are not copied with every further
    # one; the array around the pairs makes them one value that is worked out once
    folded = F.element_at(F.transform(F.array(both), fold), 1)
    able = F.contains(text, F.lit(needs)) if needs == "@" else F.rlike(text, F.lit(needs))
    return F.when(able, folded).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the fixed kinds, in the order of KINDS, each from left to right."""
    return F.concat(*[matches(text, k, PATTERNS[k], NEEDS[k]) for k in KINDS])


def _is(kind: str):
    return lambda x: x == F.lit(kind)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def _prepared(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    got = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    return got.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text"), "base": base_spans(F.col("text"))})


def _forms(two: Column, one: Column) -> Column:
    return F.array_distinct(F.array(two, one, F.regexp_replace(two, MARKS, ""), F.regexp_replace(one, MARKS, "")))


def contexts(prepared: DataFrame) -> DataFrame:
    """(k1, k2, start, end, value, pattern, seed) of seeds and candidates, one row per pattern that precedes them.

    A candidate that touches a seed is part of it and no candidate; of digit groups that touch one, the
    words that do not are candidates.
    """
    text = F.col("text")
    seeds = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.lit(True).alias("seed")))
    apart = lambda x: ~F.exists("base", lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))

    def words(x: Column) -> Column:
        inner = F.transform(
            matches(x["value"], LEARNED, WORD, r"[0-9]"),
            lambda y: F.struct(y["kind"].alias("kind"), (y["start"] + x["start"]).alias("start"), (y["end"] + x["start"]).alias("end"), y["value"].alias("value")),
        )
        return F.filter(inner, apart)

    others = F.flatten(F.transform(matches(text, LEARNED, CANDIDATE, r"[0-9]"), lambda x: F.when(apart(x), F.array(x)).otherwise(words(x))))
    others = F.transform(others, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.lit(False).alias("seed")))
    rows = prepared.where(F.rlike(text, F.lit("[0-9@]")))
    rows = rows.select("k1", "k2", "text", F.explode(F.concat(seeds, others)).alias("x")).select("k1", "k2", "text", "x.*")
    taken = F.least(F.col("start"), F.lit(LEFT_CHARS))
    left = F.substring(text, (F.col("start") - taken + 1).cast("int"), taken.cast("int"))
    two = F.regexp_replace(F.lower(F.regexp_extract(left, LEFT, 0)), r"[0-9]", "0")
    rows = rows.select("k1", "k2", "start", "end", "value", "seed", F.trim(F.regexp_replace(two, r"\s+", " ")).alias("two"))
    one = F.substring_index("two", " ", -1)
    patterns = _forms(F.col("two"), one)
    return rows.select("k1", "k2", "start", "end", "value", F.explode(patterns).alias("pattern"), "seed").where("pattern <> ''")


def telling_patterns(prepared: DataFrame, found: DataFrame, instances: int = MIN_INSTANCES, share: float = MIN_SHARE) -> DataFrame:
    """Patterns of ``found`` with enough different identifiers that precede one at ``share`` of all their places."""
    often = written(found.groupBy("pattern").agg(F.count_distinct("value").alias("values"), F.count("*").alias("n")).where(F.col("values") >= instances).select("pattern", "n"))
    if often.isEmpty():
        return often.select("pattern")
    bare = lambda c: F.regexp_replace(c, MARKS, "")
    last = often.select(bare(F.substring_index("pattern", " ", -1)).alias("last")).distinct()
    text = F.regexp_replace(F.regexp_replace(F.lower("text"), r"[0-9]", "0"), GLUED, "$1 ")
    tokens = F.transform(F.filter(F.split(text, r"\s+"), lambda x: x != ""), lambda x: F.right(x, F.lit(LEFT_WORD)))
    places = prepared.select(tokens.alias("tokens"))
    before = F.concat(F.array(F.lit("")), F.col("tokens"))
    places = places.select(F.explode(F.arrays_zip(before.alias("before"), F.col("tokens").alias("one"))).alias("x")).where("x.one IS NOT NULL")
    places = places.select("x.*").withColumn("last", bare(F.col("one"))).join(last, "last")
    forms = places.select(F.explode(_forms(F.trim(F.concat_ws(" ", "before", "one")), F.col("one"))).alias("pattern"))
    stands = forms.join(often.select("pattern"), "pattern").groupBy("pattern").agg(F.count("*").alias("places"))
    told = often.join(stands, "pattern", "left")
    return told.where(F.col("n") >= F.lit(share) * F.coalesce("places", F.lit(0))).select("pattern")


def trusted_patterns(found: DataFrame, rounds: int = ROUNDS, instances: int = MIN_INSTANCES, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(pattern, score) of the patterns believed after ``rounds`` of scoring the pattern-identifier graph.

    A pattern's score is the mean score of its different identifiers, one more of score 0 included. Seeds
    score 1; another identifier scores 1 minus the product of its believed patterns' doubts.
    """
    edges = written(found.groupBy("pattern", "value").agg(F.max("seed").alias("seed")))
    known = edges.groupBy("value").agg(F.max("seed").cast("double").alias("score"))
    scored = None
    for _ in range(rounds):
        scored = edges.join(known, "value").groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("score"), F.count("*").alias("n")
        ).where((F.col("n") >= instances) & (F.col("score") >= confidence)).select("pattern", "score")
        doubt = F.sum(F.log(F.greatest(1 - F.coalesce(F.col("score"), F.lit(0.0)), F.lit(1e-9))))
        known = edges.join(scored, "pattern", "left").groupBy("value").agg(
            F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(doubt)).alias("score")
        )
    return scored


def learned_spans(prepared: DataFrame) -> DataFrame:
    """(k1, k2, learned): spans that only the learned patterns find, by the hash of their text."""
    found = written(contexts(prepared))
    found = found.join(written(telling_patterns(prepared, found)), "pattern")
    trusted = written(trusted_patterns(found))
    hits = found.where("NOT seed").join(trusted, "pattern").select("k1", "k2", "start", "end").distinct()
    span = F.struct("start", "end")
    grouped = hits.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(span)).alias("at"))
    made = F.transform("at", lambda x: F.struct(F.lit(LEARNED).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return grouped.select("k1", "k2", made.alias("learned"))


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_learned, base_sha256 and spans of every document.

    A null text is empty and has no spans. Equal rows give equal rows. Only id and text are read, so
    further columns do not matter.
    """
    prepared = _prepared(docs, id_column, text_column)
    learned = written(learned_spans(prepared))
    slim = F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    rows = prepared.select("doc_id", "k1", "k2", slim.alias("base")).join(learned, ["k1", "k2"], "left")
    rows = rows.withColumn("learned", F.coalesce("learned", F.array().cast(f"array<{SPAN}>")))
    kinds = F.transform("base", lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select(
        "doc_id", *counts, F.size("learned").cast("long").alias("n_learned"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "learned")).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping ones, replaced by its kind in brackets."""
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        put = F.concat(acc["out"], gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], put).otherwise(acc["out"]).alias("out")
        )

    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    tail = F.aggregate(ordered, begin, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, tail).otherwise(text)


def mask_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced; rows and other columns stay, a null text stays null.

    Repeated rows are masked alike, empty texts have nothing to mask, no rows give none.
    """
    prepared = _prepared(docs, id_column, text_column)
    learned = written(learned_spans(prepared))
    text = F.coalesce(F.col(text_column), F.lit(""))
    slim = F.transform(base_spans(text), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    spans, k1, k2, more = unused(docs.columns, "spans", "k1", "k2", "learned")
    rows = docs.withColumn(spans, slim)
    if not learned.isEmpty():
        rows = rows.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(1), text)}).join(learned.toDF(k1, k2, more), [k1, k2], "left")
        rows = rows.withColumn(spans, F.concat(spans, F.coalesce(more, F.array().cast(f"array<{SPAN}>"))))
    changed = F.when(F.col(text_column).isNotNull(), masked(F.col(text_column), F.col(spans)))
    return rows.withColumn(text_column, changed).select(*docs.columns)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
