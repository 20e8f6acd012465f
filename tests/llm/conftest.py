from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, k1 string, core int, fp string, shard int, uid string"


def prose(rng: random.Random, words: int) -> str:
    parts = ["the", "and", "th", "er", "on", "tion", "ing", "re", "st", "éa", "ou"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def texts() -> list[str | None]:
    rng = random.Random(5)
    base = [prose(rng, rng.randint(3, 120)) for _ in range(12)]
    passage = prose(rng, 110)
    long = prose(rng, 4000)
    near = base[0].split()
    return [
        None, "", " \n\t", "one", "one two three", *base, base[3], base[3], base[5] + " x", " ".join([*near[:-1], "zz"]),
        passage, base[6] + " " + passage, passage + " " + base[7], base[1] + passage + base[2], long, long[:3000] + " cut", "日本 語 ÄÖ 😀 " * 150, "a" * 5000,
        "call +1 (555) 555-0123 or a.b@c.example.com, b@c.de_x@e.fr ip 10.0.0.1 999.1.1.1 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 4111111111111112",
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", "src0", len(t or ""), "x", 1, "f", 2, "u") for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "src0", 3, "x", 1, "f", 2, "u"), (None, texts[8], None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
