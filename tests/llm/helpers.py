"""Small tables with the odd cases that every operator has to take."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "doc_id long, text string, Score double, row long, shard int, component_id long, fingerprint string, _fp string"


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(words))


def odd_docs() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, and other scripts."""
    long = prose(5, 60_000)
    rows = [
        (1, prose(1, 80), "aa", "s", 1),
        (2, prose(1, 80), "aa", "s", 1),
        (3, prose(1, 80) + " and more", None, None, None),
        (4, None, "aa", "s", 0),
        (5, "", "bb", "s", 0),
        (6, " \t\n ", None, "s", 0),
        (7, "one", "bb", "s", 3),
        (8, "日本語 テキスト é ñ <|endoftext|> 😀", "cc", "s", 9),
        (None, prose(2, 50, "klmnopqrst"), "bb", "s", 5),
        (None, None, None, None, None),
        (9, prose(3, 70, "klmnopqrst"), "bb", "s", 5),
        (9, prose(3, 70, "klmnopqrst"), "bb", "s", 5),
        (10, long, "aa", "s", 5),
        (11, "word " * 300, "aa", "s", 5),
    ]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def key(value):
    return tuple((v is None, str(v)) for v in value)
