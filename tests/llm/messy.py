"""Documents with everything that may go wrong, for all text operators."""

import random

DDL = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "copy string, score string, id string, n_tokens string, labels string, row string, key string"
)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def long_text(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 96)) for _ in range(words))


TEXTS = [
    (1, "One text, twice."), (2, "One text,\n\ttwice."), (2, "One text,\n\ttwice."), (3, ""), (4, None),
    (5, "   \t"), (None, "no id"), (None, "One text, twice."), (6, long_text(1, 3000)),
    (7, long_text(1, 3000)), (8, "ÄÖ ü ß é İ Σς 中文 ١٢ 😀 <|endoftext|> it's"), (9, "!!! ??? 123 456"),
    (10, "Released under the MIT License. Licensed under CC BY-NC 4.0."),
    (11, "x"), (12, "x y"), (13, "\x00 nul \x1c \x85 end"), (9223372036854775807, "far id"), (-5, "below"),
]


def messy_rows():
    return [
        (i, t, None if k % 5 == 4 else ["en", "fr"][k % 2], None if k % 7 == 6 else f"src{k % 3}",
         None, "c", "s", "i", "n", "l", "r", "k")
        for k, (i, t) in enumerate(TEXTS)
    ]


def messy(spark):
    return spark.createDataFrame(messy_rows(), DDL).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DDL)
