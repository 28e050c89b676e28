"""Tables of odd rows that every operator must handle."""

import random

import pytest

SF = "/root/testdata/sf0.001"


def odd_texts():
    rnd = random.Random(7)
    letters = "abcdefghij kl=-+\n"
    return [
        None, "", " ", "\n\t ", "a", "\0", "the same text twice over", "the same text twice over",
        "Released under the MIT License.", "MIT\nlicense, apache license; GNU general public license!",
        "  a  b\n\tc </s> <s> <|startoftext|> x<|endoftext|>", "a" * 700, "ab" * 600,
        "İstanbul ΑΣ ΣΑΣ ﬁ é é　x \x1c\x85 ▁▁ ▁a", "日本語テキスト漢字かな交じり文 😀😀 👨‍👩", "it's they'll I'D 12345 %$#@!  \0 null",
        "".join(rnd.choice(letters) for _ in range(20_000)), "ß" * 150, "é" * 99 + "x", "hello " * 3000,
        "".join(chr(rnd.choice([rnd.randrange(32, 0x500), rnd.randrange(0x3000, 0x9fff), rnd.randrange(32, 127)]))
                for _ in range(3000)),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Texts of all kinds; a null id, a repeated id, repeated rows, and columns named like those of operators."""
    rows = [(i, t, "en", "s", None) for i, t in enumerate(odd_texts())]
    rows += [(None, "no id", None, None, 1), (3, "id three again", "de", None, None), (4, "a", "en", "s", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS id", "'x' AS f", "2 AS key", "'y' AS component", "3L AS n_words", "0 AS score", "1 AS part")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
