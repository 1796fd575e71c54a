"""Messy documents that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing names."""

import random

import pytest

FIELDS = ("doc_id long, text string, lang string, source string, n_chars long, "
          "_text string, _id long, id long, cls long, kept boolean, row int, size int")


def make_texts() -> list[tuple]:
    r = random.Random(7)
    vocabulary = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(400)]

    def prose(n: int) -> list[str]:
        return [r.choice(vocabulary) for _ in range(n)]

    rows: list[tuple] = [(None, "a row without an id but with some words in it", None), (1, None, "x"), (2, "", "x"),
                         (3, " \t\n\x0b ", None), (4, "Two words", "x"), (5, "é ñ – don't 日本 😀 <|endoftext|> ▁x", "y")]
    base = prose(60)
    for i in range(10, 30):  # near copies: one word in the middle or at an end differs
        words = list(base)
        words[r.choice([0, 59, 30])] = vocabulary[i]
        rows.append((i, " ".join(words), "y"))
    copy = " ".join(prose(40))
    rows += [(i, copy, "z") for i in range(30, 36)] + [(30, copy, "z")]  # copies, one of them a repeated row
    line = "Read more on our site"
    for i in range(40, 53):
        body = prose(30)
        rows.append((i, " ".join(body[:15]) + f"\n  {line.upper() if i % 2 else line} \n" + " ".join(body[15:]), "w"))
    rows += [(60 + i, " ".join(["spam and more spam of it"] * 5), "bad") for i in range(8)]
    rows += [(70, " ".join(prose(20)), "bad"), (71, "\n".join(" ".join(prose(9)) for _ in range(4000)), "y")]
    notice = "Licensed under the Apache License,\n # Version 2.0."
    rows += [(80, " ".join(prose(33)) + " " + notice + " " + " ".join(prose(9)), "y"), (81, notice, "y"),
             (82, "Released under the MIT License. Released under the MIT License.", "y")]
    return rows


@pytest.fixture(scope="session")
def texts():
    return make_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, 2, 3, True, 4, 5) for i, t, s in texts],
                                 FIELDS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
