"""Small tables for the tests: random prose with copies, and the awkward cases."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(words: int, seed: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(("an", "the", "tion", "ou", "é", "st", "re", "in")) for _ in range(rnd.randint(1, 4))) + rnd.choice(("", "", "", ",", ".", ".\n"))
                    for _ in range(words))


def row(doc_id, text, source="s"):
    return (doc_id, text, "en", source, None if text is None else len(text))


def awkward() -> list[tuple]:
    """Null ids and texts, empty, blank and very long texts, ties, repeated rows, odd characters."""
    long = prose(60_000, 1)
    passage = prose(70, 2)
    return [
        row(1, None), row(2, ""), row(3, " \n\t "), row(None, "lost number one two three four five six"), row(None, None),
        row(4, long), row(5, "x" * 300_000), row(6, prose(200, 3)), row(6, prose(200, 3)), row(7, prose(200, 3)), row(8, prose(200, 4)),
        row(9, prose(90, 5) + " " + passage + " " + prose(80, 6)), row(10, prose(60, 7) + "\n" + passage + " " + prose(90, 8)),
        row(11, "İstanbul <|endoftext|> été   日本 naïve"), row(12, "password = hunter2hunter2, AKIA" + "Z" * 16 + " " + "0af" * 10),
        row(13, "a"), row(14, "line\nline\nline\n" + prose(60, 9), None),
    ]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def clashing(docs, names):
    """``docs`` with further columns that have the names of results and of internal columns."""
    from pyspark.sql import functions as F

    return docs.withColumns({n: F.lit("clash") for n in names})


def by_id(rows, *columns):
    return sorted((tuple(str(getattr(r, c)) for c in ("doc_id", *columns)) for r in rows))
