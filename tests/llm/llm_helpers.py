"""Small documents with every odd case, and comparison of results."""

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(rng, words, stems=("an", "be", "ti", "on", "re", "la", "sto", "mi")):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randrange(1, 4))) for _ in range(words))


def odd_rows():
    """Rows with NULLs in every column, empty, blank and long texts, ties and repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 9000)
    rows = [
        (1, prose(rng, 60), "en", "a", 1), (2, "", "en", "a", 0), (3, None, "en", "a", None), (4, " \t\n ", None, None, 4),
        (None, prose(rng, 50), "fr", None, 9), (5, long, "de", "b", len(long)), (6, "one two", "en", "b", 7), (6, "one two", "en", "b", 7),
        (7, prose(rng, 80), "en", "c", 1), (7, prose(rng, 40), "en", "c", 1), (8, "x", "en", "d", 1),
        (9, "mail a.b@c.example and 10.0.0.1, +1 (784) 555-8120", "en", "d", 50), (None, None, None, None, None),
    ]
    rows += [(20 + k, rows[0][1], "en", "b", 1) for k in range(4)]
    rows += [(40 + k, " ".join(rows[0][1].split()[:-1] + [f"end{k}"]), "en", "c", 1) for k in range(4)]
    return rows


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS)


def clashing(docs, *names):
    """The documents with more columns, named as an operator might name its own."""
    out = docs
    for name in names:
        out = out.selectExpr("*", f"'mine' AS `{name}`")
    return out


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect() or []) if names else (tuple(r) for r in df.collect()), key=repr)
