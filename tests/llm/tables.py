"""Small tables for the operators' tests: awkward rows, empty tables, written folders."""

import random

SF_SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside: as extra input columns they must do no harm.
EXTRA = ("fp", "node", "key", "n", "kept", "fingerprint", "n_tokens", "share", "place", "name", "sha", "uid", "rank", "h", "block", "digest")


def words(n, seed, size=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4))) + str(rng.randint(0, size)) for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty and blank texts, very long ones, ties, copies, near copies, repeated rows."""
    passage = words(70, 99)
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, "a", 4), (4, "one", "en", None, 3),
        (5, "x y z", "en", "a", 5), (6, "x y z", "en", "b", 5),
        (7, words(300, 1), "en", "a", 1), (8, words(300, 1), "en", "b", 1),
        (9, words(300, 1) + " changed", "en", "b", 1),
        (10, words(80, 2) + " " + passage, "de", "b", 1), (11, passage + "  " + words(80, 3), "de", "b", 1),
        (12, words(60, 4) + "\n" + passage + "\n" + words(60, 5), "de", None, 1),
        (13, "same " * 400, "en", "c", 1), (14, "same " * 130, "en", "c", 1),
        (15, words(30_000, 6, 4000), "en", "c", 1), (16, "z" * 100_000, "en", "c", 1),
        (17, "ärger été ñandú  Straße ΟΔΟΣ İ ﬁ \U0001f642 don't \x1c|", None, "c", 1),
        (18, "line one\nline one\nother\n\n \nline one", "fr", "c", 1),
        (None, words(300, 1), "en", "a", 1), (None, None, None, None, None), (None, passage, "de", "a", 1),
        (19, words(120, 7), "fr", "d", 1), (19, words(120, 7), "fr", "d", 1), (19, words(120, 7), "fr", "d", 1),
        (20, words(120, 8), "fr", "d", 1),
    ]
    return rows


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, COLUMNS)
    if extra:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("clash") for c in EXTRA})
    return df.repartition(3)


def empty(spark):
    return frame(spark, [])


def clean(rows):
    """(doc_id, text) with null texts emptied."""
    return [(r[0], r[1] or "") for r in rows]


def small_documents(spark, sf_dir):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
