"""Rows that the tests of this folder share."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label string, score double, size long, shard string, start long"

#: Rows that every operator must take: nulls, empty texts, repeats, a long text.
EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "alpha beta"), (4, "alpha beta"), (5, "word " * 30000), (None, "alpha beta"), (6, "x"), (7, "é ß ñ 12 !"), (8, "w" * 100000)]


def docs_of(spark, rows):
    """Documents from (doc_id, text[, lang, source]) rows, with extra columns whose names operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0, "x", 1.0, 2, "z", 3) for r in rows]
    return spark.createDataFrame(full, DOCS)
