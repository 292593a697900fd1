"""Small documents with everything that can be odd about them."""

LONG = "alpha beta " * 40_000
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "fingerprint string, score double, ids array<int>, rule string, lines long, start long"
)
LINES = "\n".join(f"line number {k} of a passage" for k in range(12))

TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away"),
    (1, "the quick brown fox jumps over the lazy dog and runs away"),
    (2, "the quick brown fox jumps over the lazy dog and runs away"),
    (3, None), (4, ""), (5, "   \n\t "), (6, "word"), (7, LONG), (None, "no id at all here"), (None, None),
    (8, LINES), (9, "before\n" + LINES + "\nafter"), (10, "x" * 50_000), (11, "Émile ñandú straße 12 <|endoftext|>  two"),
]


def odd_documents(spark, texts=TEXTS):
    rows = [(i, t, "en" if t else None, "s", len(t or ""), "f", 0.5, [1], "r", 1, 2) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)
