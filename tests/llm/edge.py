"""Tables with everything an operator has to live with."""

LONG = " ".join(f"word{i % 97}x{i % 13}" for i in range(30_000))
SHARED = "this line is shared by many documents"
ROWS = [
    (1, "The cat sat on the mat.\n" + SHARED, "en", "clash"),
    (2, "the CAT sat on the mat.\n" + SHARED, "en", "clash"),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\n ", None, "a"),
    (6, LONG, "en", "b"),
    (7, "!!! 123 ???", "de", "b"),
    (None, "a text without an id\n" + SHARED, "en", None),
    (8, "same", "en", "c"),
    (8, "same", "en", "c"),
    (8, "same id, other text\n" + SHARED, "fr", "c"),
    (9, "Ünïcödé ñandú <|endoftext|> \x1c \x85 中文 😀", "es", "d"),
    (10, "x" * 5_000, "en", "d"),
]
#: Columns with names that operators use themselves.
EXTRA = ["key", "norm", "n", "fp", "sid", "th", "h1", "pos", "score", "held_out", "n_tokens", "row",
         "_sid", "_th", "_dropped", "_bitmap", "_id", "_sha"]
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(
    f"{name} string" for name in EXTRA)


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA)


def empty(spark):
    return documents(spark, [])
