"""Odd document tables that every operator must take."""

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "éè 中文 \U0001f600 <|endoftext|> end"),
    (7, "a\x00b c"), (8, "word " * 3000), (9, "x" * 20000), (None, "no id here at all"), (10, "###&&& $$$ !!!"), (11, None),
]


def documents(spark, rows=ODD):
    """Documents with further columns whose names clash with those of results."""
    full = [(i, t, "en", "src0", None if t is None else len(t), "x", 7) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, class_id string, score int")
