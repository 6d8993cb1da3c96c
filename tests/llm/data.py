"""Small documents with the awkward cases every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(6000))
WORDS = " ".join(f"tok{i}" for i in range(60))
ROWS = [
    (1, "Alpha beta gamma delta.\nSecond line here.", "en"),
    (2, None, "en"),
    (3, "", None),
    (3, "", None),
    (4, "   \n \t ", "en"),
    (5, LONG, "en"),
    (6, "Alpha beta gamma delta.\nSecond line here.", "en"),
    (7, f"{WORDS}\nown line seven", "de"),
    (8, f"own line eight\n{WORDS}\n\nend", "de"),
    (9, f"{WORDS} and one more", None),
    (None, f"own line none\n{WORDS}", "fr"),
    (None, "Alpha", "fr"),
    (10, "héllo wörld 🙂 " * 5, "fr"),
    (11, "a", "en"), (12, "a b", "en"), (13, "!!! ???", "en"),
]


def documents(spark, rows=ROWS):
    """With two extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "src", len(t or ""), 5, "r")
                                  for i, t, lang in rows], SCHEMA)


def key(row):
    return tuple((v is not None, str(v)) for v in row)
