"""Small document tables with the awkward cases every operator must take."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, _id long, kept boolean, fp string, score string, bucket int"
CLASH = ("r", 7, True, "f", "s", 3)


def prose(seed: int, n: int) -> str:
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
    state, out = seed * 7919 + 1, []
    for i in range(n):
        state = (state * 48271 + 11) % 2147483647
        out.append(words[state % len(words)] + str(state // 97 % 50))
        if i % 12 == 11:
            out[-1] += "."
    return " ".join(out)


def documents(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [
        (1, prose(1, 80), "en", "a"),
        (2, prose(1, 80), "en", "b"),
        (3, prose(3, 120), "de", None),
        (4, None, "en", "a"),
        (5, "", None, "b"),
        (6, " \t\n ", "en", "c"),
        (7, prose(7, 30_000), "de", "a"),
        (None, prose(9, 60), "en", "a"),
        (8, prose(8, 70), "en", "a"),
        (8, prose(8, 70), "en", "a"),
        (9, "one two three", "en", "é"),
        (10, "☃ 漢字 \U0001f600 <|endoftext|> x", None, "c"),
    ]
    full = [(i, t, lang, s, len(t) if t else None, *CLASH) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
