"""Small inputs with the awkward rows that every operator has to take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, key long, words string"


def documents(spark, rows):
    """Rows (doc_id, text) or (doc_id, text, source); extra columns have names that operators use themselves."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), 5, 6, 7, "w") for r in rows]
    return spark.createDataFrame(full, DOCS)


def sentence(seed, n):
    """n invented words, the same for the same seed."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append("w%d" % (x >> 8))
    return out
