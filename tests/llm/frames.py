"""Small documents with every awkward column, beside columns that clash with internal names."""

CLASHING = ("id", "key", "size", "row", "start", "end", "kind", "value", "owner", "words", "hash", "at", "item", "fingerprint",
            "root", "node", "cell", "vector", "query", "_text", "_lang", "_score", "_judged", "_key", "_order", "_licences",
            "_toxicity", "target", "copies", "label", "n")

LONG = "lorem ipsum dolor sit amet consectetur " * 20_000


def documents(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *(None, None))[:4] for r in rows]
    data = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(CLASHING)) for r in full]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(data, schema)


def table(spark, schema, rows):
    return spark.createDataFrame(rows, schema + ", " + ", ".join(f"`{c}` string" for c in CLASHING)) if not rows else \
        spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema + ", " + ", ".join(
            f"`{c}` string" for c in CLASHING))
