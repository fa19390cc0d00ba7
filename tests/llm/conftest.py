import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with the columns of the table and clashing ones."""

    def build(rows, extra=True):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1]) if r[1] is not None else None) for r in rows]
        frame = spark.createDataFrame(full, DOCS)
        if extra:
            clashing = ("row", "rank", "score", "mark", "root", "digest", "word", "knot", "_content", "_bucket", "lang_pred", "length")
            for name in clashing:
                frame = frame.selectExpr("*", f"'x' AS `{name}`")
        return frame

    return build


#: Null and empty texts, null ids, repeated rows, a very long text, white space only.
ODD = [
    (1, None), (2, ""), (None, "only text"), (3, "a b c d"), (3, "a b c d"), (4, " \t\n "), (None, None),
    (5, "word " * 30_000), (6, "ü" * 5_000), (7, "a b c d"), (8, "\u0085  x"), (9, "😀 é"),
]
