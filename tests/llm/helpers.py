"""Small document tables for the operator tests."""

from skewsafe.llm.common import ship_code

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "Ünïcödé 中文字 😀 and  two   spaces\n\nblank line\ttab\x1cseparator\xa0space",
    "don't <|endoftext|> we'll\r\nthey're <|startoftext|>!!",
    "repeat repeat repeat " * 30,
    "x" * 30_000,
    "long words " * 9_000,
    "tail space ",
]


def docs(spark, texts, ids=None):
    """A documents table; ids default to 0, 1, 2, ..."""
    ship_code(spark)
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src", len(t or "")) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return docs(spark, [])
