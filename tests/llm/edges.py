"""Tables with what every operator must handle."""

from pyspark.sql import functions as F

LONG = "lorem ipsum dolor " * 4000 + "x" * 30000
EDGE_TEXTS = [
    None, "", " ", "\t\n\x0b\x0c\r", "a", "A", "a  b", "a b", "a\tb", " ", "é", "İstanbul ΣΑΣ",
    "日本語 テキスト", "😀 ok", "\x00", "<|endoftext|>", "x <|endoftext|> y<|startoftext|>", "▁ ▁", "don't we'll",
    "  lead", "trail  ", "a\n\n  b", "1234 5,678.9", LONG, LONG, "a b",
    "a \xa0 \xa0 b", "a \xa0 \xa0 \xa0 \xa0 b", "x" + " \xa0" * 9 + "y" + "\xa0 " * 9, "\xa0 \n \xa0 \xa0  é",
]
EDGE_ROWS = list(enumerate(EDGE_TEXTS))


def edge_table(spark):
    """Edge texts by id, beside columns whose names operators use themselves."""
    rows = spark.createDataFrame(EDGE_ROWS, "doc_id long, text string")
    names = ["digest", "score", "key", "length", "number", "share", "n", "toxic", "piece", "start"]
    return rows.withColumns({name: F.lit("own") for name in names}).repartition(3)


def empty_table(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
