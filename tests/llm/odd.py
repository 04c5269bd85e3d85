"""Awkward inputs that every operator must take: nulls, empty and long texts, ties, repeated rows, clashing columns."""

LONG = "alpha beta gamma delta " * 30_000
CLASHING = "doc string, uid string, id string, n string, a string, b string, value string, class string, head string, at string, passage string, range string, place string, found string, toxic string"


def docs(spark, empty=False):
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "no id here"), (5, LONG), (6, LONG), (7, "same text twice\nand a second line"),
        (7, "same text twice\nand a second line"), (8, "same text twice\nand a second line"), (9, "Ünïcödé 你好 \U0001f600 text"), (None, None), (10, "one"),
    ]
    extra = ("x",) * CLASHING.count(" string")
    return spark.createDataFrame([] if empty else [(i, t, *extra) for i, t in texts], f"doc_id long, text string, {CLASHING}")
