"""Rows with every awkward case: nulls in any column, empty and very long texts, ties, repeated rows, extra columns
whose names the operators use themselves."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 700} und{i % 13}" for i in range(15_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
BASE = " ".join(f"alpha{i}" for i in range(120))

ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \t\n ", "en", "a", 6),
    (4, "!!! ... ???", None, "b", 11),
    (5, "one two three", "en", "a", 13),
    (6, LONG, "en", "b", len(LONG)),
    (7, "first lines here. " + PASSAGE + " and more words follow", "en", "a", 1),
    (8, "quite another start, " + PASSAGE + " with another end", "de", "b", 1),
    (9, BASE, "en", "c", len(BASE)),
    (9, BASE, "en", "c", len(BASE)),
    (10, BASE + " omega", "en", None, 1),
    (None, "a row without id", "en", "a", 16),
    (None, "a row without id", "en", "a", 16),
    (12, "Ä ö\u00a0ü \u200b 漢字 🙂 <|im_end|> \x00 nul", "en", "c", 1),
    (13, "Released under the MIT License. GNU General Public License, version 3; CC BY 4.0", "en", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def messy(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.withColumns(
        {"row": F.lit("own"), "size": F.lit("own"), "score": F.lit("own"), "first": F.lit(1), "words": F.lit(None)}
    )


def empty(spark):
    return messy(spark, [])
