"""Rows that the tests of this folder share."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that operators use for columns of their own.
CLASHES = ["id", "fp", "key", "n", "kept", "size", "target", "spans", "block", "word", "label", "pool", "d2", "distance", "f_words", "_mix_key"]

LONG = " ".join(f"word{i * i % 9973} and" for i in range(40_000))
PROSE = "It was a quiet evening by the river, and the old boats lay along the bank while somebody sang far away in the reeds."
#: NULLs in any column, empty and blank texts, a very long one, ties, repeated rows.
ODD = [(0, None), (1, ""), (2, " \t\n"), (3, LONG), (4, PROSE), (5, PROSE), (5, PROSE), (6, PROSE.replace(" ", "\n ")), (None, PROSE), (None, None),
       (7, "one"), (8, "one two"), (9, PROSE + " " + PROSE), (10, "#$%& | <x> \x85 　 é\U0001F642"), (11, PROSE, None, None), (12, "a\x00b " * 12, "en", None)]
