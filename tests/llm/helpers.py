"""Small tables for the corpus operators, and words as the contracts take them."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows):
    """rows of (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


#: Names that working columns bear somewhere, and a name with a dot.
CLASHING = ["row", "size", "key", "fp", "h1", "line", "n", "k1", "ids", "kept", "a.b"]


def clashing(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(7) for c in CLASHING})


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
