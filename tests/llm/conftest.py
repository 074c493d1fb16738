import datetime
import random

import pytest
from pyspark.sql import types as T

#: Names that operators use inside: further columns of a table must not disturb them.
CLASHING = ("rid", "mark", "key", "score", "id", "label", "kept", "size", "name", "n_tokens", "_id", "_mark", "times", "word")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
WIDE = T.StructType([*DOCS.fields, *[T.StructField(c, T.StringType()) for c in CLASHING], T.StructField("at", T.DateType())])


@pytest.fixture(scope="session")
def frame(spark):
    """Documents as (doc_id, text, lang, source) or (doc_id, text); with further clashing columns if ``wide``."""

    def make(rows, wide=False):
        out = []
        for row in rows:
            doc_id, text, lang, source = (*row, "en", "a")[:4] if len(row) < 4 else row
            one = (doc_id, text, lang, source, len(text or ""))
            out.append((*one, *["x"] * len(CLASHING), datetime.date(2020, 1, 1)) if wide else one)
        return spark.createDataFrame(out, WIDE if wide else DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, very long and repeated texts, and null ids."""
    rng = random.Random(5)
    long = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(3000)) for _ in range(60_000))
    return [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one"), (5, "one"), (6, long), (7, long), (None, "null id text here"),
            (None, None), (8, "Ünïcode – “quotes” naïve \U0001f600 x y\x00z"), (9, "a b c d e f g"), (10, "a  b\tc d e f g")]
