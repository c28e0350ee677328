"""Small tables with every awkward case: nulls, empty and long texts, repeated rows, extra columns."""

import random

from pyspark.sql import functions as F

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
         "phi chi psi omega").split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def docs(spark, rows, extra=False):
    """rows: (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, DOC)
    if extra:  # names that operators use inside
        for name in ("id", "n", "key", "sig", "component", "label_id", "score", "tokens", "host", "part", "range_no"):
            df = df.withColumn(name, F.lit("clash"))
    return df


AWKWARD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one two"), (None, "a row without an id"),
           (7, prose(3000, 7) + " " + "x" * 70_000), (8, prose(40, 8)), (8, prose(40, 8)), (9, "1234 5678 !!"),
           (10, "\x00\u200b \U0001f600 naïve日本語")]
