"""Rows that operators must bear: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import duckdb
from pyspark.sql import functions as F

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
#: Columns that operators use themselves.
CLASHING = ("size", "key", "score", "doc", "runs", "place", "band", "node", "label", "_range", "target", "copy", "toxic", "tag", "leak", "item")

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS[(7 * i) % 400] + str(i % 13) for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \t\n", None, None, 3),
    (4, "one two three", "en", "b", 13),
    (4, "one two three", "en", "b", 13),
    (5, PASSAGE, "en", "b", 1),
    (6, "before " + PASSAGE + " after", "en", "b", 1),
    (None, "Mail bob.7@mail.example.com or +1 (212) 555-0198", "en", "c", 1),
    (None, None, None, None, None),
    (7, LONG, "de", "a", len(LONG)),
    (8, LONG + " more", "de", "c", 1),
    (9, "one two three", "en", "c", 13),
    (10, "Released under the MIT License. Grüße \U0001F600 naïve", "de", "c", 1),
]


def documents(spark, rows=ROWS):
    found = spark.createDataFrame(rows, SCHEMA)
    return found.withColumns({name: F.lit(None).cast("string") if i % 2 else F.lit("x") for i, name in enumerate(CLASHING)})


def table(name, sf="sf0.001"):
    return duckdb.sql(f"SELECT * FROM '/root/testdata/{sf}/{name}.parquet'").fetchall()


def folder(spark, tmp_path, **tables):
    """Tables as a scale-factor folder."""
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
