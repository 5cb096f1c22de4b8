"""Documents that try an operator: nulls, empty and long texts, repeats, names
that operators use themselves."""

from pyspark.sql import functions as F

from chronoctx.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "when the river froze in the ninth winter the ferrymen walked across and sold their oars for bread and candles"
BODY = " ".join(f"word{i % 97} and{i % 13} more{i % 7}" for i in range(400))
TEXTS = [
    "", None, "short", "short", "  \n\n\t", "é" * 60, "😀 mixed 漢字 text, with marks!",
    "header line\nshared line\nfirst body", "HEADER line \nshared line\nsecond body",
    PASSAGE, PASSAGE + " and one more", "x " + PASSAGE, BODY, BODY, BODY + " tail", BODY.replace("word5 ", "other "),
    "mail a.b@c.de or call +49 30 1234567, card 4111 1111 1111 1111 at 10.0.0.1",
    "y" * 300_000, "q w e r t " * 20_000, "line\n" * 5_000,
    "Released under the MIT License. See GNU General Public License, version 3.",
]


def hostile(spark, texts=TEXTS, extra=True):
    """``texts`` as documents; a null id, a repeated row, columns with clashing names."""
    prepare(spark)
    rows = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in enumerate(texts)]
    if texts:
        rows += [(None, "no id", None, None, 5), rows[min(7, len(rows) - 1)]]
    docs = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("score", "k", "row", "block", "hashes", "drop", "n_lines", "found", "stats", "label", "rep", "a", "b", "length"):
            docs = docs.withColumn(name, F.lit("mine"))
    return docs


def empty(spark):
    return hostile(spark, [])
