"""Name encoders as native column expressions.

The reversible encoders share one rule: an ``x`` that is followed by four hex
digits is doubled, ``=`` becomes ``xffff`` and every other character of the
denied class becomes ``x`` plus the four hex digits of each UTF-16 unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator of encoded name parts and code of the equals sign.
CONCATENATOR = "xffff"
OLD_CONCATENATOR = "_"

# Character class that each encoder replaces.
DENIED = {
    "postgresql": "[^a-z0-9_]",
    "mysql": "[^A-Za-z0-9_]",
    "cassandra": "[^A-Za-z0-9_]",
    "mongo_database": r'[A-Z/\\."$=]',
    "mongo_collection": "[/$=]",
    "hdfs": "[=/]",
    "hdfs_path": "[=]",
    "dynamo": r"[^A-Za-z0-9_.\-]",
    "hive": "[^a-z0-9_]",
    "kafka": r"[^A-Za-z0-9_.\-]",
    "ckan": r"[^a-z0-9_\-]",
}

# Character classes of the old, irreversible encoders.
OLD_DENIED = {
    "plain": r"[^a-zA-Z0-9.\-]",
    "plain_slash": r"[^a-zA-Z0-9.\-/]",
    "ld_table": "[^a-zA-Z0-9/]",
    "sth_database": r'[=/\\.$" ]',
    "sth_collection": "[=$]",
}

ESCAPED_X = "x(?=[0-9a-fA-F]{4})"


def allowed(kind: str) -> str:
    """Character class of what an encoder keeps."""
    return _negated(DENIED[kind])


def _negated(chars: str) -> str:
    return "[" + chars[2:] if chars.startswith("[^") else "[^" + chars[1:]


def _joined(escaped: Column, denied: str) -> Column:
    """Every character of the class ``denied`` coded at once, with a NUL in place of
    every run of kept ones; the codes are cut at the NULs and put between the runs.
    Texts that hold a NUL themselves are coded part by part."""
    kept_class = _negated(denied)
    kept = F.split(escaped, f"{denied}+", -1)
    codes = F.split(_code(F.regexp_replace(escaped, f"{kept_class}+", "\u0000")), "x0000", -1)
    joined = F.array_join(F.zip_with(
        kept, F.filter(codes, lambda code: code != ""), lambda run, code: F.concat(run, F.coalesce(code, F.lit("")))), "")
    parts = F.regexp_extract_all(escaped, F.lit(f"{kept_class}+|(?s:.)"), F.lit(0))
    by_part = F.array_join(F.transform(parts, lambda part: F.when(part.rlike(denied), _code(part)).otherwise(part)), "")
    return F.when(F.contains(escaped, F.lit("\u0000")), by_part).otherwise(joined)


def encode(text: Column, kind: str) -> Column:
    """Reversible encoding of ``text`` with the rules of ``kind`` (see DENIED).
    Most names need no change and pass one test."""
    coded = _joined(F.regexp_replace(text, ESCAPED_X, "xx"), DENIED[kind])
    return F.when(~text.rlike(f"{DENIED[kind]}|{ESCAPED_X}"), text).otherwise(coded)


# Encoders that code what another one does and these characters besides.
# A code has none of them, so each goes on from the other's result; the first two
# start from the text whose ``x`` are doubled.
_STEPS = [
    ("hdfs_path", "_escaped", "="), ("dynamo", "_escaped", DENIED["dynamo"]),
    ("hdfs", "hdfs_path", "/"), ("mongo_collection", "hdfs", "$"), ("mongo_database", "mongo_collection", r'[A-Z\\."]'),
    ("mysql", "dynamo", ".-"), ("ckan", "dynamo", "[A-Z.]"), ("postgresql", "ckan", "-"),
]


def encode_steps(df: DataFrame, text: str) -> tuple[DataFrame, dict[str, Column]]:
    """All encodings of the column ``text``: ``df`` with helper columns (one for each
    different class of DENIED) and the column of every kind. For long texts, where
    the passes over the characters are what counts: three of them test classes."""
    name = {"_escaped": "_enc_escaped"} | {kind: f"_enc_{kind}" for kind, _, _ in _STEPS}
    df = df.withColumn(name["_escaped"], F.regexp_replace(text, ESCAPED_X, "xx"))
    for kind, before, more in _STEPS:
        source = F.col(name[before])
        if more.startswith("["):
            more = more.replace("A-Za-z0-9_", r"\w")
            coded = F.when(~source.rlike(more), source).otherwise(_joined(source, more))
        else:
            coded = source
            for char in more:
                coded = F.replace(coded, F.lit(char), F.lit(CONCATENATOR if char == "=" else f"x{ord(char):04x}"))
        df = df.withColumn(name[kind], coded)
    first = {DENIED[kind]: name[kind] for kind, _, _ in _STEPS}
    return df, {kind: F.col(first[denied]) for kind, denied in DENIED.items()}


def _code(chars: Column) -> Column:
    """``x`` and four hex digits for each UTF-16 unit, the equals sign's own code."""
    units = F.regexp_replace(F.lower(F.hex(F.encode(chars, "UTF-16BE"))), "(.{4})", "x$1")
    return F.replace(units, F.lit("x003d"), F.lit(CONCATENATOR))


def encode_postgresql(text: Column) -> Column:
    return encode(text, "postgresql")


def encode_mysql(text: Column) -> Column:
    return encode(text, "mysql")


def encode_cassandra(text: Column) -> Column:
    return encode(text, "cassandra")


def encode_mongo_database(text: Column) -> Column:
    return encode(text, "mongo_database")


def encode_mongo_collection(text: Column) -> Column:
    return encode(text, "mongo_collection")


def encode_hdfs(text: Column, allow_slashes: bool = False) -> Column:
    return encode(text, "hdfs_path" if allow_slashes else "hdfs")


def encode_dynamo(text: Column) -> Column:
    return encode(text, "dynamo")


def encode_hive(text: Column) -> Column:
    return encode(text, "hive")


def encode_kafka(text: Column) -> Column:
    return encode(text, "kafka")


def encode_ckan(text: Column) -> Column:
    return encode(text, "ckan")


def encode_old(text: Column, delete_slash: bool = False, encode_slash: bool = True) -> Column:
    """Old encoding: anything unusual becomes ``_``; ``delete_slash`` drops the
    first character, and slashes stay only when neither flag is set."""
    if delete_slash:
        return F.regexp_replace(F.substr(text, F.lit(2)), OLD_DENIED["plain"], "_")
    kind = "plain" if encode_slash else "plain_slash"
    return F.regexp_replace(text, OLD_DENIED[kind], "_")


def encode_ld_table(text: Column) -> Column:
    return F.regexp_replace(text, OLD_DENIED["ld_table"], "_")


def encode_sth_database(text: Column) -> Column:
    return F.regexp_replace(text, OLD_DENIED["sth_database"], "_")


def encode_sth_collection(text: Column) -> Column:
    return F.regexp_replace(text, OLD_DENIED["sth_collection"], "_")


def encode_old_steps(df: DataFrame, text: str) -> tuple[DataFrame, dict[str, Column]]:
    """All old encodings of the column ``text``, as ``encode_steps`` gives the others.
    One pass tests a class, the rest replaces single characters of its result."""
    def without(source: Column, chars: str) -> Column:
        for char in chars:
            source = F.replace(source, F.lit(char), F.lit("_"))
        return source

    df = df.withColumn("_old_path", F.regexp_replace(text, r"[^\p{Alnum}.\-/]", "_"))
    df = df.withColumns({"_old": without(F.col("_old_path"), "/"), "_sth_collection": without(F.col(text), "=$")})
    return df, {
        "old": F.col("_old"), "old_path": F.col("_old_path"), "old_table": F.substr(F.col("_old"), F.lit(2)),
        "ld_table": without(F.col("_old_path"), ".-"), "sth_database": without(F.col("_sth_collection"), '/\\." '),
        "sth_collection": F.col("_sth_collection"),
    }
