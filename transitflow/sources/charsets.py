"""Feed documents of mixed encodings, one document per line.

The original decoded its feed as CP1252.  Files here may be UTF-8 or CP1252,
and each file is decided as a whole: it is UTF-8 if all of its lines are valid
UTF-8.  Lines of other files are decoded as CP1252; lines with a byte that
charset leaves undefined go to the quarantine.  Everything is a native column
expression and needs no legacy charset setting: ISO-8859-1 is decoded by
Spark, and the characters in which CP1252 differs are put in their place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What CP1252 has at 0x80-0x9F; the five undefined bytes are left out.
CP1252_BYTES = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
CP1252_CHARACTERS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
UNDEFINED = "[\x81\x8d\x8f\x90\x9d]"


def decode_cp1252(raw: Column) -> Column:
    """Text of CP1252 bytes; undefined bytes keep their code."""
    return F.translate(F.decode(raw, "ISO-8859-1"), CP1252_BYTES, CP1252_CHARACTERS)


def encode_cp1252(text: Column) -> Column:
    """CP1252 bytes of a text that has no other characters."""
    return F.encode(F.translate(text, CP1252_CHARACTERS, CP1252_BYTES), "ISO-8859-1")


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """file, encoding, json, quarantine of every line below ``path``: the
    decoded document, or, where a byte has no meaning, null and the raw line."""
    lines = (spark.read.option("recursiveFileLookup", True).text(path)
             .select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("raw")))
    valid = F.is_valid_utf8(F.col("raw").cast("string"))
    files = lines.groupBy("file").agg(F.bool_and(valid).alias("utf8"))
    text = F.when(F.col("utf8"), F.col("raw").cast("string")).otherwise(decode_cp1252(F.col("raw")))
    decoded = lines.join(files, "file").select(
        "file", F.when(F.col("utf8"), F.lit("UTF-8")).otherwise(F.lit("CP1252")).alias("encoding"), "raw", text.alias("text"))
    bad = (F.col("encoding") == "CP1252") & F.col("text").rlike(UNDEFINED)
    return decoded.select("file", "encoding", F.when(~bad, F.col("text")).alias("json"),
                          F.when(bad, F.col("raw")).alias("quarantine"))
