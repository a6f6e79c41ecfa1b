"""Raw files as bytes: reading, sniffing, decoding, addressing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Leading bytes of packed or binary formats, in hexadecimal.
BINARY_PREFIXES = [
    "504B",          # zip
    "1F8B",          # gzip
    "25504446",      # pdf
    "D0CF11E0",      # ole2
    "52617221",      # rar
    "377ABCAF",      # 7z
]
MAX_CONTROL_SHARE = 0.10
# Formats with a binary reader of their own, which are never sniffed.
BINARY_FORMATS = ["xlsx", "xls"]
URI_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/]+)(?:/(.*))?$"


def read_files(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """Files below ``path`` as ``(uri, length, modified_at, content)``; the size limit is pushed to the scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if max_bytes is not None:
        files = files.filter(F.col("length") <= max_bytes)
    return files.select(
        F.col("path").alias("uri"), "length", F.col("modificationTime").alias("modified_at"), "content"
    )


def is_binary(content: Column, file_format: Column, sample_bytes: int | None = None) -> Column:
    """Content that must not reach a text reader, judged by all of it unless a sample size is given."""
    head = F.hex(F.substring(content, 1, 4))
    prefixed = reduce(lambda a, b: a | b, [head.startswith(p) for p in BINARY_PREFIXES])
    sample = content if sample_bytes is None else F.substring(content, 1, sample_bytes)
    # a character for each byte; other than control characters go by runs
    control = F.length(F.regexp_replace(F.decode(sample, "ISO-8859-1"), r"[^\x00-\x08\x0b\x0c\x0e-\x1f]++", ""))
    share = control / F.greatest(F.length(sample), F.lit(1))
    return (
        F.when(F.lower(file_format).isin(BINARY_FORMATS), False)
        .when(F.coalesce(F.length(content), F.lit(0)) == 0, False)
        .otherwise(prefixed | (share > MAX_CONTROL_SHARE))
    )


def decode_text(content: Column) -> Column:
    """UTF-8 with or without byte order mark, else Latin-1."""
    utf8 = content.cast("string")
    return F.when(
        F.is_valid_utf8(utf8),
        F.when(F.hex(F.substring(content, 1, 3)) == "EFBBBF", F.substr(utf8, F.lit(2))).otherwise(utf8),
    ).otherwise(F.decode(content, "ISO-8859-1"))


def uri_parts(uri: Column, scheme: str = "gs") -> Column:
    """``struct(bucket, path, error)``; an address of another scheme carries an error instead of raising."""
    good = F.coalesce(F.regexp_extract(uri, URI_PATTERN, 1) == scheme, F.lit(False))
    return F.struct(
        F.when(good, F.regexp_extract(uri, URI_PATTERN, 2)).alias("bucket"),
        F.when(good, F.regexp_extract(uri, URI_PATTERN, 3)).alias("path"),
        F.when(~good, F.concat(F.lit("not a " + scheme + " address: "), F.coalesce(uri, F.lit("null")))).alias("error"),
    )
