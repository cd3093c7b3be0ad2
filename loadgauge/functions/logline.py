"""Access-log lines as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The line format, the offset-carrying time format and the month names.
LINE_PATTERN = r'(\S++) \S++ \S++ \[([^\]]++)\] "([^"]*+)" (\d{3}) (\S++)'
TIME_PATTERN = r"^\d{2}/[A-Za-z]{3}/\d{4}:[0-2]\d:[0-5]\d:[0-5]\d ([+-]\d{2}:?\d{2}|Z)$"
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


def readable(value: Column) -> Column:
    """The line without undecodable bytes; lines that are valid UTF-8 are left alone."""
    cleaned = F.replace(F.make_valid_utf8(value), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(cleaned)


def unfold(line: Column) -> Column:
    """Host, time, request, status and bytes of a line in log format, one below the other.

    Other lines come back unchanged, and no line in log format does: its brackets and quotes are gone.
    So one match both recognises a line and takes it apart; there is no line break inside a line.
    The search starts at the first character of a token only and gives no character of a token back, so that a long
    line of junk takes time in proportion to its length.
    """
    return F.regexp_replace(line, f"(?s)^(?:.*?\\s)??(?<!\\S){LINE_PATTERN}.*$", "$1\n$2\n$3\n$4\n$5")


def normalize_time(text: Column) -> Column:
    """Wall clock of ``01/Jul/1995:00:00:01 -0400`` as TIMESTAMP_NTZ: the offset is checked, not applied.

    Malformed and impossible dates give NULL.
    """

    def number(start: int, width: int) -> Column:
        return F.substring(text, start, width).try_cast("int")

    at = F.instr(F.lit(MONTHS), F.lower(F.substring(text, 4, 3)))
    month = F.when(F.pmod(at, F.lit(4)) == 1, ((at + F.lit(3)) / F.lit(4)).cast("int"))
    stamp = F.try_make_timestamp_ntz(
        number(8, 4), month, number(1, 2), number(13, 2), number(16, 2), number(19, 2).cast("decimal(16,6)")
    )
    return F.when(text.rlike(TIME_PATTERN), stamp)


def bytes_count(token: Column) -> Column:
    """Body size; ``-`` counts as 0 and a token that is no whole number as NULL."""
    return F.when(token == "-", F.lit(0).cast("long")).otherwise(token.try_cast("bigint"))


def request_extension(request: Column) -> Column:
    """File type of the requested address: text after its last dot, lower-cased."""
    url = F.regexp_extract(request, r"^\s*\S+\s+(\S+)", 1)
    return (
        F.when(request.isNull(), F.lit("error"))
        .when(F.instr(url, ".") > 0, F.lower(F.substring_index(url, ".", -1)))
        .otherwise(F.lit("unknown"))
    )
