"""Row digests and order-insensitive table fingerprints.

A fingerprint is the row count and, for each of four 32-bit words, the sum of that word of SHA-256(canonical row) over
all rows: 128 bits of each row's digest count. Summing (rather than XOR-ing) keeps it duplicate-sensitive, and because
it is an ordinary aggregate Spark computes it with a partial (map-side) aggregate, so a hot group never has to be
gathered in one task.

The canonical text of a row has every value whole, led by its length in bytes, so no two rows of different values read
the same; NULL has a mark of its own that no value can have. Doubles are their round-trip text, with one spelling for
NaN, the infinities and both zeros; no legal value raises.

The sums are kept in 16-bit halves (no overflow below 1.4e14 rows per group) and written as decimal text, words joined by
a dash. ``added`` sums fingerprints of parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical rendering.
NULL_MARK = "N"
DATE_FORMAT = "yyyy-MM-dd"
WORDS = 4
WORD_HEX_DIGITS = 8
HALF_BITS = 16
ZERO = "-".join(["0"] * WORDS)
_SUM = "decimal(38,0)"


def canonical(col: Column, dtype: T.DataType) -> Column:
    """Renders one value as text that is stable across engines, led by its length; NULL as its mark."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        text = F.when(col == 0, F.lit(0.0)).otherwise(col.cast("double")).cast("string")
    elif isinstance(dtype, T.TimestampNTZType):
        # wall-clock micros since the epoch, independent of the session time zone
        text = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                                col).cast("string")
    elif isinstance(dtype, T.TimestampType):
        text = F.unix_micros(col).cast("string")
    elif isinstance(dtype, T.DateType):
        text = F.date_format(col, DATE_FORMAT)
    elif isinstance(dtype, T.BinaryType):
        text = F.lower(F.hex(col))
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        text = F.to_json(col, {"ignoreNullFields": "false"})
    else:
        text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK))


def canonical_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Canonical text of the chosen columns (all by default), in column order."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    names = columns or list(fields)
    return F.concat(*[canonical(F.col(n), fields[n]) for n in names])


def _joined(words: list[Column]) -> Column:
    return F.concat_ws("-", *[F.coalesce(w, F.lit(0).cast(_SUM)).cast("string") for w in words])


def digest_sum(text: Column) -> Column:
    """Aggregate: the sums of the first four words of SHA-256 of ``text``, as text."""
    digest = F.sha2(text, 256)
    sums = []
    for k in range(WORDS):
        word = F.conv(F.substring(digest, 1 + k * WORD_HEX_DIGITS, WORD_HEX_DIGITS), 16, 10).cast("bigint")
        high, low = F.sum(F.shiftright(word, HALF_BITS)), F.sum(word.bitwiseAND(F.lit((1 << HALF_BITS) - 1)))
        sums.append((high.cast(_SUM) * F.lit(1 << HALF_BITS).cast("decimal(6,0)") + low.cast(_SUM)).cast(_SUM))
    return _joined(sums)


def added(fingerprint: Column) -> Column:
    """Aggregate: the fingerprint of the union of parts from their fingerprints."""
    words = F.split(fingerprint, "-")
    return _joined([F.sum(words[k].cast(_SUM)).cast(_SUM) for k in range(WORDS)])


def fingerprint_aggs(df: DataFrame, columns: list[str] | None = None,
                     prefix: str = "") -> list[Column]:
    """Aggregates ``rows`` and ``fingerprint`` for use inside ``agg``."""
    return [
        F.count(F.lit(1)).alias(f"{prefix}rows"),
        digest_sum(canonical_row(df, columns)).alias(f"{prefix}fingerprint"),
    ]


def fingerprint(df: DataFrame, columns: list[str] | None = None,
                by: list[str] | None = None) -> DataFrame:
    """Fingerprint of a whole table, or per group when ``by`` is given."""
    aggs = fingerprint_aggs(df, columns)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
