"""Fixed-width weather records.

A record is one text line. Each field is a slice of the line (0-based,
half-open), trimmed; optional fields turn their missing codes into null and
are divided by a scale; required fields must be integers, and the label must
be present, or the line is dropped. Lines shorter than ``MIN_LENGTH`` are
dropped. Everything is a projection + filter, so Catalyst prunes and fuses it.

``with_validity_by_batch`` gives the same rows for jobs that need every field: the digits of
plain lines are read an Arrow batch at a time, and only other lines go through the expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.parsing import slice_text, strip_ws, trimmed_int, trimmed_scaled


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    end: int
    scale: float | None = None  # None: required integer
    missing: tuple[str, ...] = ()


# Record layout, scales and missing codes of the weather format.
MIN_LENGTH = 98
DATE_FIELDS = (
    Field("year", 15, 19),
    Field("month", 19, 21),
    Field("day", 21, 23),
    Field("hour", 23, 25),
)
OPTIONAL_FIELDS = (
    Field("latitude", 28, 34, 1000.0, ("+99999", "-99999", "999999")),
    Field("longitude", 34, 41, 1000.0, ("+999999", "-999999", "9999999")),
    Field("elevation", 46, 51, 1.0, ("+9999", "-9999", "99999")),
    Field("wind_direction", 60, 63, 1.0, ("999",)),
    Field("wind_speed", 65, 69, 10.0, ("9999",)),
    Field("ceiling_height", 70, 75, 1.0, ("99999",)),
    Field("visibility_distance", 78, 84, 1.0, ("999999",)),
    Field("dew_point_temperature", 93, 98, 10.0, ("+9999", "-9999", "99999")),
)
LABEL_FIELD = Field("air_temperature", 87, 92, 10.0, ("+9999", "-9999", "99999"))

BASE_FEATURES = [f.name for f in DATE_FIELDS]
NULLABLE_FEATURES = [f.name for f in OPTIONAL_FIELDS]
FEATURES = BASE_FEATURES + NULLABLE_FEATURES
LABEL = LABEL_FIELD.name


def parse_columns() -> list:
    """The typed fields, of the trimmed texts that ``with_validity`` has in columns of their own."""
    t = lambda f: F.col(f"_text_{f.name}")
    cols = [trimmed_int(t(f)).alias(f.name) for f in DATE_FIELDS]
    return cols + [trimmed_scaled(t(f), f.scale, f.missing).alias(f.name) for f in (*OPTIONAL_FIELDS, LABEL_FIELD)]


def with_validity(lines: DataFrame, value_col: str = "value", carry: Sequence[str] = ()) -> DataFrame:
    """All parsed columns plus ``valid`` (kept by the reference's parser) for each line, and the columns ``carry``.

    A field is cut and trimmed in a projection of its own: the guards and the conversion then share the text.
    """
    v = F.col(value_col)
    fields = (*DATE_FIELDS, *OPTIONAL_FIELDS, LABEL_FIELD)
    cut = lines.select(F.length(v).alias("_len"), *carry, *[strip_ws(slice_text(v, f.start, f.end)).alias(f"_text_{f.name}") for f in fields])
    parsed = cut.select("_len", *carry, *parse_columns())
    ok = F.col("_len") >= MIN_LENGTH
    for name in BASE_FEATURES + [LABEL]:
        ok = ok & F.col(name).isNotNull()
    return parsed.select(*carry, *FEATURES, LABEL, F.coalesce(ok, F.lit(False)).alias("valid"))


def _plain_number(chars: Sequence[np.ndarray], signed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(plain, negative, size) of one field, given its bytes as a column a place: plain is all digits, or with
    ``signed`` digits behind a sign."""
    first, *others = chars
    size = (first - 48).astype(np.int64)
    plain = (first - 48) < 10
    negative = np.zeros(len(first), bool)
    if signed and others:
        negative = first == ord("-")
        marked = negative | (first == ord("+"))
        plain |= marked
        size[marked] = 0
    for c in others:
        digit = c - 48
        plain &= digit < 10
        size = size * 10 + digit
    return plain, negative, size


def _plain_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (value): (plain, rest, fields...). A plain line is at least ``MIN_LENGTH`` ASCII characters with required
    integers that are digits alone and other fields of digits, perhaps behind a sign; any other line is kept as ``rest``."""
    for batch in batches:
        value, n = batch.column(0), batch.num_rows
        text = value.cast(pa.large_binary())
        at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        plain = np.diff(at) >= MIN_LENGTH  # a null has no characters
        odd = np.flatnonzero(data[at[0]:at[-1]] > 127) + at[0]
        plain[np.searchsorted(at, odd, "right") - 1] = False
        data = data if len(data) >= MIN_LENGTH else np.zeros(MIN_LENGTH, np.uint8)
        start = np.where(plain, at[:-1], 0)
        columns = []
        for f in (*DATE_FIELDS, *OPTIONAL_FIELDS, LABEL_FIELD):
            chars = [data[start + k] for k in range(f.start, f.end)]
            digits, negative, size = _plain_number(chars, signed=f.scale is not None)
            plain &= digits
            if f.scale is None:
                columns.append((size.astype(np.int32), None))
                continue
            missing = np.zeros(n, bool)
            for code in f.missing:
                if len(code) == len(chars):
                    missing |= np.all([c == ord(x) for c, x in zip(chars, code)], axis=0)
            number = size.astype(np.float64)
            columns.append((np.where(negative, -number, number) / f.scale, missing))
        fields = [pa.array(v, mask=~plain if gone is None else gone | ~plain) for v, gone in columns]
        rest = value.filter(pa.array(~plain)).take(pa.array(np.cumsum(~plain) - 1, mask=plain))
        yield pa.RecordBatch.from_arrays([pa.array(plain), rest, *fields], names=["plain", "rest", *[f"plain_{c}" for c in (*FEATURES, LABEL)]])


def with_validity_by_batch(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """The rows of ``with_validity``; plain lines are read by ``_plain_batches`` instead of an expression a field."""
    fields = [(f"plain_{f.name}", "int" if f.scale is None else "double") for f in (*DATE_FIELDS, *OPTIONAL_FIELDS, LABEL_FIELD)]
    schema = ", ".join(f"{c} {t}" for c, t in [("plain", "boolean"), ("rest", "string"), *fields])
    both = with_validity(lines.select(value_col).mapInArrow(_plain_batches, schema), "rest", carry=["plain", *[c for c, _ in fields]])
    read = [F.when(F.col("plain"), F.col(f"plain_{c}")).otherwise(F.col(c)).alias(c) for c in (*FEATURES, LABEL)]
    return both.select(*read, F.when(F.col("plain"), F.col(f"plain_{LABEL}").isNotNull()).otherwise(F.col("valid")).alias("valid"))


def parse_records(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Typed weather rows; invalid lines are dropped."""
    return with_validity(lines, value_col).filter("valid").drop("valid")


def record_counts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw lines, parsed rows and dropped lines in one pass."""
    v = with_validity(lines, value_col)
    return v.agg(
        F.count(F.lit(1)).alias("raw_lines"),
        F.count_if("valid").alias("parsed_rows"),
        F.count_if(~F.col("valid")).alias("dropped_rows"),
    )
