"""Line-oriented sources: text globs and the delimited record formats.

* ``scan_lines`` (S2): ``spark.read.text`` over a glob; a pattern that
  matches no file is Spark's own error, in any file system.
* ``parse_interactions`` (S5): ``user item count`` separated by whitespace.
* ``parse_alias_lines`` (S6): ``alias<TAB>canonical``.
* ``parse_name_lines`` (S7): ``id<TAB>name``.

All parsers are column expressions over the ``value`` column (no Python per
line); each keeps a ``valid`` flag so rejected lines can be counted in the same
pass instead of failing the job. With ``strict`` a line whose numbers cannot be read
fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.parsing import INT_PATTERN, strip_ws

# Fixed patterns: field separators of the reference's text formats.
WHITESPACE = r"\s+"
TAB = "\t"


def scan_lines(spark: SparkSession, pattern: str, with_file: bool = False) -> DataFrame:
    """Read text lines from a path or glob (column ``value``; ``file`` when asked)."""
    df = spark.read.text(pattern)
    if with_file:
        df = df.withColumn("file", F.col("_metadata.file_path"))
    return df


def write_lines(df: DataFrame, line_col: str, path: str) -> str:
    """Write one text column as text files (used to stage derived inputs)."""
    df.select(F.col(line_col).alias("value")).write.mode("overwrite").text(path)
    return path


def write_lines_by(df: DataFrame, key: str, path: str, open_files: int = 200) -> str:
    """Write lines as text files, a folder a value of ``key``, without sorting a task's lines by it.

    A task keeps up to ``open_files`` files open; Spark sorts the rows of a task that meets more values.
    """
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(open_files))
    try:
        df.write.partitionBy(key).text(path)
    finally:
        conf.set(name, before)
    return path


def _int_token(tok) -> F.Column:
    t = strip_ws(tok)
    return F.when(t.rlike(INT_PATTERN), t.try_cast("bigint"))


def _or_fail(ok, line) -> F.Column:
    """True where ``ok``; elsewhere the job fails and names the line."""
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad line: "), line)).cast("boolean"))


def parse_interactions(lines: DataFrame, value_col: str = "value", strict: bool = False) -> DataFrame:
    """(user_id, item_id, plays, valid): exactly three integer tokens, else invalid (``strict``: the job fails)."""
    toks = F.split(strip_ws(F.col(value_col)), WHITESPACE)
    u, i, c = (_int_token(F.get(toks, k)) for k in range(3))
    valid = F.coalesce((F.size(toks) == 3) & u.isNotNull() & i.isNotNull() & c.isNotNull(), F.lit(False))
    if strict:
        lines = lines.filter(_or_fail(valid, F.col(value_col)))
    return lines.select(
        u.alias("user_id"), i.alias("item_id"), c.alias("plays"), valid.alias("valid")
    )


def parse_alias_lines(lines: DataFrame, value_col: str = "value", strict: bool = False) -> DataFrame:
    """(alias_id, canonical_id, valid): lines with fewer than two fields or an empty first field are invalid,
    and so are ids that are no numbers (``strict``: those fail the job)."""
    toks = F.split(F.col(value_col), TAB)
    a = _int_token(F.get(toks, 0))
    c = _int_token(F.get(toks, 1))
    has_fields = (F.size(toks) >= 2) & (F.get(toks, 0) != F.lit(""))
    numbers = a.isNotNull() & c.isNotNull()
    valid = has_fields & numbers
    if strict:
        lines = lines.filter(_or_fail(~F.coalesce(has_fields, F.lit(False)) | numbers, F.col(value_col)))
    return lines.select(
        a.alias("alias_id"), c.alias("canonical_id"), F.coalesce(valid, F.lit(False)).alias("valid")
    )


def parse_name_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(item_id, name, valid): integer id and a stripped name; any failure drops the line."""
    toks = F.split(F.col(value_col), TAB)
    i = _int_token(F.get(toks, 0))
    name = strip_ws(F.get(toks, 1))
    valid = (F.size(toks) >= 2) & i.isNotNull() & name.isNotNull()
    return lines.select(i.alias("item_id"), name.alias("name"), F.coalesce(valid, F.lit(False)).alias("valid"))


def line_counts(parsed: DataFrame) -> DataFrame:
    """Raw, parsed and dropped line counts in one aggregate."""
    return parsed.agg(
        F.count(F.lit(1)).alias("raw_lines"),
        F.count_if(F.col("valid")).alias("parsed_rows"),
        F.count_if(~F.col("valid")).alias("dropped_rows"),
    )
