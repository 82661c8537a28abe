"""The weather parse as a stream: two batches of files, restart from the checkpoint."""

from pyspark.sql import functions as F

from quillon.session import staging_path
from quillon.sources import fixedwidth as FW
from quillon.sources import standins, text
from quillon.streaming import ingest

from conftest import SMALL


def test_stream_ingest_matches_batch(spark):
    lines = standins.weather_lines(spark, SMALL).withColumn("half", F.pmod(F.hash("value"), F.lit(2)))
    src = staging_path(spark, "stream-src")
    out = staging_path(spark, "stream-out")
    ckpt = staging_path(spark, "stream-ckpt")
    text.write_lines(lines.filter("half = 0"), "value", f"{src}/a")
    q = ingest.start_weather_ingest(spark, f"{src}/*", out, ckpt)
    q.awaitTermination()
    first = spark.read.parquet(out).count()
    # more files arrive; a new query on the same checkpoint only reads those
    text.write_lines(lines.filter("half = 1"), "value", f"{src}/b")
    q = ingest.start_weather_ingest(spark, f"{src}/*", out, ckpt)
    q.awaitTermination()
    streamed = spark.read.parquet(out)
    batch = FW.parse_records(lines.select("value"))
    assert first < streamed.count() == batch.count()
    cols = FW.FEATURES + [FW.LABEL]
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
