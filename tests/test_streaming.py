"""Streaming forms agree with their batch operators."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SMALL

from prelaunch.operators import cohort as C
from prelaunch.operators import profile as P
from prelaunch.plans import fixtures as FX
from prelaunch.streaming import scoring as ST


def test_yearly_stats_stream_equals_batch(spark):
    g = C.with_release_parts(FX.games(spark, SMALL)).select("game_id", "success", "release_year")
    src = os.path.join(tempfile.mkdtemp(prefix="prelaunch-stream-"), "src")
    g.repartition(4).write.parquet(src)
    stream = ST.read_stream(spark, src, g.schema, max_files_per_trigger=1)
    q = (ST.yearly_stats_stream(stream).writeStream.format("memory").queryName("yearly_stream")
         .outputMode("complete").start())
    q.processAllAvailable()
    q.stop()
    got = {r.release_year: (round(r.success_rate, 9), r.total_games) for r in spark.sql("SELECT * FROM yearly_stream").collect()}
    ref = {r.release_year: (round(r.success_rate, 9), r.total_games)
           for r in P.yearly_stats(g, "success", "release_year").collect()}
    assert got == ref
