import tempfile

from extracteval.operators import score
from extracteval.sources import fixtures as X
from extracteval.streaming.scoring_stream import start_scoring

SF = "/root/testdata/sf0.001"


def test_stream_scores_like_batch(spark):
    cases = X.x_cases(spark, SF)
    outs = X.x_outputs(spark, SF, cases).select("label", "test_id", "output")
    src = tempfile.mkdtemp(prefix="stream-src-")
    sink = tempfile.mkdtemp(prefix="stream-sink-")
    outs.write.mode("overwrite").json(src)
    q = start_scoring(spark, src, cases, sink, name="t", once=True)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    want = score.score_outputs(score.align_outputs_cases(outs, cases))
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0
