"""Decontamination of a benchmark in many chunks gives what one chunk gives, with a plan of fixed size."""

from extracteval.llm.common import read
from extracteval.llm.decontamination import ItemIndex, find_leaks, keep_uncontaminated, normalise

SF = "/root/testdata/sf0.001"


def test_chunks_change_no_result(spark):
    docs, bench = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    one = sorted(map(tuple, find_leaks(docs, bench).collect()))
    many = find_leaks(docs, bench, chunk_bytes=2_000)
    assert one and sorted(map(tuple, many.collect())) == one
    assert many._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    kept = sorted(r.doc_id for r in keep_uncontaminated(docs, bench).collect())
    assert sorted(r.doc_id for r in keep_uncontaminated(docs, bench, chunk_bytes=2_000).collect()) == kept
    assert set(kept) == {r.doc_id for r in docs.collect()} - {d for d, *_ in one}
    nothing = bench.where("text IS NULL")
    assert find_leaks(docs, nothing).count() == 0 and keep_uncontaminated(docs, nothing).count() == docs.count()


def test_short_items_stand_at_word_boundaries():
    items = [(1, b"ab cd"), (2, b"cd"), (3, b"ab"), (4, b"cd")]
    index = ItemIndex(items)
    assert [(index.ids[k], s, e) for k, _, s, e in index.find(normalise("xab ab cd. abc CD"))] == [(1, 4, 9), (2, 7, 9), (3, 4, 6), (4, 7, 9)]
    assert index.find(b"abc xcd") == [] and index.find(b"") == []
