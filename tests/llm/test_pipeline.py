"""The pipeline against its operators' brute-force parts, and on odd tables."""

import corpus_pipeline
from extracteval.llm.decontamination import ItemIndex, normalise
from extracteval.llm.pii import base_spans
from extracteval.llm.simhash import fingerprint
from extracteval.llm.toxicity import learn_grammar
from extracteval.llm.common import DOCUMENT_COLUMNS, read

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = read(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "best_fit_packing"]
    grammar = learn_grammar(docs, read(spark, SF, "labels"))
    left = {d: t for d, t in rows.items() if grammar.score(t) < 0.5}
    fps, group = {d: fingerprint(t) for d, t in left.items()}, {}
    for d in sorted(left):
        if d in group:
            continue
        todo = [d]
        group[d] = d
        while todo:
            x = todo.pop()
            for y in left:
                if y not in group and (fps[x] ^ fps[y]).bit_count() <= 3:
                    group[y] = d
                    todo.append(y)
    index = ItemIndex([(r.item_id, normalise(r.text)) for r in read(spark, SF, "benchmark").collect()])
    want = sorted(d for d in left if group[d] == d and not index.find(normalise(left[d])))
    got = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, got, SF)
        assert got.columns == DOCUMENT_COLUMNS, name
    kept = {r.doc_id: r for r in got.collect()}
    assert sorted(kept) == want
    assert not any(base_spans(r.text) for r in kept.values()) and all(r.n_chars == len(r.text) for r in kept.values())
    packed = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r.doc_id for r in packed}) == want


def test_stages_on_odd_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "idiot you idiot", "en", "a", 9), (4, "x " * 30_000, "en", "a", 1), (5, "same", "en", "a", 1), (5, "same", "en", "a", 1), (None, "none", "en", "a", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, schema).withColumn("uid", F.lit(1)).withColumn("fp", F.lit("x"))
    for table in (docs, docs.limit(0)):
        got = table
        for _, stage in corpus_pipeline.STAGES:
            got = stage(spark, got, SF)
        found = sorted({r.doc_id or 0 for r in got.collect()})
        assert found == ([0, 1, 4, 5] if table is docs else [])
