import ast

import corpus_pipeline
from fixtures_llm import documents
from test_decontaminate import brute as leaks
from test_jaccard import brute as groups

from intactly.llm.common import staged, table

SF = "/root/testdata/sf0.001"


def test_stages_on_the_small_tables(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = staged(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        after = {r.doc_id for r in docs.collect()}
        assert after <= {i for i, _ in before}
        if name == "near duplicates":
            found = [ast.literal_eval(g) for g in groups(before)]
            assert after == {i for i, _, least in found if i == least}
        if name == "decontamination":
            found = [ast.literal_eval(x) for x in leaks(before, items)]
            assert after == {i for i, _, n_hit, _ in found if not n_hit}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in last} == after
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in last)


def test_edges_pass_through(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, "the thing of it"), (3, "the thing of it")], extra=False)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, SF), "stage")
    assert sorted(r.doc_id for r in docs.collect()) == [1, 2, 3, 3]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = staged(stage(spark, empty, SF), "stage")
    assert empty.count() == 0
