"""The stages of the pipeline, one after the other, against plain Python."""

import re

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_llm import clusters
from varloom.llm import decontaminate
from varloom.llm.common import written


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, kept = docs.columns, {r.doc_id: r.text or "" for r in docs.collect()}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    bench = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
        if name == "language_id":
            kept = {i: t for i, t in kept.items() if re.search(r"[^\W\d_]", t)}
        elif name == "exact_dedup":
            last = {}
            for i in sorted(kept):
                last[kept[i].translate(lower)] = i
            kept = {i: kept[i] for i in last.values()}
        elif name == "near_dedup":
            ids = sorted(kept)
            root, _ = clusters([kept[i] for i in ids], 5)
            kept = {i: kept[i] for j, i in enumerate(ids) if root[j] == j}
        elif name == "decontamination":
            kept = {i: t for i, t in kept.items() if not any(b in decontaminate.normal(t) for b in bench)}
        else:
            assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(kept)
            assert k == len(corpus_pipeline.STAGES) - 1
            break
        assert docs.columns == names
        docs = written(spark, docs, name)
        assert {r.doc_id: r.text or "" for r in docs.collect()} == kept, name
    assert corpus_pipeline.run(spark, SMALL).select("doc_id").distinct().count() == len(kept)
