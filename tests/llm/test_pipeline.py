import numpy as np

import corpus_pipeline
from ontime.llm import classifier, packing
from ontime.llm.common import table
from ontime.llm.simhash import fingerprint
from tests.llm.brute import WORDS, groups
from tests.llm.test_exact_dedup import strip
from tests.llm.test_simhash import near

SF = "/root/testdata/sf0.001"


def kept_bytes(rows):
    """Texts without the 50-byte strings that documents of smaller id hold."""
    first, out = {}, {}
    for doc_id, text in rows:
        body = text.encode()
        for i in range(len(body) - 49):
            first[body[i:i + 50]] = min(first.get(body[i:i + 50], doc_id), doc_id)
    for doc_id, text in rows:
        body = text.encode()
        gone = bytearray(len(body))
        for i in range(len(body) - 49):
            if first[body[i:i + 50]] < doc_id:
                gone[i:i + 50] = b"\1" * 50
        out[doc_id] = bytes(b for b, g in zip(body, gone) if not g).decode("utf-8", "ignore")
    return out


def test_pipeline_matches_plain_python(spark):
    docs = table(spark, SF, "documents")
    passed = {r.doc_id for r in classifier.verdicts(docs, table(spark, SF, "labels")).collect() if r.predicted}
    rows = [(r.doc_id, r.text or "") for r in docs.collect() if r.doc_id in passed]
    best = {}
    for doc_id, text in rows:
        rank = (-len(text), doc_id)
        best[strip(text)] = min(best.get(strip(text), (rank, text)), (rank, text))
    rows = [(rank[1], text) for rank, text in best.values()]
    marks = {doc_id: fingerprint(text.encode()) for doc_id, text in rows}
    root = groups(set(marks.values()), near(set(marks.values())))
    least = {}
    for doc_id, mark in marks.items():
        least[root[mark]] = min(least.get(root[mark], doc_id), doc_id)
    rows = [(doc_id, text) for doc_id, text in rows if least[root[marks[doc_id]]] == doc_id]
    texts = kept_bytes(rows)
    lengths = {doc_id: len(WORDS.findall(text.encode())) + 1 for doc_id, text in texts.items()}
    values, counts = np.unique(list(lengths.values()), return_counts=True)
    bounds = packing.best_boundaries(values, counts, packing.BUCKETS)
    got = corpus_pipeline.run(spark, SF).collect()
    assert len(passed) > 100 and len(rows) < len(passed)
    assert sorted((r.doc_id, r.n_tokens, r.padded_to) for r in got) == sorted((i, n, min(b for b in bounds if b >= n)) for i, n in lengths.items())


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents").limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
