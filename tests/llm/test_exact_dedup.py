import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from ontime.llm.exact_dedup import exact_dedup, exact_groups
from tests.llm.brute import SCHEMA, odd_documents

WEAK = lambda c: F.substring(F.sha2(c, 256), 1, 1)  # noqa: E731  a digest that many contents share


def strip(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    by_text = {}
    for r in rows:
        by_text.setdefault(strip(r["text"]), []).append(r)
    out = Counter()
    for content, members in by_text.items():
        best = max(members, key=lambda r: (len(r["text"] or ""), r["doc_id"] is not None, -(r["doc_id"] or 0)))
        sha = hashlib.sha256(content.encode()).hexdigest()
        seen = False
        for r in members:
            kept = not seen and r["doc_id"] == best["doc_id"] and len(r["text"] or "") == len(best["text"] or "")
            seen = seen or kept
            out[r["doc_id"], best["doc_id"], len(members), kept, sha] += 1
    return out


def test_groups_match_brute_force(spark):
    docs = odd_documents(spark).repartition(5)
    want = expected(docs.collect())
    assert Counter(tuple(r) for r in exact_groups(docs).collect()) == want


def test_a_digest_that_contents_share_changes_nothing(spark):
    docs = odd_documents(spark).repartition(5)
    want = expected(docs.collect())
    assert Counter(tuple(r) for r in exact_groups(docs, digest=WEAK, salts=3).collect()) == want


def test_filter_keeps_one_row_of_each_text(spark):
    docs = odd_documents(spark)
    for digest in (None, WEAK):
        kept = exact_dedup(docs, **({"digest": digest} if digest else {}))
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert sorted(strip(r["text"]) for r in rows) == sorted({strip(r["text"]) for r in docs.collect()})
        assert {r["doc_id"] for r in rows if strip(r["text"]) == "onetwothreefourfive"} == {2}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).collect() == [] and exact_dedup(empty).collect() == []
