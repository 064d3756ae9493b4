"""Texts leave the mix whole."""

from collections import Counter

from menulake.llm.common import table
from menulake.llm.mix import mix, mixed_documents

SF = "/root/testdata/sf0.01"


def test_texts_leave_the_mix_whole(spark):
    # blocks much smaller than the documents, as at sf0.1, and shards of many documents
    docs = table(spark, SF, "documents")
    old = {r.doc_id: r for r in docs.collect()}
    rows = mix(docs, shards=100).collect()
    got = mixed_documents(docs, shards=100).collect()
    assert all(r.text == old[r.doc_id].text and r.n_chars == old[r.doc_id].n_chars for r in got)
    size, most, quota, words = {r.doc_id: r.size for r in rows}, Counter(), Counter(), Counter()
    for r in rows:
        most[r.source] = max(most[r.source], r.size)
        quota[r.source] += r.taken
    for r in got:
        words[r.source] += size[r.doc_id]
    slack = 100 * 3  # blocks are even but for a word
    assert any(r.target < r.source_size for r in rows)
    assert all(quota[s] - most[s] - slack < words[s] <= quota[s] + slack for s in quota)
    assert max(Counter(r.doc_id for r in got).values()) <= 3
    assert sorted(r.doc_id for r in mixed_documents(docs.repartition(7), shards=100).select("doc_id").collect()) == sorted(r.doc_id for r in got)
