"""The language stage when no language can be learned."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_documents_stay_when_nothing_is_learned(spark, odd):
    table = odd.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang", "source", "n_chars")
    got = corpus_pipeline.identify_language(spark, table, SF).collect()
    want = [r["text"] for r in table.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(r["text"] for r in got) == sorted(want) and 0 < len(want) < table.count()
    assert {r["lang"] for r in got} == {None}
