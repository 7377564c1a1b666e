"""Ids become texts again."""

import pytest

from loomline.llm import bpe


def test_documents_round_trip(spark):
    texts = ["가나다 abc 龙🙂", "", None, "<|endoftext|>", "x" * 3000]
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, extra string")
    ids = bpe.encode_documents(df)
    got = {r["doc_id"]: (r["text"], r["extra"]) for r in bpe.decode_documents(ids).collect()}
    assert got == {i: (t or "", "e") for i, t in enumerate(texts)}
    assert bpe.decode_documents(ids.limit(0)).count() == 0
    with pytest.raises(ValueError):
        bpe.decode_documents(ids, out="extra")
    broken = spark.createDataFrame([(1, [0])], "doc_id long, ids array<int>")
    assert bpe.decode_documents(broken).count() == 1
