"""Very long and monotonous texts take linear time everywhere."""

import time

import pytest
from pyspark.sql import functions as F

from loomline.functions.text import strip
from loomline.llm import chunking, duplicates, leakage, lookalike, pairs, splits, truncation
from loomline.llm.bpe import encode_documents
from loomline.operators.packed import split_packed

LONG = {
    "letters": "长" * 200_000, "blanks": "a" + " " * 200_000 + "b", "lookalikes": "АВС" * 60_000, "labels": "标" * 100_000 + ":5;" + "签" * 100_000, "quotes": '"' * 100_000,
    "stops": "." * 200_000, "words": "字词 " * 60_000, "pipes": "a|" * 60_000, "hangul": "가나 " * 60_000, "tags": "<start>" * 30_000, "lines": "\n" * 100_000 + "x",
}


@pytest.mark.parametrize("name", sorted(LONG))
def test_long_texts(spark, name):
    text = LONG[name]
    df = spark.createDataFrame([("1", text, text, "s"), ("2", "短", "짧다", "s")], "id string, zh string, ko string, source string").coalesce(1)
    other = df.select(F.col("id").alias("key"), "zh", "ko")
    began = time.time()
    lookalike.normalize_columns(df, ["zh"], {"^A": 9}).collect()
    truncation.find_cut_off(df, "ko", "zh", "source").collect()
    pairs.find_defects(df, "id", "zh", "ko").collect()
    duplicates.list_copies(df, "id", ["zh", "ko"]).collect()
    split_packed(df, "id", ["zh", "ko"], "source").count()
    encode_documents(df.select("id", "zh"), "zh").collect()
    chunking.split_documents(df, "id", "zh", with_text=False).collect()
    leakage.find_leaks(df, other, "id", "zh", "key", "ko").collect()
    df.select(F.length(strip(F.col("zh")))).collect()
    assert time.time() - began < 90
