import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loomline.llm import bpe

CHARS = "aab cdeé'strevlmd  \n\t　 \x1c\x85​0123٣½五ⅣΩβ한국中文字🙂𐀀́!?.,'\"<|endoftext|>the ing tion"


@pytest.fixture(scope="module")
def coder():
    with open(bpe.DEFAULT_RANKS, "rb") as file:
        return bpe.Transducer(bpe.read_ranks(file.read()))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(bpe.DEFAULT_RANKS.replace(".tiktoken", ".json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def random_texts(n, longest, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(CHARS) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_equals_the_library(coder, library):
    texts = random_texts(3000, 60, 1) + ["it's 's' ''s don't we'll I'VE  's\n's", "'", "''", "'s", "a'", "  ", "\n\n a", "x  \n y", "'ll've", "<|endoftext|>", "가" * 5000, "a" * 3000]
    got = bpe.encode_column(pa.array(texts), coder).to_pylist()
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == expected


def test_table_that_overflows_gives_the_same_ids(coder):
    texts = random_texts(400, 60, 2) + ["中文字한국" * 400]
    with open(bpe.DEFAULT_RANKS, "rb") as file:
        small = bpe.Transducer(bpe.read_ranks(file.read()), max_states=40)
    assert bpe.encode_column(pa.array(texts), small).to_pylist() == bpe.encode_column(pa.array(texts), coder).to_pylist()
    assert small.rebuilt > 0


def test_decoding_restores_the_text(coder):
    for text in random_texts(200, 80, 3):
        assert bpe.decode_ids(coder.encode(text), coder.tokens) == text


def test_incremental_decoder_equals_the_whole():
    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice([0x41, 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0x99, 0x82, 0xC3, 0xA9, 0xFF]) for _ in range(rng.randint(0, 12)))
        decoder, out, at = bpe.Utf8Decoder(), "", 0
        while at < len(data):
            step = rng.randint(1, 3)
            out += decoder.feed(data[at : at + step])
            at += step
        out += decoder.feed(b"", final=True)
        if data.decode("utf-8", "ignore").encode() == data:
            assert out == data.decode()
        assert set(out) <= set(data.decode("utf-8", "replace")) | {"�"}


def test_operator(spark, library):
    rows = [(1, "中文 text", "a"), (2, None, "b"), (3, "", "c"), (3, "", "c"), (4, "x" * 200_000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __text string")
    got = sorted((r["doc_id"], list(r["ids"])) for r in bpe.encode_documents(df, keep=["doc_id"]).collect())
    assert got == sorted((i, library.encode(t or "", add_special_tokens=False).ids) for i, t, _ in rows)
    assert bpe.encode_documents(df.limit(0), keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        bpe.encode_documents(df.withColumnRenamed("doc_id", "ids"))


def test_broken_bytes_count_as_replacement(coder):
    data, rows = bpe.repaired(np.frombuffer(b"a\xffb\xe4\xb8", np.uint8), np.array([0, 3, 5]))
    assert data.tobytes().decode() == "a�b�" and rows.tolist() == [0, 5, 8]
