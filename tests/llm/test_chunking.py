import random

import numpy as np
import pytest

from loomline.llm import bpe, chunking

LIMIT, OVERLAP = 64, 8


@pytest.fixture(scope="module")
def coder():
    with open(bpe.DEFAULT_RANKS, "rb") as file:
        return bpe.Transducer(bpe.read_ranks(file.read()))


def text_of(rng, sentences):
    words = ["骑士", "归还", "珍贵的", "龙蛋", "용사가", "방패를", "the", "knight", "β测试券"]
    out = ""
    for i in range(sentences):
        out += "".join(rng.choices(words, k=rng.randint(3, 9))) + rng.choice(["。", "！", ". ", "\n", "\n\n", "\n\n## 第2章 甲\n\n"])
    return out


def check(spark, coder, texts, limit=LIMIT, overlap=OVERLAP):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = chunking.split_documents(df, limit=limit, overlap=overlap).orderBy("doc_id", "piece_no").collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, text in enumerate(texts):
        long = len(coder.encode(text or "")) > limit
        assert (i in by_doc) == long
        if not long:
            continue
        pieces = by_doc[i]
        assert [p["piece_no"] for p in pieces] == list(range(1, len(pieces) + 1)) and {p["n_pieces"] for p in pieces} == {len(pieces)}
        assert pieces[0]["begin_char"] == 0 and pieces[-1]["end_char"] == len(text)
        rebuilt = ""
        for before, p in zip([None, *pieces], pieces):
            assert p["text"] == text[p["begin_char"] : p["end_char"]] and p["n_tokens"] == len(coder.encode(p["text"])) <= limit
            if before:
                assert p["begin_char"] + p["overlap_chars"] == before["end_char"]
                shared = len(coder.encode(text[p["begin_char"] : before["end_char"]]))
                assert abs(shared - overlap) <= 4
            rebuilt += p["text"][p["overlap_chars"] :]
        assert rebuilt == text
    return by_doc


def test_pieces_cover_texts_within_the_limit(spark, coder):
    rng = random.Random(1)
    texts = [text_of(rng, n) for n in (0, 1, 5, 30, 80)] + [None, "", "가" * 900, "🙂" * 300, "a" * 5000, "龙" * 400 + "。"]
    by_doc = check(spark, coder, texts)
    natural = [p["text"][-1] in "。！. \n" for i in (3, 4) for p in by_doc[i][:-1]]
    assert sum(natural) > 0.8 * len(natural)  # a sentence may fill the whole window


def test_edits_alter_neighbouring_pieces_only(coder):
    rng = random.Random(2)
    text = text_of(rng, 400)
    edited = text[: len(text) // 2] + "新的句子。" + text[len(text) // 2 :]
    cut = []
    for t in (text, edited):
        data = np.frombuffer(t.encode(), np.uint8)
        pieces = chunking.split_texts(data, np.array([0, len(data)]), coder, LIMIT, LIMIT // 2, OVERLAP)[0]
        cut.append({data[a:b].tobytes() for a, b, _, _ in pieces})
    assert len(cut[0] - cut[1]) <= 12 < len(cut[0])


def test_boundaries():
    text = "一。二！\n三\n\n标题\n\n四"
    at, levels = chunking.boundaries(text)
    assert dict(zip(at.tolist(), levels.tolist())) == {2: chunking.SENTENCE, 5: chunking.LINE, 8: chunking.SECTION, 12: chunking.PARAGRAPH}


def test_repeated_rows_empty_table_and_sizes(spark):
    df = spark.createDataFrame([(1, "龙" * 400, "x"), (1, "龙" * 400, "x")], "doc_id long, text string, piece_no string")
    rows = chunking.split_documents(df, limit=LIMIT, overlap=OVERLAP).collect()
    assert len(rows) == 2 * len({r["piece_no"] for r in rows})
    assert chunking.split_documents(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chunking.split_documents(df, limit=10, overlap=8)


class Fussy:
    """A coder to which pieces with a mark cost three tokens more by themselves."""

    def __init__(self, coder, mark):
        self.coder, self.mark, self.calls, self.added = coder, mark.encode(), 0, 0

    def encode_joined(self, data, starts):
        ids, ends = self.coder.encode_joined(data, starts)
        self.calls += 1
        if self.calls > 1:
            bounds = [*np.asarray(starts).tolist(), len(data)]
            marked = [b for a, b in zip(bounds, bounds[1:]) if self.mark in data[a:b].tobytes()]
            self.added += len(marked)
            ends = np.sort(np.concatenate([ends, np.repeat(np.array(marked, ends.dtype), 3)]))
        return ids, ends


def test_an_oversized_piece_shrinks_alone(coder):
    """A piece that encodes to too many tokens by itself moves no piece far from it, wherever the text is edited."""
    rng, again = random.Random(5), 0
    for _ in range(20):
        text = text_of(rng, 60) + "甲乙丙" + text_of(rng, 400)
        at = text.index("\n", len(text) * 3 // 4)
        cut = []
        for t in (text, text[:at] + "新的句子。" + text[at:]):
            data, fussy = np.frombuffer(t.encode(), np.uint8), Fussy(coder, "甲乙丙")
            pieces = chunking.split_texts(data, np.array([0, len(data)]), fussy, LIMIT, LIMIT - 8, OVERLAP)[0]
            assert all(n <= LIMIT for _, _, n, _ in pieces) and pieces[0][0] == 0 and pieces[-1][1] == len(data)
            cut.append([data[a:b].tobytes() for a, b, _, _ in pieces])
            again += fussy.calls > 2
        first = next(i for i, (a, b) in enumerate(zip(*cut)) if a != b)
        assert first > len(cut[0]) // 2  # nothing before the edit changes
    assert again >= 4
