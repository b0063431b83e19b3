"""Token counts against the library on the whole text."""

import random

import pytest

from sitefold.llm.queries import tokenizer_path
from sitefold.llm.token_counts import Encoder, count_tokens

PIECES = ["a", "b", "the", " ", "  ", "é", "你", "𝄞", "\n", "▁", "ing", ".", " <s> ", "123", "ﬁ"]


def texts(seed, count):
    draw = random.Random(seed)
    for k in range(count):
        pool = PIECES if k % 3 else ["a", "b", "the", "你", "𝄞", " "][: 5 + k % 2]
        yield "".join(draw.choice(pool) for _ in range(draw.randrange(500)))


@pytest.mark.parametrize("overlap", [1, 7, 40])
def test_spliced_like_whole(overlap):
    small = Encoder(tokenizer_path(), chunk=64, overlap=overlap)
    assert small.proven
    for text in texts(overlap, 400):
        whole = small.model.encode(text, out_type="proto").pieces if text else []
        assert small.ends(text.encode()) == [p.end for p in whole]
        assert small.count(text) == len(small.model.encode(text))


def test_columns(spark):
    huge = "lorem ipsum dolor " * 9000 + "x" * 40000
    rows = [(1, None, 5), (2, "", 5), (3, "Hello  wörld", 5), (4, huge, 5), (4, huge, 5), (None, "a", 5)]
    found = count_tokens(spark.createDataFrame(rows, "doc_id long, text string, n_tokens long"), tokenizer_path())
    model = Encoder(tokenizer_path()).model
    want = [
        (i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t, _ in rows
    ]
    got = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).count() == 0
