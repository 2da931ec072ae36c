from __future__ import annotations

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallywood.llm import token_counts
from tallywood.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = Tokenizer.from_file(PATH)


def plain(texts):
    return [len(e.ids) for e in ENCODER.encode_batch(texts, add_special_tokens=False)]


def test_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    counts = plain([d.text or "" for d in docs])
    expected = sorted(
        (d.doc_id, len((d.text or "").encode()), n, n > 1024) for d, n in zip(docs, counts)
    )
    assert sorted(map(tuple, QUERIES["op6_token_counts"](spark, folder).collect())) == expected


ODD = st.text(alphabet=" \n\t\r\x1c\x85\xa0 ​abÉ1'.,<|endoftext|>ś日", max_size=30)


@settings(max_examples=400, deadline=None)
@given(ODD)
def test_pieces_have_the_tokens_of_the_text(text):
    assert "".join(token_counts.safe_pieces(text)) == text
    assert token_counts.token_lengths(PATH, [text]) == plain([text])


def test_odd_rows(spark):
    texts = [None, "", " ", "  a  <|endoftext|>  b\n\n", "x" * 5000, "w " * 50_000, "a\t b\r\n c", "dup", "dup"]
    rows = [(None if i == 2 else i, t, 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_tokens int")
    found = token_counts.count_tokens(docs, PATH, limit=3).collect()
    counts = plain([t or "" for t in texts])
    assert [r.n_tokens for r in found] == counts
    assert [r.over_limit for r in found] == [n > 3 for n in counts]
    assert [r.n_bytes for r in found] == [len((t or "").encode()) for t in texts]
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == 0
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = token_counts.count_tokens(docs, path).collect()
    assert [r.n_tokens for r in found] == [len(model.encode(t or "")) for t in texts]


def test_memory_forgets_and_stays_right():
    small = token_counts._Lengths(most=3)
    texts = ["a b c d e f g", "g f e d c b a", "a a a b"]
    for _ in range(3):
        assert small.batch(PATH, texts) == plain(texts)
        assert len(small) <= 3 and len(small.old) <= 3
