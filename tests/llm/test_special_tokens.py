"""Packing's ids against tokenizers as the contract calls it, with the special token's string in texts."""

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from triplake.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = st.one_of(st.just("<|endoftext|>"), st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sé1²<|>")), max_size=12))


def contract():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tok.encode(text, add_special_tokens=False).ids


def test_ids_of_texts_that_quote_the_special_token():
    same = settings(max_examples=300, deadline=None)(given(st.lists(PARTS, max_size=6).map("".join))(lambda text: _same(own, text)))
    own = contract()
    assert own("a <|endoftext|> b").count(50256) == 1
    same()


def _same(own, text):
    assert own(text) == packing.encoder(RANKS).encode(text, allowed_special="all")


def test_pieces_count_the_special_token_as_one(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>" * 2050, "<|endoftext", None]
    out = packing.pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), RANKS, with_ids=True).orderBy("doc_id", "piece").collect()
    own = contract()
    got = [[x for r in out if r.doc_id == k for x in r.token_ids] for k in range(len(texts))]
    assert got == [[*own(t or ""), packing.END] for t in texts]
