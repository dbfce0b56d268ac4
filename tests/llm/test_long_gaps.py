"""Packing's ids of texts with very long runs, against tokenizers."""

import public_tokenizers
import pytest

from triplake.llm import packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = 1_000_000


@pytest.mark.parametrize(
    "text",
    [
        "a" + " " * LONG + "x",
        " " * LONG,
        "a" + "\n" * LONG + "x y",
        "a\t" + "\t" * LONG + "é" + " " * 2000 + "\nz" + "　" * 3000 + "\n",
        "a" + " " * LONG + "<|endoftext|>" + " " * LONG + "b",
        "x" * 200_000 + " " * LONG + "!",
    ],
    ids=["spaces", "only spaces", "lines", "mixed", "special", "letters"],
)
def test_long_runs(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.token_ids(RANKS, text) == tok.encode(text, add_special_tokens=False).ids
