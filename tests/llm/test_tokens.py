"""Chunked encoding against the tokenizers library on the whole text."""

import public_tokenizers as vocabularies
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyloom.llm.tokens import library_encoder

TEXTS = [
    "", " ", "\n", "\n\n", " \n", " \nb", "\nb", "a ", "a  ", " a", "a  b", "a\n\nb", "a\n b", "x \n y", "a\r\nb", "\ta b\t",
    "İstanbul ΣΑΣ x", "don't we'll 'S 's I'M", "naïve café café x", "3² xª", "ABC123,45.\nde", "日本 語, x", "a — b—c § d",
    "<|endoftext|> a<|startoftext|>", "ß ẞ ŉ", "a-̀b c", "\U0001f600 x!", "!!\n!!", " 'x' \"y\"", "a _b_ __c",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_odd_texts_equal_the_library(name):
    _compare(name, TEXTS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("aBéß 1.,'\n\t—́ʼs日")), max_size=25), max_size=8))
def test_random_texts_equal_the_library(texts):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        _compare(name, texts)


def _compare(name, texts):
    library = Tokenizer.from_file(vocabularies.path(name))
    library.encode_special_tokens = True
    ids, counts = library_encoder(vocabularies.path(name)).encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at:at + n].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        at += n
    assert at == len(ids)
