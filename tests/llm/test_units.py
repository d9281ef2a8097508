"""Ids of pieces against ids of whole texts."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerleaf.llm.tokenise import Encoder, vocabulary

TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'a b.1<>|é漢 "), st.characters(exclude_categories=["Cs"])), max_size=50)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    encoder, whole = Encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))

    @settings(max_examples=400, deadline=None)
    @given(st.lists(TEXT, max_size=6))
    def check(texts):
        want = [np.array(whole.encode(t, add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]
        assert encoder.encode(texts) == want

    check()
