import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from civica.llm import vocab

ODD = ["", " ", "  a  b ", "a\n\nb", "it's  'tis,'s x's", "été\u00a0x ", "\u00a0 a", "Σ ΑΣ ß İ", "e\u0301 \u0301x", "<|endoftext|> a<|startoftext|>b",
       "\x01 a\x01b \x01", "日本語 テスト", "a\x1cb \x85 c", "12 345,6.7!?", "x " * 50, "\t\r\n", "a_b-c d/e", "\u00d7 \u00f7 \u00aa2\u00b2", "´´ `` ''"]


@pytest.mark.parametrize("name, spaces", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_tokenizers_ids(name, spaces, monkeypatch):
    monkeypatch.setattr(vocab, "CACHE_ENTRIES", 50)  # generations change often
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    encoder = vocab.PieceEncoder(t, spaces)
    rng = random.Random(1)
    chars = "abcXYZ éÉß.,'!0 19\n  -_\u00a0\u0301日Ω\t\x01"
    texts = [*ODD, *("".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(400))]
    for i in range(0, len(texts), 25):
        got = encoder.encode(texts[i: i + 25])
        for text, ids in zip(texts[i: i + 25], got):
            assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
