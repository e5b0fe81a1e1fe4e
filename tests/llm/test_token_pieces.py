import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from pricetrail.llm import encoder, token_files

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_marks_behind_words_need_no_pass_of_the_whole_library():
    made, library, r = encoder.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER), random.Random(2)
    words = ["".join(r.choice("abcdefgé") for _ in range(8)) for _ in range(1000)]
    text = " ".join(w + r.choice(["$$$", "!!", ".###", "&&&", ","]) for w in words)
    asked, whole = [], made._ids
    made._ids = lambda piece: asked.append(piece) or whole(piece)
    assert made.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(asked) <= 5


def test_any_mark_behind_any_word():
    made, library, r = encoder.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER), random.Random(3)
    marks, ends = encoder.MARKS + "'’_", ["", "s", "'s", "t", "1", " ", "　x", "<|endoftext|>"]
    for _ in range(3000):
        text = r.choice(["", " ", "\n"]).join(
            r.choice(["a", "it", "Bé", "\nq", "日本", "x2", ""]) + "".join(r.choice(marks) for _ in range(r.randint(0, 5))) + r.choice(ends)
            + r.choice(["", " "]) for _ in range(r.randint(1, 5))
        )
        assert made.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("n", [token_files.STRETCH - 1, token_files.STRETCH, 3 * token_files.STRETCH + 5])
def test_planes_are_dealt_alike_in_stretches(n):
    order = np.random.default_rng(n).integers(0, 1 << 16, n).astype(np.uint16)
    ones = (order & 64).astype(bool)
    dealt = token_files._dealt(order, ones, int((~ones).sum()))
    assert (dealt == np.concatenate((order[~ones], order[ones]))).all()
    assert (token_files._gathered(dealt & ~np.uint16(64), ones, int((~ones).sum()), 64) == order).all()
