"""Words whose ids a worker keeps."""

import numpy as np

from meridian.llm import tokens


class Counted:
    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, chars):
        self.asked.append(chars)
        return self.model.tokenize(chars)


def test_what_is_met_again_and_again_is_encoded_once():
    words = tokens.WordTokenizer(tokens.default_path(), max_words=100)
    words.model = Counted(words.model)
    for k in range(500):
        word = "".join(chr(97 + int(d)) for d in str(k + 1000))
        words.encode(f"Alpha, {word} (alpha) ALPHA; {word}ly".encode())
    assert words.model.asked.count("alpha") == 1 and len(words) + len(words.before) <= 100


def test_every_latin_letter_and_mark_has_the_ids_of_the_library():
    words = tokens.WordTokenizer(tokens.default_path())
    letters = [chr(c) for c in range(0x09, 0x180) if c not in range(0x0E, 0x20)]
    texts = [f"{pre}{c}{post}" for c in letters for pre in ("", "a", "Ö'", "7") for post in ("", "b", "'S x", "ll'LL.", "  9")]
    texts += ["a<|endoftext|>b <|startoftext|>", "<|x", "it's 'tis don'T '' 12,5", "straße STRASSE ẞ", "á Å"]
    for t in texts:
        assert np.frombuffer(words.encode(t.encode()), "<u4").tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
