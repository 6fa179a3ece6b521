"""Work done once for a form of a word, not for each occurrence, with the ids of whole texts."""

import numpy as np

from metaloom.llm.packing import WordTokenizer
from metaloom.llm.queries import tokenizer_path

TEXT = b"Zxqvor, zxqvor. (ZXQVOR!) zxqvor?! 'tis it's, it's don't'' caf\xc3\xa9. e\xcc\x81, 12.5, ... -- x' zxqvor,"
SPECIAL = b"a<|endoftext|>, B. <|startoftext|> x<|, zxqvor,"


def test_closing_marks_are_cut_once_a_form(monkeypatch):
    cut, encoded = [], []
    plain, learn = WordTokenizer._parts, WordTokenizer._learn
    monkeypatch.setattr(WordTokenizer, "_parts", staticmethod(lambda word: (cut.append(word), plain(word))[1]))
    monkeypatch.setattr(WordTokenizer, "_learn", lambda self, words: (encoded.extend(words), learn(self, words))[1])
    tokenizer = WordTokenizer(tokenizer_path())
    texts = [TEXT, SPECIAL, b"", TEXT + b" " + TEXT]
    got = [np.frombuffer(x, "<u4").tolist() for x in tokenizer.ids(texts) + tokenizer.ids(texts)]
    assert got == [tokenizer.tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts * 2]
    assert len(cut) == len(set(cut)) and len(encoded) == len(set(encoded))
    assert encoded.count(b"zxqvor") == 1 and b"zxqvor," not in encoded
