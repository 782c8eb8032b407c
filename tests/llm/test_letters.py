"""Words of ASCII letters go to the tokenizer's model by their own signs; ids are those of the whole text."""

import pytest

from extracteval.llm.tokens import TextEncoder


@pytest.mark.parametrize(("name", "spaces"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_words_of_letters(name, spaces, monkeypatch):
    enc, asked = TextEncoder(name, spaces), []
    letters = enc.letters
    monkeypatch.setattr(enc, "letters", lambda piece: asked.append(piece) or letters(piece))
    for text in ("Thonre was HERE", "thonre", "naïve Ünder été ab", "a" * 60 + " b", "x, Yes. no;", " lead", "tail ", "ab12 c_d"):
        assert enc(text) == enc.whole(text), text
        assert enc(text) == enc.whole(text), text
    assert any(p.strip() == "HERE" for p in asked) and not any("ab12" in p for p in asked)
