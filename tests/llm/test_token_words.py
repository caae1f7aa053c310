"""Words of Latin-1 letters take the short way to the library's model; their ids are those of the whole library."""

import random

from public_tokenizers import path
from tokenizers import Tokenizer

from lakesmith.llm import token_files


def test_latin_words_are_encoded_as_by_the_library(monkeypatch):
    letters = [chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)]]  # with the signs of multiplication and division
    rng = random.Random(3)
    words = [a + b for a in letters for b in letters] + ["".join(rng.choices(letters, k=rng.randint(1, 25))) for _ in range(3000)]
    words += ["ªº", "µm", "é", "İ", "İ", "é́", "a1é", "l'ÉtÉ", "Ã©", "Łódź"]
    file = path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(file), token_files.WordEncoder(file)
    calls = []
    monkeypatch.setattr(own, "library", type("Counted", (), {"encode": lambda s, w, **k: calls.append(w) or library.encode(w, **k)})())
    monkeypatch.setattr(token_files, "MOST_REMEMBERED", 500)
    for at in range(0, len(words), 400):  # words are forgotten, and met again
        part = words[max(0, at - 300) : at + 400]
        want = [library.encode(w, add_special_tokens=False).ids + [2] for w in part]
        assert [list(memoryview(x).cast("I")) for x in own.encode([w.encode() for w in part], 2)] == want
    assert calls and not [w for w in calls if all("a" <= c <= "z" or ("À" <= c <= "ÿ" and c not in "×÷") for c in w)]
