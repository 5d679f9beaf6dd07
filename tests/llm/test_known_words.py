"""Ids of words outlive a task."""

import numpy as np


def test_word_ids_are_kept_from_task_to_task(monkeypatch):
    from tokenizers import Tokenizer

    from gridloom.llm import packing as P
    from gridloom.llm.queries import tokenizer_file

    path = tokenizer_file("word_bpe_49k.json")
    known = P.known_words(path)
    assert P.known_words(path) is known
    monkeypatch.setattr(P, "KEPT_WORDS", 6)  # generations pass within a text
    whole = Tokenizer.from_file(path)
    for text in ("a b c d e f g h a b zz, zz yy", "", "a\nb  c Don't 'tis", "h g f e d c b a", "ünï Σας x1y2 a"):
        ids = np.frombuffer(known.joined(text), np.uint32).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids
    assert len(known.kept) <= 6 + 9
