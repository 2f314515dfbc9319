import random

import tokenizers

from catalogflow.llm import token_automaton
from tests.llm.conftest import ODD_ROWS, strange_texts


def library_counts(path, texts):
    library = tokenizers.Tokenizer.from_file(path)
    return [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_counts_equal_the_library(vocabulary, sample):
    path = vocabulary("word_bpe_49k.json")
    r = random.Random(1)
    # Words longer than a chunk: the state maps of whole chunks are composed.
    long_words = ["".join(r.choices("abcdefghij", k=n)) for n in (1023, 1024, 1025, 5000)]
    texts = strange_texts() + long_words + [r.text for r in sample.limit(60).collect()]
    assert token_automaton.transducer(path).counts(texts).tolist() == library_counts(path, texts)


def test_code_points_are_classed_as_in_the_library(vocabulary):
    """Alone and beside a letter, a sign and a digit; new code points and unassigned ones too."""
    path = vocabulary("word_bpe_49k.json")
    machine, library = token_automaton.transducer(path), tokenizers.Tokenizer.from_file(path)
    r = random.Random(2)
    points = [*range(0x20, 0x700), *range(0x1E00, 0x2200), *range(0xA700, 0xA800), 0x18E24, 0x10FFFF]
    points += r.sample([*range(0xD800), *range(0xE000, 0x110000)], 6000)
    for before, after in (("", ""), ("a", ""), ("", "z"), ("3", "4"), ("!", "b"), ("Zw", ""), ("\u3010 ", "")):
        texts = [before + chr(c) + after for c in points]
        want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
        assert machine.counts(texts).tolist() == want


def test_a_full_table_starts_anew(vocabulary, monkeypatch):
    path = vocabulary("word_bpe_49k.json")
    machine = token_automaton.Transducer(path)
    monkeypatch.setattr(token_automaton, "MAX_CELLS", 1)
    texts = strange_texts(40)
    for text, want in zip(texts, library_counts(path, texts)):
        assert machine.counts([text]).tolist() == [want]


def test_odd_rows(vocabulary, odd, empty):
    path = vocabulary("word_bpe_49k.json")
    found = token_automaton.token_counts(odd, path, limit=2048).collect()
    want = library_counts(path, [t or "" for _, t in ODD_ROWS])
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in found)
    assert got == sorted(
        (i or 0, len((t or "").encode()), n, n > 2048) for (i, t), n in zip(ODD_ROWS, want)
    )
    assert token_automaton.token_counts(empty, path, limit=1).count() == 0
