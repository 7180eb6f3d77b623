"""Variety is judged alike at every length."""

import random

from chalkline.llm import weak_quality as q


def test_a_very_long_clean_text_is_as_varied_as_its_parts():
    rnd = random.Random(3)
    vocab = [f"word{i}" for i in range(3000)]
    words = rnd.choices(vocab, [1 / (i + 10) for i in range(3000)], k=400_000)      # frequencies as in prose
    book, page = q.Measures(" ".join(words)), q.Measures(" ".join(words[:900]))
    assert q._varied(book) == q._varied(page) == q.CLEAN
    assert abs(book.pairs / (book.n - 1) - page.pairs / (page.n - 1)) < 0.05


def test_repetition_shows_in_a_long_text_too():
    assert q._varied(q.Measures("the same few words again " * 40_000)) == q.JUNK


def test_short_texts_count_distinct_pairs():
    w = "a b a b c a b".split()
    assert q.Measures(" ".join(w)).pairs == len(set(zip(w, w[1:])))
