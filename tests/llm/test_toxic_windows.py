"""Unknown words that are dropped take no window with them."""

from itertools import product

import numpy as np
from tallyframe.llm import toxicity


def windows(numbers):
    padded = [*numbers, *[0] * toxicity.PAD]
    return {tuple(padded[k : k + w]) for k in range(max(1, len(numbers))) for w in toxicity.WIDTHS}


def test_the_same_windows_are_left():
    known = {"a": 1 << 32 | 1, "b": 2 << 32 | 2, "x": 0}
    for n in range(9):
        for words in product("abx", repeat=n):
            left = toxicity.numbers(" ".join(words), known)
            assert windows(left.tolist()) == windows([known[w] for w in words]), words
    assert len(toxicity.numbers("x " * 50, known)) == toxicity.PAD
    assert np.array_equal(toxicity.numbers(None, known), np.zeros(0, np.int64))
