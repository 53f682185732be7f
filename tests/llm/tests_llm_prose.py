"""Random prose for the tests of this folder."""

from __future__ import annotations

import random


def prose(rng: random.Random, words: int) -> str:
    parts = ["an", "er", "th", "in", "on", "re", "é", "sch", "ción", "ou", "ti", "ng", "le", "ment", "the", "of", "and"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))
