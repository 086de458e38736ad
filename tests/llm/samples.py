"""Random documents with exact and near copies and shared passages."""

from __future__ import annotations

import random


def vocabulary(rng: random.Random, size: int) -> list[str]:
    return ["".join(rng.choice("abcdeäß") for _ in range(rng.randint(1, 6))) for _ in range(size)]


def corpus(seed: int, count: int = 150, words: int = 400) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    known = vocabulary(rng, words)
    passages = [[rng.choice(known) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    rows: list[list[str]] = []
    for _ in range(count):
        kind = rng.random()
        if kind < 0.35 and rows:
            text = list(rng.choice(rows))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5, 12])):
                at = rng.randrange(len(text) + 1)
                text[at : at + rng.randint(0, 2)] = [rng.choice(known) for _ in range(rng.randint(0, 2))]
        else:
            text = [rng.choice(known) for _ in range(rng.choice([0, 1, 2, 3, 4, 12, 13, 14, 30, 80, 200]))]
            if kind > 0.7:
                at = rng.randrange(len(text) + 1)
                text[at:at] = rng.choice(passages)
        rows.append(text)
    order = list(range(count))
    rng.shuffle(order)
    blanks = [" ", "  ", "\n", "\t"]
    return [
        (i * 3 + 1, "".join(word.title() + rng.choice(blanks) if rng.random() < 0.1 else word + " " for word in text))
        for i, text in zip(order, rows, strict=True)
    ]
