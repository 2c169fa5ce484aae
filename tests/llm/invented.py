from __future__ import annotations

import random


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    syllables = "an ber co di el fo gra hi in jo ka lu mi no or pa que ra st tu un ver wi xa yo zel".split()
    out = []
    for i in range(words):
        w = "".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))
        out.append(w + ("." if i % 11 == 10 else "") + ("\n" if i % 23 == 22 else ""))
    return " ".join(out)
