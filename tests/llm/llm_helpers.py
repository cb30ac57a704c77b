"""Made-up texts for small fixtures."""

import random


def repeat_words(n, seed=0, vocabulary=("the", "of", "añb", "en", "er", "ti", "on", "Tha", "x1")):
    r = random.Random(seed)
    return " ".join(r.choice(vocabulary) for _ in range(n))
