"""Rows that tests of several operators use."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for what they return or hold meanwhile.
CLASHING = ["size", "shard", "slot", "score", "kept", "removed", "node", "key", "keys", "bucket", "words", "ids", "rate", "target", "copies", "of_id", "toxic", "quality", "digest", "root", "trusted_id"]

AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "de", None, 4),
    (4, "one", None, "b", 3),
    (5, "the cat sat on the mat and the dog ran to the house " * 30, "en", "b", None),
    (6, "the cat sat on the mat and the dog ran to the house " * 30, "en", "b", None),
    (6, "the cat sat on the mat and the dog ran to the house " * 30, "en", "b", None),
    (7, "der hund und die katze sind nicht im haus 漢字 😀 \x00 <|endoftext|> 1d10t", "de", "c", 60),
    (8, "w" * 300_000, "en", "c", 300_000),
    (9, " ".join(f"word{k % 9000}" for k in range(30_000)), "en", "c", 1),
    (None, "a row without an id", "en", "c", 19),
    (None, None, None, None, None),
]


def near_copies(seed, groups, words=60, sizes=(1, 2, 3, 12)):
    """Texts in groups of near copies: words replaced, left out or put in."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 8, 9, 10, 12, 18, 25, 40, 100, 200]))]
        for _ in range(rng.choice(sizes)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at, what = rng.randrange(len(text) + 1), rng.random()
                if what < 0.4:
                    text[at : at + 1] = [rng.choice(vocabulary)]
                elif what < 0.7 and len(text) > 1:
                    del text[at : at + 1]
                else:
                    text.insert(at, rng.choice(vocabulary))
            texts.append(" ".join(text))
    rng.shuffle(texts)
    return texts
