def prose(seed, n, vocabulary=400):
    """n words that follow from the seed."""
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    """Nulls in any column, empty and blank texts, ties, repeated rows, a long text, long runs of one letter."""
    base = prose(1, 200)
    return [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, None, None, None), (4, "", "en", None),
        (5, " \t\n\x0b\f\r ", None, "b"), (None, base, "en", "a"), (None, None, None, None), (6, "one two", "de", "c"),
        (7, "one two", "de", "c"), (8, "é" * 3000, "fr", "b"), (9, "ab" * 4000, "fr", "b"), (10, prose(2, 9000), "en", "a"),
        (11, "x " * 600, "en", "b"), (12, prose(3, 300) + "\n" + base, "de", "c"), (12, prose(4, 50), "de", "c"),
        (13, "a\x1cb c d \x85 e", "es", "b"), (14, "1234 5678 ... !", "es", "b"),
    ]


def planted_rows():
    """Near copies with a few changed words, exact copies, a passage that many texts share, and texts of their own."""
    import random

    rng = random.Random(11)
    rows, shared = [], prose(500, 90)
    for family in range(6):
        base = prose(1000 + family, 160).split()
        for copy in range(rng.choice([2, 5, 12])):
            changed = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 6])):
                changed[rng.randrange(len(changed))] = f"q{rng.randrange(10**6)}"
            rows.append((len(rows) * 3, " ".join(changed), "en", f"s{family}"))
    for own in range(25):
        text = prose(2000 + own, 80) + " " + (shared if own % 2 else "") + " " + prose(3000 + own, 70)
        rows.append((len(rows) * 3, text.upper() if own % 5 == 0 else text, "de", "s"))
    rng.shuffle(rows)
    return rows
