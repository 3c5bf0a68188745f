"""Values in a credential's place are found and reported whole."""

import random

from quireline.llm import secrets


def test_long_values_are_reported_whole():
    rng = random.Random(3)
    value = "".join(rng.choice("abcdefghjkmnpqrstuvwxyzABCDEFGHJKMNPQRSTUVWXYZ23456789!%^") for _ in range(700))
    for before, after in (("access_key = ", ""), ("credentials: ", " end"), ("https://bob:", "@h/"), (f"https://{'u' * 90}:", "@h/"), ("redis://:", "@h/")):
        assert (len(before), len(before) + 700, value) in secrets.places(f"{before}{value}{after}") and secrets.guess_cost(value, {}) >= secrets.GUESSES


def test_long_repeats_are_linear_and_cheap():
    assert secrets.guess_cost("ab" * 5000, {}) < secrets.GUESSES
    assert secrets.guess_cost("q7" * 40 + "x9", {}) < secrets.guess_cost("q7x9" + "".join(random.Random(4).choice("abcdef0123456789") for _ in range(78)), {})
