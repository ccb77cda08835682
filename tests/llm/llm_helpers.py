"""Made-up words for the tests."""

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def number_words(first, count):
    """``count`` different words."""
    return [f"w{LETTERS[n // 676 % 26]}{LETTERS[n // 26 % 26]}{LETTERS[n % 26]}" for n in range(first, first + count)]
