"""Texts meant to upset operators, and rows around them."""

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
NOTE = "Write to ann.b@mail.example.com or +1 (988) 555-2485 about card 4111 1111 1111 1111 from 10.0.0.256 and 10.0.0.7 today"
TEXTS = [
    None, "", " \n\t ", "one", "one two", "ONE two", LONG, LONG + " tail", NOTE, NOTE,
    "Released under the MIT License.\nthe and of with", "... 123 !!", "<|endoftext|> don't stop", "naïve Straße 😀 x",
]


def rows(texts):
    return [(i, t, "en" if i % 2 else "fr", f"s{i % 3}" if i % 4 else None, 1, "x", 1, 2, 3, "y") for i, t in enumerate(texts)]
