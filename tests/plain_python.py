"""Plain definitions that the Spark text expressions are compared with, one text at a time."""

from __future__ import annotations

import re

from pricelab import constants as C


def share(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def text_stats(text):
    """Counts of characters by kind, and of white-space separated words; a missing text counts as empty."""
    text = text or ""
    words = text.split()
    kinds = {"digit": str.isdigit, "letter": str.isalpha, "upper": lambda c: c.isalpha() and c.isupper(),
             "special": lambda c: not (c.isalnum() or c.isspace())}
    n = {k: len([c for c in text if test(c)]) for k, test in kinds.items()}
    return {"text_length": len(text), "word_count": len(words), "digit_count": n["digit"], "special_char_count": n["special"],
            "uppercase_ratio": share(n["upper"], n["letter"]), "avg_word_length": share(len("".join(words)), len(words))}


def keywords(text):
    """How many of each fixed list occur anywhere in the lower-cased text."""
    found = {}
    for name, words in (("quality", C.QUALITY_KEYWORDS), ("discount", C.DISCOUNT_KEYWORDS)):
        n = len([w for w in words if w in (text or "").lower()])
        found |= {f"has_{name}_keywords": n > 0, f"{name}_keyword_count": n}
    return found


def terms(text, stop=C.ENGLISH_STOP_WORDS):
    """Unigrams then bigrams after lower-casing, accent stripping and stop-word removal."""
    import unicodedata

    s = (text or "").lower()
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    toks = [t for t in re.findall(r"(?u)\b\w\w+\b", s) if t not in set(stop)]
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]
