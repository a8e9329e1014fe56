"""Regex character classes that reproduce Python's ``str`` predicates.

Java's and RE2's ``\\s`` / ``\\d`` differ from Python's Unicode-aware ``str.isspace`` /
``str.isdigit``. The classes below are built by rule from Python's own predicates (over all
code points), so the same class string gives Python semantics in Spark (Java regex) and in
DuckDB (RE2): both accept ``\\x{h..h}`` and ``\\p{..}``.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache


def _ranges(pred) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    start = prev = None
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            ok = False
        else:
            ok = pred(chr(cp))
        if ok:
            if start is None:
                start = cp
            prev = cp
        elif start is not None:
            out.append((start, prev))
            start = None
    if start is not None:
        out.append((start, prev))
    return out


def _class_body(ranges: list[tuple[int, int]]) -> str:
    parts = []
    for a, b in ranges:
        parts.append(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}")
    return "".join(parts)


@lru_cache(maxsize=None)
def ws_body() -> str:
    """Body of a class of the characters Python's ``str.split()`` splits on (``isspace``)."""
    return _class_body(_ranges(str.isspace))


@lru_cache(maxsize=None)
def ws_class() -> str:
    return f"[{ws_body()}]"


@lru_cache(maxsize=None)
def non_ws_class() -> str:
    return f"[^{ws_body()}]"


@lru_cache(maxsize=None)
def digit_class() -> str:
    """Python ``str.isdigit``: decimal digits (``\\p{Nd}``) plus digit-typed extras (superscripts, ...)."""
    extras = _ranges(lambda c: c.isdigit() and unicodedata.category(c) != "Nd")
    return f"[\\p{{Nd}}{_class_body(extras)}]"


# Python str.isalpha == Unicode letters; str.isalnum adds numerics; isupper on a letter == Lu.
ALPHA_CLASS = r"\p{L}"
UPPER_CLASS = r"\p{Lu}"


@lru_cache(maxsize=None)
def alnum_or_ws_class() -> str:
    return f"[\\p{{L}}\\p{{N}}{ws_body()}]"


@lru_cache(maxsize=None)
def decimal_digit_map() -> tuple[str, str]:
    """(from, to) strings for ``translate``: every Unicode decimal digit -> its ASCII digit.

    Python's ``float()`` accepts any decimal digit; a SQL cast only ASCII ones.
    """
    src, dst = [], []
    for cp in range(sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF or cp < 128:
            continue
        c = chr(cp)
        if unicodedata.category(c) == "Nd":
            src.append(c)
            dst.append(str(unicodedata.decimal(c)))
    return "".join(src), "".join(dst)


def py_regex_to_portable(pattern: str) -> str:
    """Rewrite ``\\d`` and ``\\s`` of a Python pattern into explicit classes (same meaning)."""
    return pattern.replace(r"\d", r"\p{Nd}").replace(r"\s", ws_class())


def _chars(pred) -> str:
    return "".join(chr(cp) for cp in range(sys.maxunicode + 1) if not 0xD800 <= cp <= 0xDFFF and pred(chr(cp)))


@lru_cache(maxsize=None)
def ws_chars() -> str:
    """Every character Python's ``str.isspace`` accepts (29), for ``translate``."""
    return _chars(str.isspace)


@lru_cache(maxsize=None)
def digit_chars() -> str:
    """Every character Python's ``str.isdigit`` accepts, for ``translate`` (deleting them counts them)."""
    return _chars(str.isdigit)
