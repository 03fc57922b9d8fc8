"""Vocabulary files, and cutting texts where no token can cross."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

#: Characters after which a long text is cut at the next safe place.
LONG_TEXT = 100_000


def vocabulary_path(name: str) -> str:
    """``name`` itself if it is a file, else the public vocabulary of that name, on this machine."""
    if os.path.isfile(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _boundary():
    """Places no match of the byte-level pattern crosses.

    A match holds white space only at its start, so one ends before white space that
    follows anything else; and runs of letters and runs of digits end where the class ends. Only
    white space that every engine counts as such is used.
    """
    import regex

    return regex.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=\p{L})(?=[^\p{L}\p{M}])|(?<=\p{N})(?=[^\p{N}\p{M}])")


def safe_pieces(text: str, limit: int = LONG_TEXT) -> Iterator[str]:
    """``text`` in pieces of about ``limit`` characters that can be split into words one by one.

    A stretch without a safe place stays whole, however long.
    """
    start = 0
    while len(text) - start > limit:
        found = _boundary().search(text, start + limit)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


_SPACE_BEFORE_WORD = re.compile(r" (?=\S)")
#: Leads a word that no space stands before.
GLUED = "\0"
#: What a plain split would cut wrongly: runs of white space, and a point or comma that starts a word or a run.
_RUNS = ("  ", " \n", "\n ", "\n\n", " ,", " .", "\n,", "\n.", ",,", "..", ",.", ".,")


def _even(text: str) -> bool:
    """Whether ``text`` is letters and digits with single spaces, line breaks, points and commas between them."""
    bare = text.replace(" ", "").replace(",", "").replace(".", "").replace("\n", "")
    return bare.isalnum() and not any(run in text for run in _RUNS) and text[0] not in ".," and text[-1] not in " \n"


def words_of(text: str) -> tuple[str, list[str]]:
    """``(first, rest)``: ``text`` cut where no token of a byte-level vocabulary crosses.

    A word of ``rest`` that starts with GLUED follows directly; a space stands before every other, and is left
    out. Equal words so have equal tokens wherever they stand. Even texts are cut before spaces, points and commas
    and around line breaks; others only at spaces that lead a word.
    """
    marked = even_words(text)
    if marked is not None:
        first, *rest = marked.split(" ")
        return first, rest
    first, *rest = _SPACE_BEFORE_WORD.split(text)
    return first, rest if GLUED not in text else [GLUED + " " + w if w.startswith(GLUED) else w for w in rest]


def even_words(text: str) -> str | None:
    """The words of an even text with one space between them, else None."""
    if not _even(text):
        return None
    return text.replace(",", " \0,").replace(".", " \0.").replace("\n", " \0\n \0")


def spelled(word: str) -> str:
    """A word of ``rest`` as it stands in the text."""
    return word[1:] if word.startswith(GLUED) else " " + word
