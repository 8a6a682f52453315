"""Words of whole texts: maximal runs of characters other than the six ASCII white-space characters."""

from __future__ import annotations

from collections.abc import Callable

#: Entries a worker keeps; beyond it the table starts anew, so memory does not follow the vocabulary.
CACHE_ENTRIES = 500_000
#: Longer words are computed each time.
CACHED_WORD_BYTES = 64


def words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text; none for null. ``bytes.split`` splits at exactly space and 0x09 to 0x0D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class WordTable(dict):
    """Remembers ``function(word)`` for the words that a worker meets again and again."""

    def __init__(self, function: Callable):
        super().__init__()
        self.function = function

    def __missing__(self, word: bytes):
        value = self.function(word)
        if len(word) <= CACHED_WORD_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = value
        return value
