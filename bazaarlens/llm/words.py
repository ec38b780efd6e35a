"""Words of UTF-8 texts, found on their bytes.

Only A-Z are lower-cased, and separators are ASCII, so both are byte tables: no
byte of a multi-byte character is below 0x80.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def byte_table(separates: Callable[[int], bool]) -> bytes:
    """Table for ``bytes.translate``: A-Z lower-cased, separators blank."""
    lowered = bytes(range(256)).lower()
    return bytes(32 if separates(b) else b for b in lowered)


def is_letter(b: int) -> bool:
    """Letters of ASCII and every byte of other characters."""
    return b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A


# Everything but blanks; letters, digits and what lies beyond ASCII; the same without digits.
TOKENS = byte_table(lambda b: b in b" \t\n\x0b\x0c\r")
ALPHANUMERIC = byte_table(lambda b: not (is_letter(b) or 0x30 <= b <= 0x39))
LETTERS = byte_table(lambda b: not is_letter(b))


def byte_words(data: bytes, table: bytes) -> list[bytes]:
    return data.translate(table).split()


def byte_texts(docs: DataFrame, *more) -> DataFrame:
    """``doc_id`` (long), ``data`` (UTF-8 bytes of the text, null becomes empty) and further columns.

    A column of ``docs`` that has one of these names is not carried along.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"), *more)


class Remembered(dict):
    """A function of a word that remembers short words, a bounded number of them."""

    LIMIT, LONGEST = 1 << 19, 64

    def __init__(self, function: Callable[[bytes], int]):
        super().__init__()
        self.function = function

    def __missing__(self, word: bytes):
        value = self.function(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = value
        return value


def runs(words: list[bytes], longest: int) -> Iterator[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by one blank."""
    yield from words
    for n in range(2, longest + 1):
        for i in range(len(words) - n + 1):
            yield b" ".join(words[i:i + n])
