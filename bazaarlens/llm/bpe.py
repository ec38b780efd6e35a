"""Byte-level BPE over Arrow batches with the tokenizers library.

Texts are split whole by the vocabulary's pattern. A byte-level vocabulary spells
each byte as one printable character; each piece is spelled so and handed to the
library's BPE model, whose result is remembered for up to ``REMEMBERED`` pieces.
Decoding maps the characters of the tokens back through the table, so that a
code point whose bytes lie in several tokens is put together again. Offsets are
positions in the text, from the characters of the pieces; tokens that share a
code point overlap there.

Null and empty texts have no token and decode to the empty string. A row
without an id is encoded like others, repeated rows alike. Strings that spell
special tokens are ordinary text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_texts

VOCABULARY = "byte_bpe_50k.json"
REMEMBERED = 1 << 18


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others, in order, are the code
    points from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = sorted(set(range(256)) - set(printable))
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.split = regex.compile(public_tokenizers.PATTERN).findall
        tokenizer = Tokenizer.from_file(path)
        self.model = tokenizer.model
        byte = byte_characters()
        self.spelling = {b: c for c, b in byte.items()}
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in byte for c in token):
                self.bytes_of[i] = bytes(byte[c] for c in token)
        self.number = [str(i) for i in range(len(self.bytes_of))]
        self.known: dict[str, tuple[int, ...]] = {}

    def piece(self, piece: str) -> tuple[int, ...]:
        """The ids of one match of the pattern."""
        ids = self.known.get(piece)
        if ids is None:
            spelled = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.spelling)
            ids = tuple(t.id for t in self.model.tokenize(spelled))
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.piece, self.split(text))))

    def offsets(self, text: str) -> tuple[list[int], list[int]]:
        """First and last-but-one character of every token."""
        starts, ends, at = [], [], 0
        for piece in self.split(text):
            # The character that each byte of the piece belongs to.
            owner = [at + k for k, c in enumerate(piece) for _ in c.encode("utf-8", "surrogatepass")]
            byte = 0
            for i in self.piece(piece):
                starts.append(owner[byte])
                byte += len(self.bytes_of[i])
                ends.append(owner[byte - 1] + 1)
            at += len(piece)
        return starts, ends

    def written(self, ids: list[int]) -> str:
        """The ids in decimal, joined by blanks."""
        return " ".join(map(self.number.__getitem__, ids))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@cache
def codec(path: str) -> Codec:
    """One per Python worker and file."""
    return Codec(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids, starts and ends (character offsets) of every row."""
    path = path or vocabulary_path()

    def run(batches):
        own = codec(path)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                starts, ends = own.offsets(text)
                columns = {"ids": own.encode(text), "starts": starts, "ends": ends}
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array([doc_id], pa.int64()), **{k: pa.array([v], pa.list_(pa.int32())) for k, v in columns.items()}})

    return doc_texts(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the decoded bytes of ``ids``."""
    path = path or vocabulary_path()

    def run(batches):
        for batch in batches:
            data = [codec(path).decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token count, hash of the ids and hash of the decoded bytes of every row."""
    path = path or vocabulary_path()

    def run(batches):
        own = codec(path)
        for batch in batches:
            counts, ids_hash, data_hash = [], [], []
            for text in batch.column("text").to_pylist():
                ids = own.encode(text)
                counts.append(len(ids))
                ids_hash.append(hashlib.sha256(own.written(ids).encode()).hexdigest())
                data_hash.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(data_hash)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return doc_texts(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
