"""Packing by power-of-two decomposition.

A document of n tokens becomes n // 2048 full pieces and one piece for every
binary digit of the rest, longest first. Every piece is a sequence of its own,
so no sequence crosses documents and none needs padding; ``length`` is the
bucket in which equal lengths are batched.

Nothing is shuffled: pieces leave the task that tokenised the document.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped

#: Words, and as many pieces of chunks, that a task memorises (about 20 MB of words).
MEMO = 150_000
#: Characters of the documents that are text and ids in Python at a time (a longer document stands alone).
SLICE = 1 << 20

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: The characters of an ordinary text: printable ASCII, line ends, and the letters of Latin-1.
_ORDINARY = bytes(b for b in range(256) if b == 10 or 32 <= b < 127 or b >= 0xC0 and b not in (0xD7, 0xF7))
#: The vocabulary's public split pattern, over these characters.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it prints, else one above 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Words:
    """Ids of the split pattern's pieces, and of words after a space. It knows no memo, so memos of it free at once."""

    def __init__(self, model):
        self._model = model
        self._letters = _byte_letters()

    def piece(self, piece: str) -> bytes:
        tokens = self._model.tokenize(piece.encode().decode("latin-1").translate(self._letters))
        return array("I", [t.id for t in tokens]).tobytes()

    def word(self, word: str) -> bytes:
        return self.piece(" " + word)


class _Memo(dict):
    """Remembers up to MEMO results of a function; others are computed again."""

    def __init__(self, of):
        super().__init__()
        self._of = of

    def __missing__(self, key):
        value = self._of(key)
        if len(self) < MEMO:
            self[key] = value
        return value


class Encoder:
    """Token ids as little-endian unsigned 32-bit integers.

    In an ordinary text (Latin letters, single spaces and line ends) the
    tokenizer's splits fall before every space and line end, so the text's ids
    are those of its chunks in turn. Arrow finds the distinct chunks of many
    texts, each is encoded once, and the ids are laid out by number. Any other
    text is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        words = _Words(self._whole.model)
        # Memos of an own method would hold the encoder, and it them, until Python next looks for cycles:
        # a worker would keep the memos of several tasks.
        self._pieces = _Memo(words.piece)
        self._chunks = _Memo(words.word)

    def _ids(self, text: str) -> bytes:
        return array("I", self._whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        # Most chunks are a word, or a word and a mark: the split pattern leaves both whole.
        if chunk.isalpha():
            return self._chunks[chunk]
        word, last = chunk[:-1], chunk[-1:]
        if word.isalpha() and not last.isalnum():
            return self._chunks[word] + self._pieces[last]
        text = chunk if chunk[:1] == "\n" else " " + chunk
        return b"".join(map(self._pieces.__getitem__, _SPLIT.findall(text)))

    @staticmethod
    def ordinary(text: str) -> bool:
        try:
            if text.encode("latin-1").translate(None, _ORDINARY):
                return False
        except UnicodeEncodeError:
            return False
        return not (text[0] == " " or text[-1] in " \n" or "<|" in text or "  " in text or "\n\n" in text
                    or " \n" in text or "\n " in text)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one row, and where each text's ids begin (and the last's end)."""
        cut, heads = [], []
        for text in texts:
            plain = bool(text) and self.ordinary(text)
            # A text's first chunk has no space before it: it is no chunk like the others.
            first = re.match(r"[^ \n]*", text)[0] if plain else text
            heads.append(self._ids(first) if first else b"")
            cut.append(text[len(first):].replace("\n", " \n") if plain else "")
        lists = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        starts = lists.offsets.to_numpy()
        chunks = lists.flatten().dictionary_encode()
        of_chunk = chunks.indices.to_numpy().copy()
        distinct = chunks.dictionary.to_numpy(zero_copy_only=False)
        # The empty chunk before a text's first space stands for that text's head.
        of_chunk[starts[:-1]] = np.arange(len(texts)) + len(distinct)
        parts = [self._chunk(c) if c else b"" for c in distinct] + heads
        ids = np.frombuffer(b"".join(parts), dtype="<u4")
        n = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        begin = np.cumsum(n) - n
        each = n[of_chunk]
        ends = np.cumsum(each)
        laid = ids[np.repeat(begin[of_chunk] - (ends - each), each) + np.arange(each.sum())]
        return laid, np.concatenate([[0], ends])[starts]


def lengths(n: int, longest: int) -> list[int]:
    """Binary-length pieces of n tokens, longest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         longest: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces: doc_id, start, length, ids (binary), doc_tokens, sequence_id, offset.

    A document's tokens are those of its text and ``end_id``; a null or empty
    text gives one piece of length 1. Each row is a document of its own, ids
    may be null or repeat. ``sequence_id`` is unique, not dense. ``longest``
    is a power of two. Other columns of the input are not read.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    id_type = docs.schema[id_col].dataType.simpleString()

    def pieces_of(docs: pa.Array, texts: pa.Array, code: Encoder) -> pa.RecordBatch:
        ids, at = code.encode_all([x or "" for x in texts.to_pylist()])
        tokens = np.diff(at) + 1
        ids = np.insert(ids, at[1:], end_id)
        pieces = [lengths(n, longest) for n in tokens.tolist()]
        row = np.repeat(np.arange(len(docs)), [len(p) for p in pieces])
        length = np.fromiter(chain.from_iterable(pieces), np.int64, len(row))
        ends = np.cumsum(length)
        offsets = np.concatenate([[0], ends])
        start = offsets[:-1] - (np.cumsum(tokens) - tokens)[row]
        of_piece = pa.Array.from_buffers(pa.large_binary(), len(row), [
            None, pa.py_buffer(4 * offsets), pa.py_buffer(ids.astype("<u4", copy=False))])
        return pa.RecordBatch.from_arrays([
            docs.take(pa.array(row)), pa.array(start), pa.array(length),
            of_piece.cast(pa.binary()), pa.array(tokens[row])], schema=schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Encoder(tokenizer)  # goes with the task: its worker stays for later stages
        for batch in batches:
            docs, texts = batch.columns
            size = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(size, (size[low - 1] if low else 0) + SLICE, "right")))
                yield pieces_of(docs.slice(low, high - low), texts.slice(low, high - low), code)
                low = high
            del batch, docs, texts, size
            pa.default_memory_pool().release_unused()

    schema = pa.schema([("doc_id", pa.string()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids", pa.binary()), ("doc_tokens", pa.int64())])
    # An id as text keeps nulls and all 64 bits through pandas.
    pieces = shipped(docs).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        cut, "doc_id string, start long, length long, ids binary, doc_tokens long")
    return pieces.select(
        F.col("doc_id").cast(id_type).alias("doc_id"), "start", "length", "ids", "doc_tokens",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder for each length, from which batches of equal length are read."""
    pieces.write.partitionBy("length").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
