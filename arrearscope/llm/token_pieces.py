"""Token ids of whole texts in tasks, cut into pieces of bounded length."""

from __future__ import annotations

import base64
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa

#: A run of space that overflows the stack of the faster library's pattern matcher by far not yet.
_LONG_SPACE = re.compile(r"\s{2000}")
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit integers.

    The measure is the tokenizer file with ``add_special_tokens=False``. Texts are encoded by a
    faster library over the same vocabulary, given as ranks beside the file; texts with a
    special token's string, which that library doesn't know, or with a very long run of space,
    which it can't match, go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks_path: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_file(path)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        with open(ranks_path or path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.fast = fast.encode_ordinary

    def ids(self, text: str) -> bytes:
        exact = any(s in text for s in self.special) or _LONG_SPACE.search(text)
        found = array("I", self.exact.encode(text, add_special_tokens=False).ids if exact else self.fast(text))
        if found.itemsize != 4 or sys.byteorder != "little":
            return b"".join(i.to_bytes(4, "little") for i in found)
        return found.tobytes()


def cut(total: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` ids: only the first may be shorter than ``most``."""
    if total <= most:
        return [(0, total)]
    first = total % most or most
    return [(0, first), *((start, most) for start in range(first, total, most))]


def piece_batches(path: str, most: int, end_id: int = 0):
    """Function for ``mapInArrow``: (doc_id, row, text) to one row a piece, without the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = None, end_id.to_bytes(4, "little")
        for batch in batches:
            encoder = encoder or Encoder(path)
            out: list[list] = [[] for _ in range(6)]
            for doc_id, row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = encoder.ids(text.as_py()) + end
                view = memoryview(ids)
                for piece, (start, length) in enumerate(cut(len(ids) // 4, most)):
                    crc = zlib.crc32(view[4 * start:4 * (start + length)])
                    for column, value in zip(out, (doc_id, row, piece, start, length, crc)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 2 else pa.int64()) for i, c in enumerate(out)],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"],
            )

    return run
