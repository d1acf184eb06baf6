"""Packing by power-of-two decomposition: every document becomes pieces of binary length, equal lengths share a bucket.

A document of n tokens gives n // max_len pieces of `max_len`, then one piece for each bit set in the rest, longest
first. A piece is a sequence of its own: a power of two needs no padding and no sequence holds two documents. Sequences
of one bucket have one shape, so a trainer draws each batch from one bucket.

Cases: a null text is an empty one, and gives the end token alone; a null doc_id stays null; repeated rows are packed
as often as they occur; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import released, text_of

MAX_LEN = 1024
#: Distinct chunks of text whose ids a Python worker keeps.
CACHED_CHUNKS = 400_000

# With ASCII spaces only, the tokenizer's own pieces never cross these chunks: one starts at a space before a word, or
# at a run of spaces less the last one. Other white space can join such a run, so those texts are encoded whole.
_CHUNK = re.compile(r" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]")
_OTHER = [*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
_OTHER_SPACE = re.compile(f"[{''.join(map(chr, _OTHER))}]")


# The split that a byte-level tokenizer makes, and the printable bytes that stand for themselves in its file.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Below this all Unicode versions agree on what a letter is.
_LATIN_END = chr(0x250)


def _fast(vocabulary: dict[str, int]) -> Callable[[list[str]], list[bytes]]:
    """The same ids by another library, far faster on new words; the file's ids are its merges' ranks.

    The chunks, each a space and a word, are encoded as one text, whose tokens are then dealt out by their bytes.
    """
    import numpy as np
    import tiktoken

    others = [b for b in range(256) if b not in _PRINTABLE]
    byte = {chr(b): b for b in _PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}
    ranks = {bytes(map(byte.__getitem__, piece)): i for piece, i in vocabulary.items() if all(c in byte for c in piece)}
    encoding = tiktoken.Encoding("pieces", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    size[list(ranks.values())] = [len(piece) for piece in ranks]

    def encode(chunks: list[str]) -> list[bytes]:
        if not chunks:
            return []
        ids = encoding.encode_to_numpy("".join(chunks), disallowed_special=())
        ends = np.searchsorted(np.cumsum(size[ids]), np.cumsum([len(c.encode()) for c in chunks])) * 4 + 4
        data, ends = ids.astype("<u4").tobytes(), ends.tolist()
        return [data[s:e] for s, e in zip([0, *ends], ends)]

    return encode


def encoder(path: str) -> Callable[[str], bytes]:
    """Text to its ids as little-endian 32-bit words, remembering the ids of frequent chunks."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import numpy as np
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    fast, known = _fast(tok.get_vocab(with_added_tokens=False)), {}

    def whole(text: str) -> bytes:
        return np.asarray(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(text: str) -> bytes:
        if _OTHER_SPACE.search(text):
            return whole(text)
        chunks = _CHUNK.findall(text)
        new = [c for c in set(chunks) if c not in known]
        if len(known) + len(new) > CACHED_CHUNKS:
            known.clear()
            new = list(set(chunks))
        words = [c for c in new if c[0] == " " < c[1:2] and max(c) < _LATIN_END]
        known.update(zip(words, fast(words)))
        known.update((c, whole(c)) for c in new if c not in known)
        return b"".join(map(known.__getitem__, chunks))

    return encode


_ENCODERS: dict[str, Callable[[str], bytes]] = {}


def lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """The binary lengths that `n` tokens are cut into."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, max_len: int = MAX_LEN, with_ids: bool = False, end: int = 0) -> DataFrame:
    """Pieces of (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, bucket, sequence_id, offset.

    `max_len` is a power of two. `bucket` is the length's binary logarithm. `with_ids` adds the ids (little-endian
    unsigned 32-bit). A sequence's number is unique; it is the task's number and a count, as the rows never move.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    types = [pa.int64()] * 5 + [pa.binary()] * with_ids
    last = end.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _ENCODERS.get(tokenizer) or _ENCODERS.setdefault(tokenizer, encoder(tokenizer))
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            size = 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, data = doc_id.as_py(), encode(text.as_py()) + last
                at, n = 0, len(data) // 4
                for k in lengths(n, max_len):
                    ids = data[4 * at : 4 * (at + k)]
                    for column, value in zip(rows, (doc_id, at, k, zlib.crc32(ids), n, ids)):
                        column.append(value)
                    at += k
                size += len(data) if with_ids else 0
                if len(rows[0]) > 20_000 or size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)
                    rows, size = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)

    pieces = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(released(cut), schema)
    return pieces.select(
        "*",
        F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder of sequences for each length."""
    pieces.write.partitionBy("bucket").parquet(path)
