"""Quality rules from a suffix array: how much of a text its own maximal repeated substrings cover, and the longest.

Each text gets the suffix array of its UTF-8 bytes by prefix doubling over the suffixes whose prefix is not yet unique;
the longest common prefix of neighbours is found by descending through the kept ranks. A suffix repeats as far as the
longer common prefix with its two neighbours; those intervals of at least `MIN_REPEAT` bytes are the maximal repeated
substrings, and their union is what repeats.

Cases: a null text has no words; a null doc_id stays null; repeated rows are judged each; an empty table gives no row;
other columns are not read. Memory is a multiple of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import released, text_of

#: Bytes from which a repeated substring counts.
MIN_REPEAT = 64
#: A text is rejected if its repeated substrings cover more than this share of it,
MOST_COVERED = 0.5
#: or if one of them (from LONG_FROM bytes) is longer than this share of it.
MOST_LONGEST = 0.3
LONG_FROM = 512
MIN_WORDS = 50
MOST_REPEAT_WORDS = 50

_SYMBOLS = b"#*$%&|<>"


def _packed(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one big-endian number; past the end there are zeros."""
    n = len(data)
    wide = np.zeros(n + 7, np.uint64)
    wide[:n] = data
    key = wide
    for step in (1, 2, 4):
        m = len(key) - step
        key = (key[:m] << np.uint64(8 * step)) | key[step : step + m]
    return key[:n]


def _groups(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """The first place of each sorted item's group of equals."""
    starts = np.flatnonzero(np.concatenate(([True], differs)))
    return np.repeat(starts, np.diff(np.append(starts, len(order))))


def suffix_lcp(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and the longest common prefix of each suffix with the one before it (0 where under 8 bytes)."""
    n = len(data)
    key = _packed(data)
    order = np.argsort(key)
    ordered = key[order]
    place = _groups(order, ordered[1:] != ordered[:-1])
    # A prefix that ends with the text is not one that goes on with zero bytes: the last seven differ from all others.
    rank = np.empty(n, np.int64)
    rank[order] = place
    tail = np.arange(max(0, n - 7), n)
    levels = [(8, rank)]
    h = 8
    while True:
        same = place[1:] == place[:-1]
        active = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        at = np.flatnonzero(active)
        if not len(at):
            break
        suffix = order[at]
        ahead = suffix + h
        # beyond the end a shorter suffix comes first; each such rank is its own
        after = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1 + len(tail), n - suffix - h)
        after = np.where(ahead < n, after, np.minimum(after, 0))
        sub = np.lexsort((after, place[at]))
        suffix, after, group = suffix[sub], after[sub], place[at][sub]
        differs = (group[1:] != group[:-1]) | (after[1:] != after[:-1])
        starts = np.concatenate(([True], differs))
        fresh = np.repeat(at[starts], np.diff(np.append(np.flatnonzero(starts), len(at))))
        order[at], place = suffix, place.copy()
        place[at] = fresh
        rank = rank.copy()
        rank[suffix] = fresh
        h *= 2
        levels.append((h, rank))
    lcp = np.zeros(n, np.int64)
    a, b = order[1:].copy(), order[:-1].copy()
    live = np.flatnonzero(key[a] == key[b])
    a, b, length = a[live], b[live], np.zeros(len(live), np.int64)
    for h, rank in reversed(levels):
        inside = (a + length < n) & (b + length < n)
        x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
        length += np.where(inside & (rank[x] == rank[y]), h, 0)
    x, y = a + length, b + length
    inside = (x < n) & (y < n)
    diff = np.where(inside, key[np.minimum(x, n - 1)] ^ key[np.minimum(y, n - 1)], np.uint64(1 << 63))
    more = np.zeros(len(diff), np.int64)
    for k in range(1, 8):
        more += diff < np.uint64(1 << (64 - 8 * k))
    lcp[live + 1] = np.minimum(length + more, n - np.maximum(a, b))
    return order, lcp


def repeats(data: np.ndarray, least: int = MIN_REPEAT) -> tuple[int, int]:
    """Bytes that maximal repeated substrings of `least` bytes or more cover, and the length of the longest one."""
    if len(data) <= least:
        return 0, 0
    order, lcp = suffix_lcp(data)
    reach = np.zeros(len(data), np.int64)
    reach[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    starts = np.flatnonzero(reach >= least)
    if not len(starts):
        return 0, 0
    ends = np.maximum.accumulate(starts + reach[starts])
    fresh = np.maximum(starts, np.concatenate(([0], ends[:-1])))
    return int(np.maximum(ends - fresh, 0).sum()), int(reach.max())


def word_counts(data: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    words = data.split()
    ids: dict[bytes, int] = {}
    index = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    repeated = 0
    if len(words) > 3:
        pairs = index[:-1] * len(ids) + index[1:]
        if len(ids) >= 1 << 21:  # so that no number grows past 64 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        triples = pairs[:-1] * len(ids) + index[2:]
        ordered = np.sort(triples)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            found = twice[np.minimum(np.searchsorted(twice, triples), len(twice) - 1)] == triples
            mark = np.zeros(len(words), bool)
            for k in range(3):
                mark[k : k + len(found)] |= found
            repeated = int(mark.sum())
    raw = np.frombuffer(data, np.uint8)
    lines = [x for x in data.split(b"\n") if x.strip()]
    chars = int(np.count_nonzero(((raw & 0xC0) != 0x80) & (raw != 32) & ((raw < 9) | (raw > 13))))
    symbols = sum(data.count(bytes([s])) for s in _SYMBOLS)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


_NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "covered_bytes", "longest_repeat", "base_failed", "kept"]


def _verdict(data: bytes, least: int, most_covered: float, most_longest: float, long_from: int) -> tuple:
    counts = word_counts(data)
    covered, longest = repeats(np.frombuffer(data, np.uint8), least)
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > MOST_REPEAT_WORDS * counts[0]
    bad = covered > most_covered * len(data) or longest > max(long_from, most_longest * len(data))
    return *counts, len(data), covered, longest, failed, not failed and not bad


def judge(docs: DataFrame, least: int = MIN_REPEAT, most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST, long_from: int = LONG_FROM) -> DataFrame:
    """The counts and the verdict of each row of (doc_id, text)."""
    schema = ", ".join(f"{n} {'boolean' if n in ('base_failed', 'kept') else 'long'}" for n in _NAMES)
    types = [pa.bool_() if n in ("base_failed", "kept") else pa.int64() for n in _NAMES]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _NAMES]
            for k, text in zip(batch.column(0), batch.column(1)):
                verdict = _verdict(text.as_py().encode(), least, most_covered, most_longest, long_from)
                for column, value in zip(out, (k.as_py(), *verdict)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], _NAMES)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(rows, schema)


def keep_good(docs: DataFrame, least: int = MIN_REPEAT, most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST, long_from: int = LONG_FROM) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns."""
    at = docs.columns.index("text")

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((t.as_py() or "").encode() for t in batch.column(at))
            yield batch.filter(pa.array([_verdict(t, least, most_covered, most_longest, long_from)[-1] for t in texts], pa.bool_()))

    return docs.mapInArrow(released(good), docs.schema)
