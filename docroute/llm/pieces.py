"""SentencePiece encoding and decoding for merge-type vocabularies, by an agenda of adjacent symbol pairs.

A text is normalised as the vocabulary's own rule says (a space becomes the mark, a mark is put before a text that is
not empty) and starts as a chain of single characters. Each pair of neighbours whose joined text is a piece stands in
an agenda ordered by score, the leftmost first among equal ones; the best pair is joined, and the new symbol's two
pairs with its neighbours enter. A character that is no piece becomes its bytes' pieces.

Where no piece has a mark after another character, the chain falls apart before each run of marks: an exact cut into
words, whose ids a worker remembers. The agendas of all short new words of a slice are kept together in one array of
pairs, from which every word takes its best pair at a time; a long word has a heap of its own and is cut wherever no
piece has these two characters side by side. Each slice of an Arrow batch is checked: the library's ids must be the
same, or the job fails. The text is the library's decoding.

Cases: a null text is an empty one and gives the begin and end ids alone, decoded as an empty text; a null doc_id stays
null; repeated rows give repeated results; a long text is cut as above, and one slice of a batch holds it alone; an
empty table gives no row; other columns are not read. Vocabularies of another type, with own normalisation tables, or
with unused or user-defined pieces are refused.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docroute.llm.common import text_of

MARK = "▁"
#: Distinct words whose ids a Python worker keeps; a bound of its memory, not of the words.
CACHED_WORDS = 400_000
#: Words up to this length are encoded together.
SHORT = 64
#: Characters of texts that are encoded and checked together.
SLICE = 1 << 20


class MergeVocabulary:
    """The pieces of a model file, and the encoding by them."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as f:
            model = proto.ModelProto.FromString(f.read())
        kinds, rule, trained = proto.ModelProto.SentencePiece, model.normalizer_spec, model.trainer_spec
        if trained.model_type != proto.TrainerSpec.BPE:
            raise ValueError("not a merge-type vocabulary")
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("a vocabulary with another normalisation")
        if any(p.type in (kinds.UNUSED, kinds.USER_DEFINED) for p in model.pieces):
            raise ValueError("a vocabulary with unused or user-defined pieces")
        self.library = SentencePieceProcessor(model_file=path)
        self.prefix = MARK if rule.add_dummy_prefix else ""
        self.pieces = {p.piece: (-p.score, i) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        bytes_ = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.bytes = bytes_ if trained.byte_fallback else None
        self.unknown, self.begin, self.end = self.library.unk_id(), self.library.bos_id(), self.library.eos_id()
        #: Character pairs that some piece has side by side: only these can ever be joined across.
        self.joins = {pair for p in self.pieces for pair in zip(p, p[1:])}
        apart = not any(b == MARK != a for a, b in self.joins)
        self._word = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if apart else "(?s:.+)")
        self._known: dict[str, bytes] = {}
        self._table()

    def _chain(self, symbols: list[str], out: list[int]) -> None:
        """Add the ids of one stretch of characters to `out`."""
        last, pieces = len(symbols), self.pieces
        agenda = []
        for a in range(last - 1):
            found = pieces.get(symbols[a] + symbols[a + 1])
            if found is not None:
                agenda.append((found[0], a, a + 1, 2))
        heapq.heapify(agenda)
        left, right = list(range(-1, last - 1)), list(range(1, last + 1))
        while agenda:
            _, a, b, size = heapq.heappop(agenda)
            x, y = symbols[a], symbols[b]
            if not x or not y or len(x) + len(y) != size:
                continue  # one of the two was joined with another neighbour meanwhile
            symbols[a], symbols[b] = x, y = x + y, ""
            right[a] = b = right[b]
            if b < last:
                left[b] = a
                y = symbols[b]
                found = pieces.get(x + y)
                if found is not None:
                    heapq.heappush(agenda, (found[0], a, b, size + len(y)))
            b = left[a]
            if b >= 0:
                y = symbols[b]
                found = pieces.get(y + x)
                if found is not None:
                    heapq.heappush(agenda, (found[0], b, a, size + len(y)))
        for s in symbols:
            if s:
                found = pieces.get(s)
                if found is not None:
                    out.append(found[1])
                elif self.bytes is not None:
                    out.extend([self.bytes[x] for x in s.encode()])
                else:
                    out.append(self.unknown)

    def _long(self, word: str) -> bytes:
        out: list[int] = []
        start, joins = 0, self.joins
        for k, pair in enumerate(zip(word, word[1:]), 1):
            if pair not in joins:
                self._chain(list(word[start:k]), out)
                start = k
        self._chain(list(word[start:]), out)
        return struct.pack(f"<{len(out)}I", *out)

    def _table(self) -> None:
        """The pairs of symbols that make a piece, as sorted numbers. A character that is no piece has a number past all."""
        rank = {score: k for k, score in enumerate(sorted({score for score, _ in self.pieces.values()}))}
        base = len(self.library)
        self.symbol = np.arange(0x110000, dtype=np.int64) + base
        for piece, (_, i) in self.pieces.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i

        def number(part: str) -> int:
            return self.pieces[part][1] if part in self.pieces else int(self.symbol[ord(part)]) if len(part) == 1 else -1

        rows = [(number(p[:k]), number(p[k:]), rank[score], i) for p, (score, i) in self.pieces.items() for k in range(1, len(p))]
        rows = sorted((a << 32 | b, r, i) for a, b, r, i in rows if a >= 0 and b >= 0)
        self.pairs, self.ranks, self.made = (np.array(column, np.int64) for column in zip(*rows)) if rows else [np.zeros(1, np.int64)] * 3

    def _short(self, words: list[str]) -> list[bytes]:
        """The ids of many short words: each round joins the best pair of every word that has one."""
        never, size = np.iinfo(np.int64).max, np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.symbol[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        word = np.repeat(np.arange(len(words)), size)

        def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rank and result of the pair that starts at each place."""
            after = np.minimum(at + 1, len(symbol) - 1)
            key = symbol[at] << 32 | symbol[after]
            found = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            ok = (self.pairs[found] == key) & (after > at) & (word[at] == word[after])
            return np.where(ok, self.ranks[found], never), self.made[found]

        rank, made = look(np.arange(len(symbol)))
        done = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(word)))
            open_ = best < never
            if not open_.all():
                done.append((word[~open_], symbol[~open_]))
                word, symbol, rank, made, best = word[open_], symbol[open_], rank[open_], made[open_], best[open_]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.concatenate(([True], word[at[1:]] != word[at[:-1]]))]  # the leftmost of each word
            symbol[at] = made[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            word, symbol, rank, made = word[keep], symbol[keep], rank[keep], made[keep]
            at = at - np.arange(len(at))
            before = at[at > 0] - 1
            at = np.concatenate((at, before[word[before] == word[before + 1]]))
            rank[at], made[at] = look(at)
        word, symbol = (np.concatenate(c) for c in zip(*done)) if done else [np.zeros(0, np.int64)] * 2
        order = np.argsort(word, kind="stable")
        word, symbol = word[order], symbol[order]
        odd = symbol >= len(self.library)
        if odd.any():
            instead = [[self.unknown] if self.bytes is None else [self.bytes[x] for x in chr(s).encode()] for s in (symbol[odd] - len(self.library)).tolist()]
            times = np.ones(len(symbol), np.int64)
            times[odd] = [len(x) for x in instead]
            word, symbol, fill = np.repeat(word, times), np.repeat(symbol, times), np.repeat(odd, times)
            symbol[fill] = [x for ids in instead for x in ids]
        ends = 4 * np.cumsum(np.bincount(word, minlength=len(words)))
        data, ends = symbol.astype("<u4").tobytes(), ends.tolist()
        return [data[s:e] for s, e in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids with begin and end, as little-endian unsigned 32-bit words."""
        cut = [self._word.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        known = self._known
        words = set().union(*cut)
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            new = list(words)
        short = [w for w in new if len(w) <= SHORT]
        known.update(zip(short, self._short(short)))
        known.update((w, self._long(w)) for w in new if len(w) > SHORT)
        begin, end = self.begin.to_bytes(4, "little"), self.end.to_bytes(4, "little")
        return [b"".join((begin, *map(known.__getitem__, c), end)) for c in cut]


_LOADED: dict[str, MergeVocabulary] = {}


def slices(texts: list[str], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of `most` characters together, or one longer text."""
    start = size = 0
    for k, t in enumerate(texts):
        if k > start and size + len(t) > most:
            yield start, k
            start, size = k, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, decoded) of (doc_id, text): the ids as little-endian unsigned 32-bit words, and their decoding."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _LOADED.get(model) or _LOADED.setdefault(model, MergeVocabulary(model))
        for batch in batches:
            chars = pc.utf8_length(batch.column(1)).to_pylist()
            for a, b in slices([range(n) for n in chars]):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                ids = vocabulary.encode(texts)
                theirs = vocabulary.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
                if any(own != np.array(other, "<u4").tobytes() for own, other in zip(ids, theirs)):
                    raise ValueError("ids differ from the library's")
                decoded = vocabulary.library.decode(theirs, num_threads=1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(run, "doc_id long, ids binary, decoded string")
