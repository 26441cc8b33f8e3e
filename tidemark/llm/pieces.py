"""SentencePiece encoding and decoding of BPE models with byte fallback, by suffix-array matching.

The distinct new words of a batch are joined into one text and indexed by a suffix array. Every piece of the vocabulary finds its
occurrences as a range of the array by binary search. The occurrences are the edges of a lattice over the text; sorted by
position they are relaxed in the order of BPE: of the edges that join two neighbouring symbols of a word the one of best
score, leftmost among equals, replaces the two.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import ship
from tidemark.llm.textkit import text_slices

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Rank of an edge that no piece makes.
NO_EDGE = np.int64(1 << 40)
#: Separates words in the indexed text; no UTF-8 text holds it.
GAP = 0xFF
#: Bytes of words indexed at once; words kept encoded in one task; characters above which a word is relaxed by a heap.
INDEX_BYTES, KEPT_WORDS, LONG_WORD = 1 << 19, 400_000, 200
#: A word for this purpose: spaces and what follows up to the next space. Line feeds occur in no piece of several characters.
WORDS = re.compile("\n| *[^ \n]+| +")


@dataclass
class Vocabulary:
    """Pieces of a model: their UTF-8 bytes with spaces for marks, scores, and ids of bytes."""

    texts: list[bytes]
    scores: np.ndarray
    usable: np.ndarray
    byte_ids: np.ndarray
    silent: np.ndarray
    name: str

    @staticmethod
    def load(path: str = DEFAULT_MODEL) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(model)
        names = [model.id_to_piece(i) for i in range(n)]
        byte_ids = np.full(256, -1, np.int32)
        for i in range(n):
            if model.is_byte(i):
                byte_ids[int(names[i][3:-1], 16)] = i
        texts = [bytes([int(names[i][3:-1], 16)]) if model.is_byte(i) else names[i].replace(MARK, " ").encode() for i in range(n)]
        usable = np.array([not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)])
        silent = np.array([model.is_control(i) for i in range(n)])
        scores = np.array([model.get_score(i) for i in range(n)])
        vocabulary = Vocabulary(texts, scores, usable, byte_ids, silent, hashlib.sha256(b"\0".join([*texts, scores.tobytes()])).hexdigest())
        if any(b"\n" in t and len(t) > 1 or b" " in t.lstrip(b" ") for t, u in zip(texts, usable, strict=True) if u):
            raise ValueError("a piece crosses words")
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte fallback")
        return vocabulary


def _keys(data: np.ndarray, n: int) -> np.ndarray:
    """Big-endian numbers of the 8 bytes from each of the first n positions; data is padded."""
    out = np.zeros(n, np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | data[j : j + n].astype(np.uint64)
    return out


def _search(values: np.ndarray, low: np.ndarray, high: np.ndarray, target: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each target in its own rising range of values."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        v = values[np.minimum(middle, len(values) - 1)]
        up = open_ & ((v <= target) if right else (v < target))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)
    return low


def suffix_array(keys: list[np.ndarray]) -> np.ndarray:
    """Positions in the order of keys; each further key only sorts the positions that are still tied."""
    order = np.argsort(keys[0])
    group = np.cumsum(np.append(True, np.diff(keys[0][order]) != 0))
    for key in keys[1:]:
        same = group[1:] == group[:-1]
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
        if not len(tied):
            break
        values, at = key[order[tied]], group[tied]
        put = np.lexsort((values, at))
        order[tied], values = order[tied][put], values[put]
        split = np.zeros(len(group), np.int64)
        split[tied[1:]] = (values[1:] != values[:-1]) & (at[1:] == at[:-1])
        group = group + np.cumsum(split)
    return order


#: Of one Python worker: its encoder, by the name of the vocabulary.
_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary) -> Encoder:
    key = vocabulary.value.name
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary.value)
    return _ENCODERS[key]


class _Codes(dict):
    """Numbers words as they are looked up first; new lists those that have no encoding yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.new.append(word)
        return code


class Encoder:
    """Encodes and decodes with one vocabulary; keeps the words of earlier batches, a bounded number."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        ids = np.flatnonzero(vocabulary.usable)
        self.single = {vocabulary.texts[i]: int(i) for i in ids if len(vocabulary.texts[i].decode()) == 1}
        ids = np.array([i for i in ids if len(vocabulary.texts[i].decode()) > 1], np.int64)
        self.ids, self.lengths = ids, np.array([len(vocabulary.texts[i]) for i in ids], np.int64)
        self.width = -(-int(self.lengths.max()) // 8)
        rows = np.zeros((len(ids), self.width * 8), np.uint8)
        tops = np.full((len(ids), self.width * 8), 255, np.uint8)
        for r, i in enumerate(ids):
            rows[r, : self.lengths[r]] = tops[r, : self.lengths[r]] = np.frombuffer(vocabulary.texts[i], np.uint8)
        self.least, self.most = (x.reshape(len(ids), self.width, 8).copy().view(">u8")[:, :, 0].astype(np.uint64) for x in (rows, tops))
        # equal scores are told apart by position alone, so ranks of scores are enough
        self.rank = np.unique(-vocabulary.scores[ids], return_inverse=True)[1].astype(np.int64)
        sizes = np.array([len(t) for t in vocabulary.texts])
        self.piece_bytes, self.piece_at = np.frombuffer(b"".join(vocabulary.texts), np.uint8), np.concatenate([[0], np.cumsum(sizes)])
        self.forget()

    def forget(self) -> None:
        self.code = _Codes()
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def edges(self, data: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of all pieces in the first n bytes: rising keys (position * 256 + length), and rows of the pieces."""
        keys = [_keys(data[8 * k :], n) for k in range(self.width)]
        suffixes = suffix_array(keys)
        low = np.searchsorted(sorted_first := keys[0][suffixes], self.least[:, 0], "left")
        high = np.searchsorted(sorted_first, self.most[:, 0], "right")
        for k in range(1, self.width):
            deep = np.flatnonzero((self.lengths > 8 * k) & (low < high))
            if len(deep):
                values = keys[k][suffixes]
                a, b = low[deep], high[deep]
                low[deep], high[deep] = _search(values, a, b, self.least[deep, k], False), _search(values, a, b, self.most[deep, k], True)
        counts = high - low
        rows = np.repeat(np.arange(len(counts)), counts)
        starts = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        found = suffixes[starts] * 256 + self.lengths[rows]
        order = np.argsort(found, kind="stable")
        return found[order], rows[order]

    def learn(self) -> None:
        """Encodes the new words, in the order of their numbers."""
        words, self.code.new = [w.encode() for w in self.code.new], []
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begin = 0
        while begin < len(words):
            held = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, held + INDEX_BYTES, "right")))
            self._encode(words[begin:end])
            begin = end

    def _encode(self, words: list[bytes]) -> None:
        data = np.frombuffer(bytes([GAP]).join(words) + bytes([GAP]) * (8 * self.width + 1), np.uint8)
        n = len(data) - 8 * self.width
        keys, rows = self.edges(data, n)
        start = np.flatnonzero((data[:n] != GAP) & ((data[:n] & 0xC0) != 0x80))
        word = np.cumsum(data[:n] == GAP)[start]
        after = np.append(start[1:], n)
        end = np.where(data[np.maximum(after - 1, 0)] == GAP, after - 1, after)

        def edge(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rank and row of the edges from a to b; rank NO_EDGE where no piece matches."""
            if not len(keys):
                return np.full(len(a), NO_EDGE), np.zeros(len(a), np.int64)
            length = b - a
            key = a * 256 + np.minimum(length, 255)
            i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = (keys[i] == key) & (length < 256)
            return np.where(hit, self.rank[rows[i]], NO_EDGE), rows[i]

        count = np.bincount(word, minlength=len(words))
        long = np.flatnonzero(count > LONG_WORD)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # word, start, end, row or -1 for a character
        first_of = np.concatenate([[0], np.cumsum(count)])
        for w in long:
            own = slice(first_of[w], first_of[w + 1])
            pairs = self._pairs(start[own], end[own], word[own], edge)
            found = self._heap(start[own], end[own], *pairs, keys, rows)
            done.append((np.full(len(found[0]), w), *found))
        keep = ~np.isin(word, long)
        s, e, w = start[keep], end[keep], word[keep]
        row = np.full(len(s), -1)
        rank, made = self._pairs(s, e, w, edge)
        while len(s):
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(s)))
            over = np.repeat(best == NO_EDGE, sizes)
            if over.any():
                done.append((w[over], s[over], e[over], row[over]))
                s, e, w, row, rank, made = (x[~over] for x in (s, e, w, row, rank, made))
                if not len(s):
                    break
                first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
                best, sizes = best[best != NO_EDGE], np.diff(np.append(first, len(s)))
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            hits = hits[np.append(True, w[hits][1:] != w[hits][:-1])]  # the leftmost of each word
            e[hits], row[hits] = e[hits + 1], made[hits]
            left = np.ones(len(s), bool)
            left[hits + 1] = False
            new = np.cumsum(left)[hits] - 1
            s, e, w, row, rank, made = (x[left] for x in (s, e, w, row, rank, made))
            stale = np.zeros(len(s), bool)
            stale[new] = stale[np.maximum(new - 1, 0)] = True
            redo = np.flatnonzero(stale)
            nxt = np.minimum(redo + 1, len(s) - 1)
            same = (redo + 1 < len(s)) & (w[nxt] == w[redo])
            r, m = edge(s[redo], np.where(same, e[nxt], s[redo] + 255))
            rank[redo], made[redo] = np.where(same, r, NO_EDGE), m
        w, s, e, row = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((s, w))
        self._keep(data, len(words), w[order], s[order], e[order], row[order])

    @staticmethod
    def _pairs(s, e, w, edge):
        """Rank and row of the edge that joins each symbol with the next of its word."""
        if not len(s):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        nxt = np.minimum(np.arange(len(s)) + 1, len(s) - 1)
        same = np.append(w[1:] == w[:-1], False)
        rank, made = edge(s, np.where(same, e[nxt], s + 255))
        return np.where(same, rank, NO_EDGE), made

    def _heap(self, s: np.ndarray, e: np.ndarray, rank: np.ndarray, made: np.ndarray, keys: np.ndarray, rows: np.ndarray):
        """The same for one long word, by a heap of edges instead of rounds. rank and made are those of the edges of neighbours."""
        n, places = len(s), memoryview(keys)
        start, end, row, nxt, prev = s.tolist(), e.tolist(), [-1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, end[i], end[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist()[:-1], made.tolist()[:-1], strict=True)) if r < NO_EDGE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            if not alive[i] or end[i] != a or nxt[i] >= n or end[nxt[i]] != b:
                continue
            gone = nxt[i]
            alive[gone], end[i], row[i], nxt[i] = False, b, m, nxt[gone]
            if nxt[i] < n:
                prev[nxt[i]] = i
            for j in (prev[i], i):
                if j >= 0 and nxt[j] < n and (length := end[nxt[j]] - start[j]) < 256:
                    key = start[j] * 256 + length
                    k = bisect_left(places, key)
                    if k < len(places) and places[k] == key:
                        found = int(rows[k])
                        heapq.heappush(heap, (int(self.rank[found]), j, end[j], end[nxt[j]], found))
        kept = [i for i in range(n) if alive[i]]
        return s[kept], np.array([end[i] for i in kept], np.int64), np.array([row[i] for i in kept], np.int64)

    def _keep(self, data: np.ndarray, n_words: int, w: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray) -> None:
        """Ids of the final symbols; characters outside the vocabulary become their bytes."""
        ids = np.where(row >= 0, self.ids[np.maximum(row, 0)], -1)
        width = np.ones(len(ids), np.int64)
        raw = data.tobytes()
        for i in np.flatnonzero(row < 0):
            found = self.single.get(raw[s[i] : e[i]])
            if found is None:
                width[i] = e[i] - s[i]
            else:
                ids[i] = found
        flat = np.repeat(ids, width)
        at = np.repeat(s - np.concatenate([[0], np.cumsum(width)[:-1]]), width) + np.arange(width.sum())
        flat = np.where(flat < 0, self.v.byte_ids[data[at]], flat)
        sizes = np.bincount(w, weights=width, minlength=n_words).astype(np.int64)
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the offsets of each text in them. A text that isn't empty gets a space in front."""
        split = [WORDS.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        if len(self.code) > KEPT_WORDS:
            self.forget()
        codes = np.fromiter(map(self.code.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        if self.code.new:
            self.learn()
        sizes = self.at[codes + 1] - self.at[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.at[codes] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.flat[at], ends[np.concatenate([[0], np.cumsum([len(x) for x in split], dtype=np.int64)])]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: marks are spaces, the space in front goes, bytes are joined; bytes that aren't UTF-8 become replacement characters."""
        ids = ids[~self.v.silent[ids]]
        sizes = self.piece_at[ids + 1] - self.piece_at[ids]
        at = np.repeat(self.piece_at[ids] - np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64), sizes) + np.arange(sizes.sum())
        text = self.piece_bytes[at].tobytes().decode("utf-8", "replace")
        return text.removeprefix(" ")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch, texts in text_slices(batches):
        yield batch, [t.decode() for t in texts]


def _encoded(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    for batch, texts in _slices(batches):
        ids, at = encoder.encode(texts)
        column = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    for batch in batches:
        texts = [None if x is None else encoder.decode(np.array(x, np.int64)) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])


def _digests(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(vocabulary)
    for batch, texts in _slices(batches):
        ids, at = encoder.encode(texts)
        own = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        same = [encoder.decode(x) == t for x, t in zip(own, texts, strict=True)]
        sha = [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in own]
        columns = [*batch.select([c for c in batch.schema.names if c != "text"]).columns, pa.array(np.diff(at), pa.int64()), pa.array(sha, pa.string()), pa.array(same, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, [*(c for c in batch.schema.names if c != "text"), "n_tokens", "ids_sha256", "round_trip"])


def _mapped(docs: DataFrame, function, model: str, drop: tuple[str, ...], add: str) -> DataFrame:
    ship(docs.sparkSession)
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))  # as large as the model
    schema = T.StructType([*[f for f in docs.schema if f.name not in drop], *T.StructType.fromDDL(add)])
    return docs.mapInArrow(lambda batches: function(batches, vocabulary), schema)


def encode_documents(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """docs with ids (array<int>), the ids of the whole text. Null and empty texts get an empty array; a column ids of docs is
    replaced, other columns stay. Repeated rows stay; an empty table gives an empty result."""
    return _mapped(docs.drop("ids"), _encoded, model, (), "ids array<int>")


def decode_documents(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """encoded (with ids) with decoded, the text of the ids; null ids give null. Texts come back as they were, except that the
    mark U+2581 comes back as a space."""
    return _mapped(encoded.drop("decoded"), _decoded, model, (), "decoded string")


def token_digests(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """docs without text, with n_tokens, ids_sha256 (of the ids as little-endian 32-bit numbers) and round_trip, whether decoding
    the ids gives the text back."""
    docs = docs.drop("n_tokens", "ids_sha256", "round_trip")
    return _mapped(docs, _digests, model, ("text",), "n_tokens long, ids_sha256 string, round_trip boolean")
