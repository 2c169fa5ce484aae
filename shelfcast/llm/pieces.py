"""SentencePiece encoding and decoding by batched Viterbi.

A text's pieces are the segmentation with the highest sum of the model's piece scores. No piece of the model has a blank mark
after another character, so a text falls apart before each run of blanks into words that can be segmented alone. The distinct
words of a batch are put into groups of equal length, and the words of a group advance together, one character a step: the
hashes of all substrings that end there are looked up in the sorted hashes of the pieces, and a vectorised maximum keeps the
best score and its start. Characters that no piece covers become their UTF-8 bytes.

Of equal sums the longer last piece wins, so results do not depend on the batch. Decoding puts the pieces together again and
gives the text back exactly, for every text.

Defined results: null stays null, an empty text has no pieces; control pieces are never produced, and their spelling in a text
is ordinary text; texts are read whole, and words longer than ``LONG`` go through a loop of their own; equal rows get
equal pieces; an empty table stays empty.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.store import arrow_rows
from shelfcast.llm.text import mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG, GROUP = 64, 4096
REMEMBERED = 600_000
BYTE_SCORE = -1e6  # for each byte of a character that no piece covers; below any sum of pieces in a word
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64((1 << 20) - 1)


class Pieces:
    """The piece table of a model file: sorted substring hashes with id and score, and the bytes of each id."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.spelled: list[bytes] = []
        self.byte_id = np.zeros(256, np.int32)
        usable: list[tuple[str, int, float]] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                self.spelled.append(piece.replace(MARK, " ").encode())
                score = model.get_score(i)
                usable.append((piece.replace(MARK, " "), i, score if score > -1e8 else -1e5))
        assert not any(" " in p.lstrip(" ") for p, _, _ in usable), "a piece goes on after a blank"
        keys = np.array([self.key(p) for p, _, _ in usable], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        assert (self.keys[1:] != self.keys[:-1]).all(), "two pieces have one hash"
        self.ids = np.array([i for _, i, _ in usable], np.int32)[order]
        self.scores = np.array([s for _, _, s in usable])[order]
        self.seen = np.zeros(int(_LOW) + 1, bool)
        self.seen[self.keys & _LOW] = True
        self.ends = np.cumsum([len(s) for s in self.spelled])
        self.flat = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.longest = max(len(p) for p, _, _ in usable)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def key(piece: str) -> np.uint64:
        h = np.zeros(1, np.uint64)
        for code in piece:
            h = (h + np.uint64(ord(code) + 1)) * _STEP
        return mix(h + np.uint64(len(piece)))[0]

    def _lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of each substring hash. Most are no piece and drop out at a table of the hashes' low bits."""
        scores, ids = np.full(keys.shape, -np.inf), np.full(keys.shape, -1, np.int32)
        maybe = self.seen[keys & _LOW]
        probed = keys[maybe]
        at = np.minimum(np.searchsorted(self.keys, probed), len(self.keys) - 1)
        hit = self.keys[at] == probed
        scores[maybe], ids[maybe] = np.where(hit, self.scores[at], -np.inf), np.where(hit, self.ids[at], -1)
        return scores, ids

    def _fallback(self, codes: np.ndarray) -> np.ndarray:
        return np.where(codes < 0x80, 1, np.where(codes < 0x800, 2, np.where(codes < 0x10000, 3, 4))) * BYTE_SCORE

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For words of equal length, one a row: the piece that ends at each place of the best way there, and its length.

        A piece of -1 stands for the bytes of one character.
        """
        n, length = codes.shape
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0.0
        piece, width = np.full((n, length + 1), -1, np.int32), np.ones((n, length + 1), np.int32)
        rolling = np.zeros((n, min(length, self.longest)), np.uint64)  # by start, the latest ``longest`` ones
        slots = rolling.shape[1]
        for end in range(1, length + 1):
            code = codes[:, end - 1].astype(np.uint64) + np.uint64(1)
            rolling[:, (end - 1) % slots] = 0
            lengths = np.arange(1, min(end, slots) + 1)
            used = (end - lengths) % slots
            rolling[:, used] = (rolling[:, used] + code[:, None]) * _STEP
            score, ids = self._lookup(mix(rolling[:, used] + lengths.astype(np.uint64)))
            total = best[:, end - lengths] + score
            pick = total.shape[1] - 1 - total[:, ::-1].argmax(1)
            rows = np.arange(n)
            bytewise = best[:, end - 1] + self._fallback(codes[:, end - 1])
            better = total[rows, pick] >= bytewise
            best[:, end] = np.where(better, total[rows, pick], bytewise)
            piece[:, end] = np.where(better, ids[rows, pick], -1)
            width[:, end] = np.where(better, lengths[pick], 1)
        return piece, width

    def viterbi_long(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long word: all its substrings are looked up at once, then one pass over the places."""
        length = len(codes)
        scores, ids = np.full((length, self.longest), -np.inf), np.full((length, self.longest), -1, np.int32)
        rolling = np.zeros(length, np.uint64)
        for size in range(1, min(self.longest, length) + 1):
            ends = np.arange(size - 1, length)
            rolling = (rolling[: length - size + 1] + codes[ends].astype(np.uint64) + np.uint64(1)) * _STEP
            scores[ends, size - 1], ids[ends, size - 1] = self._lookup(mix(rolling + np.uint64(size)))
        bytewise = self._fallback(codes).tolist()
        best, piece, width = [0.0] * (length + 1), np.full(length + 1, -1, np.int32), np.ones(length + 1, np.int32)
        for end in range(1, length + 1):
            row = scores[end - 1]
            best[end], pick = best[end - 1] + bytewise[end - 1], -1
            for k in np.flatnonzero(row > -np.inf).tolist():
                total = best[end - 1 - k] + row[k]
                if total >= best[end]:
                    best[end], pick = total, k
            if pick >= 0:
                piece[end], width[end] = ids[end - 1, pick], pick + 1
        return piece, width

    def _learn(self, words: list[str]) -> None:
        """Put the segmentation of new words into ``known``."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for length, group in by_length.items():
            if length > LONG:
                for w in group:
                    piece, width = self.viterbi_long(_codes(w))
                    self.known[w] = self._traced(piece[None], width[None], [w])[0]
                continue
            for at in range(0, len(group), GROUP):
                some = group[at : at + GROUP]
                codes = _codes("".join(some)).reshape(len(some), length)
                for w, ids in zip(some, self._traced(*self.viterbi(codes), some)):
                    self.known[w] = ids

    def _traced(self, piece: np.ndarray, width: np.ndarray, words: list[str]) -> list[bytes]:
        """Follow the stored starts back, all words together; ids as the bytes of 32-bit numbers."""
        n, at = len(words), np.full(len(words), piece.shape[1] - 1)
        steps, rows = [], np.arange(n)
        while (at > 0).any():
            here = np.where(at > 0, piece[rows, at], -2)
            steps.append((here, at))
            at = np.maximum(0, at - np.where(at > 0, width[rows, at], 0))
        ids = np.stack([s for s, _ in steps[::-1]], 1) if steps else np.empty((n, 0), np.int32)
        real = ids >= 0
        flat = ids[real].astype(np.int32).tobytes()
        cuts = np.concatenate([[0], 4 * np.cumsum(real.sum(1))]).tolist()
        out = [flat[a:b] for a, b in zip(cuts, cuts[1:])]
        bytewise = np.flatnonzero((ids == -1).any(1))
        ends = np.stack([e for _, e in steps[::-1]], 1) if len(bytewise) else None
        for i in bytewise:
            found: list[int] = []
            for number, end in zip(ids[i], ends[i]):
                if number >= 0:
                    found.append(int(number))
                elif number == -1:
                    found += self.byte_id[list(words[i][end - 1].encode("utf-8", "surrogatepass"))].tolist()
            out[i] = np.array(found, np.int32).tobytes()
        return out

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text."""
        split = [None if t is None else words_with_blanks(t) for t in texts]
        new = {w for ws in split if ws for w in ws if w not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = {w for ws in split if ws for w in ws}
        self._learn(list(new))
        found = [b"".join([self.known[w] for w in ws]) if ws else b"" for ws in split]
        ends = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
        values = np.frombuffer(b"".join(found), np.int32)
        for w in new:
            if len(w) > LONG:
                del self.known[w]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values), mask=pa.array([s is None for s in split], pa.bool_()))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list: the pieces' bytes, gathered for all lists at once. Broken UTF-8 is replaced."""
        numbers = ids.flatten().to_numpy()
        sizes = np.diff(self.ends, prepend=0)[numbers]
        total = np.concatenate([[0], np.cumsum(sizes)])
        data = self.flat[np.arange(total[-1]) + np.repeat(self.ends[numbers] - total[1:], sizes)]
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        bounds = total[np.concatenate([[0], np.cumsum(counts)])]
        raw = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        raw = pc.if_else(ids.is_valid(), raw, pa.scalar(None, pa.large_binary()))
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([None if b is None else b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def words_with_blanks(text: str) -> list[str]:
    """The text cut before each run of blanks."""
    parts = text.split(" ")
    if "" not in parts[1:]:
        return ([parts[0]] if parts[0] else []) + [" " + p for p in parts[1:]]
    words, blanks = [], ""
    for i, p in enumerate(parts):
        blanks += " " if i else ""
        if p:
            words.append(blanks + p)
            blanks = ""
    return words + ([blanks] if blanks else [])


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def encode_texts(docs: DataFrame, *, model: str = MODEL, to: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of ``text`` as an array. ``model`` must be readable on the executors."""
    arrow_rows(docs.sparkSession, 500)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return pieces_of(model).encode(texts.to_pylist())

    return docs.withColumn(to, encode(F.col("text")))


def decode_ids(docs: DataFrame, ids: str = "ids", *, model: str = MODEL, to: str = "decoded") -> DataFrame:
    """``docs`` with the text that the piece ids spell."""
    arrow_rows(docs.sparkSession, 500)

    @F.arrow_udf("string")
    def decode(numbers: pa.Array) -> pa.Array:
        return pieces_of(model).decode(numbers)

    return docs.withColumn(to, decode(F.col(ids)))
