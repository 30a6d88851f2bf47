"""SentencePiece BPE of one text as a max-plus scan over its chunks.

BPE with piece ranks has one property that lets a text be cut anywhere: a sequence of pieces is
the encoding of its text just if each two neighbours are the encoding of theirs, because a merge
across a border would happen in the pair alone as well, at the same turn. So the encoding is the
one path through the pieces of the text on which every step weighs zero, when a step between
neighbours that BPE would merge otherwise weighs minus infinity. Additive piece scores, as in a
unigram vocabulary, would not give BPE's result; these weights do.

A state at a cut is a piece that ends there or reaches across. A chunk is a matrix of the weights
of the best paths from the states at its start to those at its end; matrices combine by the
max-plus product, which is associative. Once the states at all cuts are known, each chunk finds
its own pieces.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

BLANK = "▁"
#: Pairs of pieces whose fit is remembered.
KNOWN_PAIRS = 1 << 18
#: Units of text that a call of the library gets; longer texts take it more time a sign.
TOGETHER = 512
NEVER = -np.inf


@lru_cache(maxsize=2)
def processor(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


class Pieces:
    """Pieces and ranks of a BPE model file that leaves texts as they are but for blanks."""

    def __init__(self, model: str):
        tool = processor(model)
        usual = [i for i in range(tool.get_piece_size()) if not (
            tool.is_control(i) or tool.is_unknown(i) or tool.is_byte(i) or tool.is_unused(i))]
        self.ids = {tool.id_to_piece(i): i for i in usual}
        self.scores = {tool.id_to_piece(i): tool.get_score(i) for i in usual}
        self.bytes = {int(tool.id_to_piece(i)[3:5], 16): i
                      for i in range(tool.get_piece_size()) if tool.is_byte(i)}
        self.unknown = tool.unk_id()
        self.longest = max(map(len, self.ids))
        self._fits: dict[tuple[str, str], bool] = {}

    @staticmethod
    def spelled(text: str) -> str:
        """The text as pieces spell it; one blank goes in front."""
        return (BLANK + text.replace(" ", BLANK)) if text else ""

    def merged(self, text: str) -> list[str]:
        """BPE of a short text, by its definition."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Whether BPE keeps these two pieces when they stand side by side."""
        if not left:
            return self.merged(right) == [right]
        pair = (left, right)
        found = self._fits.get(pair)
        if found is None:
            if len(self._fits) >= KNOWN_PAIRS:
                self._fits.clear()
            found = self._fits[pair] = self.merged(left + right) == [left, right]
        return found

    def piece_ids(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        raw = piece.encode("utf-8")
        return [self.bytes.get(b, self.unknown) for b in raw] if self.bytes else [self.unknown]


@lru_cache(maxsize=2)
def pieces_of(model: str) -> Pieces:
    return Pieces(model)


class Units:
    """The library's ids of many texts, of which it encodes each distinct unit once.

    A unit is a word with one blank in front, or a line end with the word behind it. No piece
    reaches across the start of a unit, so the ids of a text are those of its units.
    """

    def __init__(self, model: str):
        self.tool, pieces = processor(model), pieces_of(model)
        every = [self.tool.id_to_piece(i) for i in range(self.tool.get_piece_size())]
        # Without bytes for what has no piece, unknown signs side by side would be one id.
        self.cuts = len(pieces.bytes) == 256 and not any(
            BLANK in piece.lstrip(BLANK) or "\n" in piece for piece in every)
        # Within a unit no piece starts with a blank, or is a line end.
        self.starts = np.array([piece[:1] == BLANK for piece in every])
        self.starts[pieces.bytes.get(ord("\n"), 0)] = True

    def _encoded(self, units: pa.Array, between: str, extra: int):
        """Ids of units as running text, and where each unit starts among them."""
        cuts = pa.array([*range(0, len(units), TOGETHER), len(units)], pa.int32())
        ids, at, ahead = [np.empty(0, np.int32)], [np.empty(0, np.int64)], 0
        for text in pc.binary_join(pa.ListArray.from_arrays(cuts, units), between).to_pylist():
            found = np.array(self.tool.encode(text)[extra:], np.int32)
            ids.append(found)
            at.append(np.flatnonzero(self.starts[found]) + ahead)
            ahead += len(found)
        return np.concatenate(ids), np.concatenate(at)

    def of(self, texts: pa.Array) -> pa.ListArray:
        """Lists of ids of whole texts, none of them null."""
        spaced = pc.replace_substring(texts, "\n", " \n")
        odd = np.ones(len(texts), dtype=bool)
        if self.cuts:
            odd = pc.match_substring_regex(spaced, f"^$|  |^ | $|{BLANK}").to_numpy(
                zero_copy_only=False)
        words = pc.split_pattern(spaced.filter(pa.array(~odd)), " ")
        coded = pc.dictionary_encode(words.flatten())
        line = pc.starts_with(coded.dictionary, "\n")
        first, first_at = self._encoded(coded.dictionary.filter(pc.invert(line)), " ", 0)
        # The library puts a blank in front; a line end has none.
        second, second_at = self._encoded(coded.dictionary.filter(line), "", 1)
        line = line.to_numpy(zero_copy_only=False)
        ids, begin = np.concatenate([first, second]), np.empty(len(line), dtype=np.int64)
        size = np.empty(len(line), dtype=np.int64)
        begin[~line], begin[line] = first_at, second_at + len(first)
        size[~line] = np.diff(first_at, append=len(first))
        size[line] = np.diff(second_at, append=len(second))
        # From the units' ids to those of the texts, one after the other.
        unit = coded.indices.to_numpy()
        long = size[unit]
        ends = np.cumsum(long)
        values = ids[np.repeat(begin[unit] - ends + long, long) + np.arange(long.sum())]
        last = words.offsets.to_numpy()
        sizes = np.zeros(len(texts), dtype=np.int64)
        sizes[~odd] = np.diff(np.concatenate([[0], ends])[last])
        if odd.any():
            whole = {at: np.array(self.tool.encode(texts[at].as_py()), np.int32)
                     for at in np.flatnonzero(odd).tolist()}
            parts = iter(np.split(values, np.cumsum(sizes[~odd])[:-1]))
            values = np.concatenate([whole[at] if one else next(parts)
                                     for at, one in enumerate(odd.tolist())])
            sizes[odd] = [len(one) for one in whole.values()]
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


@lru_cache(maxsize=2)
def units_of(model: str) -> Units:
    return Units(model)


def states(pieces: Pieces, text: str, cut: int) -> list[tuple[int, int]]:
    """The pieces ``(start, end)`` of a text with start < cut <= end, in order."""
    out = []
    for start in range(max(0, cut - pieces.longest), cut):
        for end in range(cut, min(len(text), start + pieces.longest) + 1):
            if end - start == 1 or text[start:end] in pieces.ids:
                out.append((start, end))
    return out


def _spread(pieces: Pieces, text: str, first: list[tuple[int, int]], stop: int):
    """From the pieces ``first``, all pieces that can follow, up to those that reach ``stop``.

    ``reached[end][start]`` is a bit set of the first pieces from which ``text[start:end]`` can
    follow. From one first piece at most one piece ends at any place.
    """
    reached: dict[int, dict[int, int]] = {}
    for bit, (start, end) in enumerate(first):
        reached.setdefault(end, {})[start] = reached.get(end, {}).get(start, 0) | 1 << bit
    low = min((end for _, end in first), default=stop)
    for at in range(low, stop):
        here = reached.get(at)
        if not here:
            continue
        lefts = [(text[start:at], bits) for start, bits in here.items()]
        for end in range(at + 1, min(len(text), at + pieces.longest) + 1):
            right = text[at:end]
            if end - at > 1 and right not in pieces.ids:
                continue
            bits = 0
            for left, more in lefts:
                if pieces.fits(left, right):
                    bits |= more
            if bits:
                reached.setdefault(end, {})[at] = bits
    return reached


def _entry(pieces: Pieces, text: str, cut: int) -> list[tuple[int, int]]:
    return states(pieces, text, cut) if cut else [(0, 0)]


def transfer(pieces: Pieces, text: str, start: int, stop: int) -> np.ndarray:
    """Weights of the best paths between the states at two cuts of ``text``."""
    first, last = _entry(pieces, text, start), states(pieces, text, stop)
    reached = _spread(pieces, text, first, stop)
    out = np.full((len(first), len(last)), NEVER)
    for column, (begin, end) in enumerate(last):
        bits = reached.get(end, {}).get(begin, 0)
        for row in range(len(first)):
            if bits >> row & 1:
                out[row, column] = 0.0
    return out


def backtrace(pieces: Pieces, text: str, start: int, stop: int, row: int, column: int) -> list[int]:
    """Ids of the pieces behind the state ``row`` at ``start`` up to the state ``column``."""
    first = _entry(pieces, text, start)[row]
    begin, end = states(pieces, text, stop)[column]
    reached = _spread(pieces, text, [first], stop)
    found = []
    while (begin, end) != first:
        found.append(text[begin:end])
        # One piece at most ends where this one begins, so the way back is the way here.
        (begin, end), = [(before, begin) for before in reached[begin]
                         if pieces.fits(text[before:begin], text[begin:end])]
    return [i for piece in reversed(found) for i in pieces.piece_ids(piece)]


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (left[:, :, None] + right[None, :, :]).max(axis=1, initial=NEVER)


def running(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """All products of a beginning, in pairs of pairs: the order does not matter."""
    if len(matrices) < 2:
        return list(matrices)
    pairs = running([product(matrices[i], matrices[i + 1])
                     for i in range(0, len(matrices) - 1, 2)])
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(pairs[i // 2] if i % 2 else product(pairs[i // 2 - 1], matrices[i]))
    return out


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at the end of each chunk, on the path that starts the text and ends it."""
    ahead = running(matrices)
    behind = np.zeros((matrices[-1].shape[1], 1))
    out = [0] * len(matrices)
    for i in range(len(matrices) - 1, -1, -1):
        total = ahead[i][0] + behind[:, 0]
        out[i] = int(total.argmax())
        if total[out[i]] == NEVER:
            raise ValueError("no path leads through this text")
        behind = product(matrices[i], behind)
    return out
