"""Tokenizer files, and a cache of the ids of text units that no token crosses."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

#: Units kept per Python worker; the cache starts anew beyond that.
CACHED_UNITS = 1_000_000
#: Bytes of text in one call of the library.
CALL_BYTES = 1 << 18
#: Bytes of texts that are cut into units together; a longer text is cut alone.
GROUP_BYTES = 8 << 20


@lru_cache(maxsize=8)
def tokenizer(name: str):
    """The ``tokenizers`` object of a vocabulary file, one thread: Spark has the cores busy."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


def calls(units: list, size=len) -> list[list]:
    """Units in calls of about equal bytes, long ones alone, like lengths together."""
    out, held = [[]], 0
    for unit in sorted(units, key=size):
        if out[-1] and held + size(unit) > CALL_BYTES:
            out.append([])
            held = 0
        out[-1].append(unit)
        held += size(unit)
    return out if out[0] else []


def parts(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """A column of texts in parts of about so many bytes, a longer text with no more than those."""
    held = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64))
    edges = [0, *(np.flatnonzero(np.diff(held // size)) + 1).tolist(), len(texts)]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield texts.slice(start, end - start)


class UnitCache(dict):
    """What ``encode`` gives per unit, kept between batches of a Python worker."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def learn(self, units) -> None:
        new = [unit for unit in set(units) if unit not in self]
        if len(self) + len(new) > CACHED_UNITS:
            needed = set(units)
            self.clear()
            new = list(needed)
        for call in calls(new):
            self.update(zip(call, self.encode(call)))


@lru_cache(maxsize=4)
def length_cache(name: str) -> UnitCache:
    def encode(units: list[bytes]) -> list[int]:
        found = tokenizer(name).encode_batch(
            [unit.decode("utf-8") for unit in units], add_special_tokens=False)
        return [len(one) for one in found]

    return UnitCache(encode)


# A byte-level pattern starts a token at a blank between two characters that are no white space,
# and no other token holds such a blank, so a text whose blanks all stand so may be cut there.
BLANKS_IN_A_ROW = (b"  ", b" \n", b"\n ")
# White space other than blanks and line ends.
RARE_ASCII = b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
RARE_STARTS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f",
               b"\xe3\x80\x80")
RARE_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"
                       rb"|\xe2\x81\x9f|\xe3\x80\x80")


def plain_blanks(data: bytes) -> bool:
    """Whether every blank of the text surely stands between two characters that are none."""
    return not (data.startswith(b" ") or data.endswith(b" ")
                or any(two in data for two in BLANKS_IN_A_ROW)
                or len(data.translate(None, RARE_ASCII)) < len(data)
                or not data.isascii() and any(start in data for start in RARE_STARTS)
                and RARE_WIDE.search(data))


# Line ends of which no other stands in front; with plain blanks a token starts there too.
LINE_ENDS = re.compile(rb"(?<!\n)\n")


def spaced(data: bytes) -> bytes:
    """A text of plain blanks with one more in front of line ends: between blanks lie pieces, its
    units, that no token crosses."""
    if b"\n\n" in data:
        return LINE_ENDS.sub(b" \n", data)
    return data.replace(b"\n", b" \n")


class IdCache:
    """Ids of units of a byte-level vocabulary file: ``" " + unit``, or the unit alone if that starts
    with a line end. Units and ids are Arrow arrays, so that those of many texts are looked up at once.
    """

    def __init__(self, name: str):
        self.tool = tokenizer(name)
        # Within a unit no token starts with a blank, nor with a line end if it has one at most.
        self.starts = np.array([self.tool.id_to_token(i)[:1] in ("\u0120", "\u010a")
                                for i in range(self.tool.get_vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.units = pa.array([], pa.large_binary())
        self.ids = pa.array([], pa.large_list(pa.uint32()))

    def __iter__(self):
        return iter(self.units.to_pylist())

    def learn(self, needed: pa.Array) -> pa.Array:
        """The ids of distinct units. What is missing is encoded as running text, and the ids are cut
        where a unit starts."""
        place = self._places(needed)
        if len(self.units) + np.count_nonzero(place < 0) > CACHED_UNITS:
            self.clear()
            place = self._places(needed)
        missing = np.flatnonzero(place < 0)
        if len(missing):
            new = needed.take(pa.array(missing))
            lone = pc.or_(pc.starts_with(new, "\n\n"), pc.equal(new, b"\n"))
            running, apart = new.filter(pc.invert(lone)), new.filter(lone)
            ids, lengths = [], []
            for call in self._calls(running):
                one, = self.encode([(b" " + b" ".join(call)).replace(b" \n", b"\n")])
                ids.append(one)
                lengths.append(np.diff(np.append(np.flatnonzero(self.starts[one]), len(one))))
            for call in self._calls(apart):
                ids += self.encode(call)
                lengths.append(np.array([len(one) for one in ids[-len(call):]]))
            order = np.argsort(lone.to_numpy(zero_copy_only=False), kind="stable")
            place[missing[order]] = len(self.units) + np.arange(len(new))
            self.units = pa.concat_arrays([self.units, running, apart])
            self.ids = pa.concat_arrays([self.ids, pa.LargeListArray.from_arrays(
                np.cumsum(np.concatenate([[0], *lengths])), np.concatenate(ids))])
        return self.ids.take(pa.array(place))

    def _places(self, needed: pa.Array) -> np.ndarray:
        return pc.index_in(needed, value_set=self.units).fill_null(-1).to_numpy().copy()

    @staticmethod
    def _calls(units: pa.Array) -> Iterator[list[bytes]]:
        for part in parts(units, CALL_BYTES):
            yield part.to_pylist()

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tool.encode_batch_fast([text.decode("utf-8") for text in texts],
                                            add_special_tokens=False)
        return [np.array(one.ids, dtype="<u4") for one in found]


@lru_cache(maxsize=4)
def id_cache(name: str) -> IdCache:
    return IdCache(name)


def byte_level_ids(name: str, texts: list[bytes]) -> list[np.ndarray]:
    """Ids of whole texts, equal to the library's for a byte-level vocabulary file."""
    cache = id_cache(name)
    out, some, held = [], [], 0
    for data in texts:
        if some and held + len(data) > GROUP_BYTES:
            out += _group_ids(cache, some)
            some, held = [], 0
        some.append(data)
        held += len(data)
    return out + _group_ids(cache, some)


def _group_ids(cache: IdCache, texts: list[bytes]) -> list[np.ndarray]:
    plain = [plain_blanks(data) for data in texts]
    # Nothing stands in front of the first unit, so the cache does not hold it.
    cut = [spaced(data).partition(b" ") for data, one in zip(texts, plain) if one]
    heads = iter(cache.encode([head for head, _, _ in cut]))
    units = pc.split_pattern(pa.array([rest if blank else None for _, blank, rest in cut],
                                      pa.large_binary()), " ")
    ends = np.cumsum(pc.list_value_length(units).fill_null(0).to_numpy(zero_copy_only=False))
    coded = units.flatten().dictionary_encode()
    each = cache.learn(coded.dictionary).take(coded.indices)
    places, ids = each.offsets.to_numpy(), each.values.to_numpy()
    rests = iter(np.split(ids, places[ends])[:-1])
    return [np.concatenate([next(heads), next(rests)]) if one else cache.encode([data])[0]
            for data, one in zip(texts, plain)]


def word_lengths(name: str, text: bytes) -> int:
    """Tokens of a text for a vocabulary file whose tokens never hold white space."""
    words, cache = text.split(), length_cache(name)
    try:
        return sum(map(cache.__getitem__, words))
    except KeyError:
        cache.learn(words)
        return sum(map(cache.__getitem__, words))
