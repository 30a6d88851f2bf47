"""SimHash near-duplicates: fingerprints linked exactly through a vantage-point tree."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.chunks import releasing, releasing_group
from feedloom.llm.components import connected_components, forest
from feedloom.operators.joins import small_side
from feedloom.session import materialise

#: Words in a shingle, seed of its hash, and bits two linked fingerprints may differ in.
SHINGLE, SEED, RADIUS = 4, 42, 4
#: Distinct fingerprints that a shard of the tree owns, about.
SHARD = 1 << 14
#: Fingerprints from which the upper tree is built, at most.
SAMPLE = 1 << 16
#: Fingerprints that a leaf within a shard compares one by one.
LEAF = 96
#: Hashes whose bits are added up at once.
HASHES = 1 << 16
#: Pairs held before they are reduced to stars.
HELD = 1 << 20


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words, repeats included; A-Z in lower case."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)] if words else [], dtype=np.uint64)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[i:j], SEED)
                     for i, j in zip(starts, ends[size - 1:].tolist())], dtype=np.uint64)


def fingerprint(text: bytes) -> int:
    """Bit by bit the majority of the shingles' hashes; zero for a text without words."""
    hashes = shingle_hashes(text)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), HASHES):
        part = hashes[start:start + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, fp)``, the fingerprint as a signed long; a null text has no words.

    ``key`` is 128 bits of the text's hash and tells rows apart that repeat an id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_buffer().to_pybytes()) if text.is_valid else 0
                     for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(np.array(found, dtype=np.uint64).view(np.int64))],
                names=["doc_id", "key", "fp"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"),
        F.col("text").cast("string").alias("text")).mapInArrow(
            releasing(run), "doc_id long, key binary, fp long")


def text_key() -> Column:
    """128 bits of the text's hash; a null text has a key of its own."""
    return F.coalesce(F.unhex(F.md5(F.col("text").cast("string"))), F.lit(bytearray()))


def vantage(keys: np.ndarray) -> tuple[int, int] | None:
    """Of a few keys, the one whose distances spread most, and their median; None if none do."""
    best, spread = None, 0.0
    for at in np.linspace(0, len(keys) - 1, num=min(5, len(keys)), dtype=int):
        far = np.bitwise_count(keys ^ keys[at])
        middle = int(np.median(far))
        if middle == far.max():
            middle -= 1
        inside = float((far <= middle).mean())
        score = inside * (1 - inside) * float(far.std() + 1e-3)
        if score > spread:
            best, spread = (int(keys[at]), middle), score
    return best


def upper_tree(keys: np.ndarray, levels: int) -> dict[int, tuple[int, int]]:
    """Vantage point and radius of the upper nodes, node n having 2n and 2n + 1 below it."""
    tree, waiting = {}, [(1, keys)]
    while waiting:
        node, here = waiting.pop()
        if node >= 1 << levels or len(here) < 2 or (cut := vantage(here)) is None:
            continue
        tree[node] = cut
        inside = np.bitwise_count(here ^ np.uint64(cut[0])) <= cut[1]
        waiting += [(2 * node, here[inside]), (2 * node + 1, here[~inside])]
    return tree


def split(keys: np.ndarray, cut: tuple[int, int], own: np.ndarray, guests: np.ndarray):
    """Owners and guests of the inner and the outer side.

    A side has as guests what it does not own but what may be within the radius of something it
    owns, by the triangle bound; a pair across the border is met on the outer side alone.
    """
    point, border = np.uint64(cut[0]), cut[1]
    far = np.bitwise_count(keys[own] ^ point).astype(np.int16)
    far_guests = np.bitwise_count(keys[guests] ^ point).astype(np.int16)
    inner, near_border = own[far <= border], own[(far <= border) & (far > border - RADIUS)]
    return ((inner, guests[far_guests <= border + RADIUS]),
            (own[far > border], np.concatenate([guests[far_guests > border - RADIUS],
                                                near_border])))


def shards(keys: np.ndarray, tree: dict[int, tuple[int, int]]):
    """Node, positions owned and positions that are guests, for the ends of the upper tree."""
    everything = np.arange(len(keys))
    waiting = [(1, everything, everything[:0])]
    while waiting:
        node, own, guests = waiting.pop()
        if not len(own) and not len(guests):
            continue
        if node not in tree:
            yield node, own, guests
            continue
        inner, outer = split(keys, tree[node], own, guests)
        waiting += [(2 * node, *inner), (2 * node + 1, *outer)]


def stars(keys: np.ndarray, own: np.ndarray, guests: np.ndarray):
    """All links between the owned keys, and between them and the guests, as stars."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = 0
    waiting = [(own, guests)]
    while waiting:
        mine, theirs = waiting.pop()
        if not len(mine):
            continue
        cut = vantage(keys[mine]) if len(mine) > LEAF else None
        if cut:
            waiting += split(keys, cut, mine, theirs)
            continue
        both = np.concatenate([mine, theirs])
        for start in range(0, len(mine), LEAF):
            rows = mine[start:start + LEAF]
            others = both[start:]
            near = np.bitwise_count(keys[rows][:, None] ^ keys[others][None, :]) <= RADIUS
            x, y = np.nonzero(near)
            x, y = rows[x], others[y]
            other = x != y
            held.append((x[other], y[other]))
            count += int(other.sum())
            if count > HELD:
                held = [forest(*map(np.concatenate, zip(*held)))]
                count = 0
    if not held:
        return own[:0], own[:0]
    return forest(*map(np.concatenate, zip(*held)))


def links(keys: DataFrame) -> DataFrame:
    """Stars ``(a, b)`` that connect just those of the distinct fingerprints ``fp`` that a chain
    of links connects.

    The upper tree is built from a hash-ordered sample of at most ``SAMPLE`` fingerprints and so
    has a bounded size; every fingerprint goes to the shard that owns it and, as a guest, to those
    whose border it is near. A shard builds the rest of the tree over what it got.
    """
    count = keys.count()
    levels = max(0, ceil(log2(max(count, 1) / SHARD)))
    taken = keys.orderBy(F.xxhash64("fp")).limit(min(SAMPLE, 16 << levels))
    sample = np.array([row.fp for row in taken.collect()], dtype=np.int64).view(np.uint64)
    tree = upper_tree(sample, levels)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = frame["fp"].to_numpy().view(np.uint64)
            for node, own, guests in shards(found, tree):
                at = np.concatenate([own, guests])
                yield pd.DataFrame({"shard": node, "guest": np.arange(len(at)) >= len(own),
                                    "fp": found[at].view(np.int64)})

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        found, guest = frame["fp"].to_numpy().view(np.uint64), frame["guest"].to_numpy()
        x, y = stars(found, np.flatnonzero(~guest), np.flatnonzero(guest))
        return pd.DataFrame({"a": found[x].view(np.int64), "b": found[y].view(np.int64)})

    dealt = keys.select("fp").mapInPandas(releasing(deal), "shard long, guest boolean, fp long")
    return dealt.groupBy("shard").applyInPandas(releasing_group(join), "a long, b long")


def grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, key, fp)`` of each row and ``(fp, first, component)`` of each fingerprint, where
    ``first`` is its smallest id and ``component`` a fingerprint that names the group."""
    prints = materialise(fingerprints(docs), "prints")
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    joined = connected_components(links(classes)).withColumnRenamed("node", "fp")
    return prints, materialise(classes.join(joined, "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")), "named")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    Fingerprints link at ``RADIUS`` or fewer differing bits; a component is named by its smallest
    ``doc_id``. Documents with equal fingerprints are one key in the search, so a group of copies
    costs one row there. Null and empty texts and texts of white space have fingerprint zero and
    are linked by it as any others; a null id is never the smallest, and a group of only null ids
    has a null component; repeated rows come back each; no rows give no rows.
    """
    prints, named = grouped(docs)
    smallest = materialise(named.groupBy("component").agg(F.min("first").alias("component_id")),
                           "smallest")
    known = materialise(named.join(smallest, "component").select("fp", "component_id"), "known")
    return prints.join(known, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: the one with the smallest id.

    Where several rows of a group have that id, or none has one, the hash of the text decides; of
    rows that repeat id and text one stays. Texts without words are one group.
    """
    prints, named = grouped(docs)
    first = prints.groupBy("fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("row"))
    chosen = materialise(first.join(named, "fp").groupBy("component").agg(
        F.min("row").alias("row")).select(F.col("row.doc_id").alias("kept_id"),
                                          F.col("row.key").alias("kept_key")), "chosen")
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    twins = materialise(prints.groupBy("doc_id", "key").agg(F.count("*").alias("times"))
                        .where("times > 1").join(small_side(chosen), same, "left_semi"), "twins")
    here = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (
        text_key() == F.col("kept_key"))
    # Ids that fit a checked size go to the documents; more of them meet in a shuffle.
    kept = docs.join(small_side(chosen), here, "left_semi")
    return kept if twins.isEmpty() else kept.dropDuplicates(["doc_id", "text"])
