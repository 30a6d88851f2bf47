"""Documents of every awkward kind, and plain versions of what the operators compute."""

import random
import re
import zlib
from collections import Counter

import xxhash

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHING = ["key", "term", "pos", "window", "chunk", "rows", "fp", "node", "a", "b", "size", "raw",
            "cell", "id", "start", "kept", "ids", "c0", "c1", "words", "part", "seq", "bucket"]


def prose(seed, count):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("aeioulnrst") for _ in range(pick.randint(2, 7)))
                    for _ in range(count))


def odd_rows():
    shared, other = prose(1, 130), prose(2, 90)
    long_text = prose(3, 9000)
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "One short line."), (5, shared),
        (6, f"{prose(4, 40)} {shared} {prose(5, 30)}"), (6, f"{prose(4, 40)} {shared} {prose(5, 30)}"),
        (7, shared), (8, f"{other} {shared.upper()} {other}"), (9, long_text),
        (10, f"{prose(6, 10)} {' '.join(long_text.split()[100:400])}"), (None, shared),
        (None, None), (11, f"{other}\x0b{prose(7, 20)}"), (12, "x" * 30000), (13, "é" * 5000),
        (14, "tab\tand\nline and 　 wide <|endoftext|> 's"), (7, prose(8, 60)),
        (15, "日本語 " * 60), (-3, f"{shared} tail"), (16, "the " * 400), (17, "the " * 400),
    ]
    return [(i, t, "en", f"s{n % 3}", len(t) if t else 0) for n, (i, t) in enumerate(texts)]


def documents(spark, rows=None, clashing=True):
    docs = spark.createDataFrame(odd_rows() if rows is None else rows, DOCUMENT)
    if clashing:
        from pyspark.sql import functions as F

        for name in CLASHING:
            docs = docs.withColumn(name, F.lit("x"))
    return docs


def as_counter(df, *columns):
    return Counter(tuple(row) for row in df.select(*columns).collect())


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def word_runs(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def repeats(rows, size=50):
    """Words, removed words and kept text per row."""
    first = {}
    for i, text in rows:
        found = words(text)
        if i is not None:
            for at in range(len(found) - size + 1):
                window = tuple(found[at:at + size])
                first[window] = min(first.get(window, i), i)
    out = []
    for i, text in rows:
        found, gone = words(text), set()
        for at in range(len(found) - size + 1):
            if i is not None and first.get(tuple(found[at:at + size]), i) < i:
                gone.update(range(at, at + size))
        out.append((i, len(found), len(gone),
                    " ".join(w for n, w in enumerate(found) if n not in gone)))
    return out


def contamination(rows, items, size=10):
    windows = {}
    for item, text in items:
        found = word_runs(text)
        for at in range(max(1, len(found) - size + 1) if found else 0):
            windows.setdefault(tuple(found[at:at + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in rows:
        found, hit, by = word_runs(text), set(), set()
        for length in lengths:
            for at in range(len(found) - length + 1):
                window = tuple(found[at:at + length])
                if window in windows:
                    hit.update(range(at, at + length))
                    by |= windows[window]
        out.append((i, len(found), len(hit), sorted(str(x) for x in by if x is not None)))
    return out


def simhash(text):
    found = [w.encode() for w in words(lower(text))]
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64)
               if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    """Smallest node reachable from each."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def is_training(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 != 0
