"""The whole query of page languages against sums and products written out one by one."""

import math
import re
from collections import Counter, defaultdict

from feedloom.llm import language
from feedloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SIZE, ADDED, NOISE, TEMPER = 1 << 14, 0.1, 0.2, 0.4


def buckets(text):
    raw = b" " + text.lower().encode("utf-8", "replace") + b" "
    plain = re.sub(rb"[^A-Za-z\x80-\xff]+", b" ", raw)
    return [(a * 961 + b * 31 + c * 7919) % SIZE for a, b, c in zip(plain, plain[1:], plain[2:])]


def text_model(labelled):
    counts = defaultdict(Counter)
    for text, lang in labelled:
        if text and lang and lang.strip():
            counts[lang.strip().lower()].update(buckets(text))
    return {lang: (c, sum(c.values())) for lang, c in sorted(counts.items())}


def by_text(model, text):
    found = buckets(text or "")
    logs = [TEMPER * sum(math.log((c[b] + ADDED) / (n + SIZE * ADDED) * (1 - NOISE) + NOISE / SIZE)
                         for b in found) for c, n in model.values()]
    logs.append(TEMPER * len(found) * math.log(1 / SIZE))
    weights = [math.exp(v - max(logs)) for v in logs]
    return [w / sum(weights) for w in weights]


def place(url):
    found = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", (url or "").lower())
    labels = (found[1] if found else "").split(".")
    deep = len(labels) > 2 and labels[-2] in language.SECOND_LEVEL and len(labels[-1]) == 2
    return labels[-1], ".".join(labels[-(3 if deep else 2):]), ".".join(labels)


def declared(html):
    found = re.search(r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", html or "")
    return found[1].lower() if found else ""


def shares(weights):
    return [w / sum(weights) for w in weights]


def added(rows, size):
    return [sum(r[k] for r in rows) for k in range(size)]


def towards(counts, above, strength=5.0):
    return [(n + p * strength) / (sum(counts) + strength) for n, p in zip(counts, above)]


def identified(pages, labelled):
    model = text_model(labelled)
    classes = [*model, "und"]
    size, kinds = len(classes), [*model, "other"]
    rows = []
    for i, url, html in pages:
        text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", html or "")
        said = declared(html)
        rows.append((i, place(url), said, said if said in classes or not said else "other",
                     by_text(model, text)))
    table = []
    for n, kind in enumerate(kinds):
        seen = added([r[4] for r in rows if r[3] == kind], size)
        table.append([v + 0.5 + (5.0 if n == k and kind != "other" else 0.0)
                      for k, v in enumerate(seen)])
    columns = [sum(line[k] for line in table) for k in range(size)]
    own = []
    for r in rows:
        told = table[kinds.index(r[3])] if r[3] else columns
        own.append(shares([p * t / c for p, t, c in zip(r[4], told, columns)]))
    sums = defaultdict(list)
    for r, o in zip(rows, own):
        for level in range(4):
            sums[r[1][:level]].append(o)
    sums = {key: added(lines, size) for key, lines in sums.items()}
    base = shares([n + 1.0 for n in sums[()]])
    out = {}
    for r, o in zip(rows, own):
        above = towards(sums[r[1][:2]], towards(sums[r[1][:1]], base))
        others = [max(n - v, 0.0) for n, v in zip(sums[r[1]], o)]
        final = shares([v * p for v, p in zip(o, towards(others, above))])
        best = max(range(size), key=lambda k: final[k])
        out[r[0]] = (r[1][2], r[2], classes[max(range(size), key=lambda k: r[4][k])],
                     classes[best], final[best])
    return out


def test_query_equals_the_definition(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    pages = [(r.page_id, r.url, r.html) for r in read("pages").collect()]
    want = identified(pages, [(r.text, r.lang) for r in read("documents").collect()])
    got = {r.page_id: (r.host, r.declared, r.text_lang, r.lang, r.probability)
           for r in QUERIES["op6_page_language"](spark, SF_DIR).collect()}
    assert set(got) == set(want)
    for i, row in want.items():
        assert got[i][:4] == row[:4] and math.isclose(got[i][4], row[4], rel_tol=1e-9), i
