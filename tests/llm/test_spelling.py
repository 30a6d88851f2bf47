"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from feedloom.llm import spelling
from feedloom.llm.queries import QUERIES
from llm import odd


def vocabulary(rows, length=6, times=5, noise=199):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = odd.lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= times}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(counts):
    near = {w: [] for w in counts}
    words = sorted(counts)
    for n, a in enumerate(words):
        for b in words[n + 1:]:
            if one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= 5 * counts[w]:
                form[w] = best
    out = Counter()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w, form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w))] += 1
    return out


def found(df):
    return odd.as_counter(df, "word", "form", "root", "n", "n_near", "form_n")


def awkward_rows():
    pick = random.Random(5)
    letters = "abcdeåöé÷×ß"
    words = ["".join(pick.choice(letters) for _ in range(pick.randint(6, 9))) for _ in range(25)]
    rows = []
    for w in words + ["aaaaaa", "aaaaaaa", "aaaaab", "abababab", "babababa", "ÀÀÀÀÀÀ", "ààààààà"]:
        forms = [w]
        for _ in range(6):
            at, way = pick.randrange(len(w)), pick.randrange(3)
            forms.append(w[:at] + pick.choice(letters) * (way > 0) + w[at + (way < 2):])
        for n, form in enumerate(forms):
            text = f" {form.upper() if n % 2 else form}7" * pick.choice((3, 5, 6, 30, 200))
            rows.append((pick.choice((None, n, -n, 10 ** 12 + n)), text))
    return rows + [(i, t) for i, t, *_ in odd.odd_rows()] + [(1, "abcdef ghijkl " * 9)] * 2


def test_variants_equal_those_of_brute_force(spark):
    rows = awkward_rows()
    docs = odd.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    want = variants(vocabulary(rows))
    assert any(root != form for _, form, root, *_ in want if form)
    assert found(spelling.spelling_variants(docs)) == want


def test_variants_where_most_runs_lose_a_code_point(spark):
    rows = awkward_rows()
    docs = odd.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    assert found(spelling.spelling_variants(docs, noise=2)) == variants(vocabulary(rows, noise=2))


def test_long_texts_are_cut_between_runs():
    text = "".join(random.Random(1).choices("abcå .", k=5000))
    parts = list(spelling.pieces(text, 7))
    assert "".join(parts) == text and len(parts) > 100
    runs = re.compile(f"[{spelling.LETTERS}]+")
    assert [r for part in parts for r in runs.findall(part)] == runs.findall(text)
    assert list(spelling.pieces("x" * 50, 7)) == ["x" * 50]


def test_roots_follow_long_chains(spark):
    steps = spark.createDataFrame([(f"w{n}", f"w{n + 1}") for n in range(37)], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(steps).collect()} == {
        f"w{n}": "w37" for n in range(37)}


def test_no_documents_and_no_frequent_words(spark):
    for rows in ([], [(1, "lonely wanderer"), (2, None)]):
        docs = odd.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
        assert spelling.spelling_variants(docs).collect() == []


def test_words_meet_by_chunks_and_are_checked_in_the_join(spark):
    words = spark.createDataFrame([("abcdef", 5)], "word string, n long")
    plan = spelling.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert any("levenshtein" in line and "Join" in line for line in plan.splitlines())


def test_query_on_whole_tables(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    assert found(QUERIES["op13_spelling_variants"](spark, path)) == variants(vocabulary(rows))
