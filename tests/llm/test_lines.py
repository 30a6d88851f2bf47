"""Lines that an earlier document holds, against brute force."""

import hashlib
from collections import Counter

import pytest
from feedloom.llm import line_dedup
from feedloom.llm.queries import QUERIES
from llm import odd

COMMON = "A line thaté stands everywhere"
LINES = [COMMON, f"  {COMMON.upper()}\t", "short", "just nine", "ten points", "\x0bten points\x0c",
         "ÅÄÖ åäö lines", "åäö åäö lines", "", "   ", "　ten points", "only here, once"]


def odd_lines():
    rows = [(i, t) for i, t, *_ in odd.odd_rows()]
    rows += [(20 + n, "\n".join(LINES[n % 5:] + [f"own line of {n}"])) for n in range(12)]
    rows += [(40, "\n".join(["twice in one document"] * 3)), (41, "Twice in one document"),
             (41, "twice in one document\n\n"), (42, None), (43, "\n"), (44, "\n" * 200),
             (None, f"{COMMON}\nten points"), (45, "\n".join(f"row number {n:04}" for n in range(500))),
             (46, "\n".join(f"ROW number {n:04}" for n in range(0, 700, 3)))]
    rows += [(46, rows[-1][1])]
    return rows


def plain(rows):
    key = lambda line: odd.lower(line.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for i, text in rows:
        for k in map(key, (text or "").split("\n")):
            if i is not None and len(k) >= 10:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if i is None or first.get(key(line), i) >= i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def documents(spark, rows):
    return odd.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])


def found(docs):
    return odd.as_counter(line_dedup.kept_lines(docs, line_dedup.keep_bitmaps(docs)),
                          "doc_id", "n_lines", "n_dropped", "kept")


@pytest.mark.parametrize("hot", [False, True])
def test_lines_equal_those_of_brute_force(spark, monkeypatch, hot):
    rows = odd_lines()
    # Hot or not, a hash gives the same lines.
    every = lambda df, key: [r[0] for r in df.select(key).distinct().collect()]
    monkeypatch.setattr(line_dedup, "hot_keys", every if hot else lambda df, key: [])
    assert found(documents(spark, rows)) == plain(rows)


def test_a_line_that_all_documents_hold_is_dealt_in_parts(spark):
    rows = [(n, f"{COMMON}\nown line of number {n}\n{COMMON.upper()}") for n in range(3000)]
    docs = documents(spark, rows)
    assert line_dedup.hot_keys(line_dedup.hashed_lines(docs), line_dedup.F.col("h1"))
    assert found(docs) == plain(rows)


def test_bitmaps_hold_words_with_lost_lines_only(spark):
    rows = [(1, "first shared line"), (2, "\n".join([f"line of my own {n}" for n in range(200)]
                                                    + ["First shared line "]))]
    bitmaps = line_dedup.keep_bitmaps(documents(spark, rows)).collect()
    assert [(r.doc_id, r.n_dropped, len(r.keep)) for r in bitmaps] == [(2, 1, 1)]
    (word,) = bitmaps[0].keep
    assert (word.word, word.bits) == (3, ~(1 << 8))


def test_no_documents(spark):
    assert found(documents(spark, [])) == Counter()


@pytest.mark.parametrize("hot", [[], [3]])
def test_ranges_of_hashes_are_sorted_without_a_further_exchange(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "hot_keys", lambda df, key: hot)
    stored = []
    monkeypatch.setattr(line_dedup, "materialise", lambda df, name: stored.append(df) or df)
    lines = spark.range(9).selectExpr("id h1", "id h2", "id doc_id", "id row", "int(id) pos")
    found = line_dedup.lost_lines(lines)
    plan = (stored or [found])[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Exchange rangepartitioning(h1" in plan


def test_query_on_whole_tables_runs_no_python(spark):
    found = QUERIES["op12_line_dedup"](spark, "/root/testdata/sf0.001")
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet").collect()]
    want = Counter({(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()): times
                    for (i, n, gone, kept), times in plain(rows).items()})
    assert odd.as_counter(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == want
