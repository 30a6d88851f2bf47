"""Registered queries against their SQL, and the pipeline against a plain version of its stages."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from compare import connect, differences
from feedloom.llm import piece_scan
from feedloom.llm.queries import ORACLE, QUERIES
from llm import odd

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_the_rows_of_its_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline_equals_its_stages_done_plainly(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    # All these documents are in the four languages, so the first stage keeps them.
    rows = [(r.doc_id, r.text) for r in docs]
    prints = {i: odd.simhash(text) for i, text in rows}
    ids = sorted(prints)
    group = odd.components(ids, [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
                                 if (prints[a] ^ prints[b]).bit_count() <= 4])
    rows = [(i, text) for i, text in rows if group[i] == i]
    texts = dict(rows)
    rows = [(i, kept if gone else texts[i]) for i, _, gone, kept in odd.repeats(rows)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in odd.contamination(rows, items) if not hit}
    tool = piece_scan.processor(corpus_pipeline.MODEL)
    want = {}
    for i, text in rows:
        if i in clean:
            found = tool.encode(text or "")
            want[i] = (len(found), zlib.crc32(np.array(found, "<u4").tobytes()), True)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32, r.restored)
           for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == want
