"""Token files, token counts, pieces and the language model, against the libraries and by hand."""

import functools
import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from feedloom.llm import katz, piece_scan, range_coder, sentence_pieces, token_files, wordpieces
from feedloom.llm.queries import QUERIES
from feedloom.llm.token_counts import pieces, token_counts
from feedloom.session import dropping_shuffles, fresh_path
from llm import odd
from tokenizers import Tokenizer

BYTE, WORD, PIECE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def _odd_texts(count=3000):
    pick = random.Random(1)
    signs = ["a", "b", "É", "é", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\x1c", "\x85",
             "\xa0", "　", "<|endoftext|>", "<|startoftext|>", "'s", "'", "9", "!", "ß", "İ",
             "Σ", "日", "‍", "😀", "\r", " x", "\x00", "'ll"]
    return ["".join(pick.choice(signs) for _ in range(pick.randint(0, 14))) for _ in range(count)]


def test_cached_units_give_the_library_ids():
    texts = _odd_texts()
    byte, word = (Tokenizer.from_file(public_tokenizers.path(n)) for n in (BYTE, WORD))
    for text, ids, want in zip(texts, wordpieces.byte_level_ids(
            BYTE, [text.encode() for text in texts]),
                               byte.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == want.ids, text
    for text, want in zip(texts, word.encode_batch(texts, add_special_tokens=False)):
        assert wordpieces.word_lengths(WORD, text.encode()) == len(want.ids), text


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(wordpieces, "CACHED_UNITS", 5)
    texts = ["one two three four five six seven", "eight nine ten one two", "one"]
    byte = Tokenizer.from_file(public_tokenizers.path(BYTE))
    for _ in range(2):
        got = [ids.tolist() for ids in wordpieces.byte_level_ids(
            BYTE, [text.encode() for text in texts])]
        assert got == [one.ids for one in byte.encode_batch(texts, add_special_tokens=False)]


def test_units_end_at_line_ends_and_are_learned_together(monkeypatch):
    texts = ["x one.\nTo two", "\none.\n\nTo\n", "y one. two\nTo\n\n\nz one.", "a  b\nTo", "", "\n"]
    given = [text.encode() for text in texts]
    wordpieces.id_cache.cache_clear()
    learned, learn = [], wordpieces.IdCache.learn
    monkeypatch.setattr(wordpieces.IdCache, "learn",
                        lambda self, words: learned.append(words) or learn(self, words))
    byte = Tokenizer.from_file(public_tokenizers.path(BYTE))
    want = [one.ids for one in byte.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in wordpieces.byte_level_ids(BYTE, given)] == want
    assert len(learned) == 1
    held = set(wordpieces.id_cache(BYTE))
    assert {b"one.", b"\nTo", b"two"} <= held and b"one.\nTo" not in held
    monkeypatch.setattr(wordpieces, "GROUP_BYTES", 4)
    wordpieces.id_cache.cache_clear()
    assert [ids.tolist() for ids in wordpieces.byte_level_ids(BYTE, given)] == want


def test_distinct_units_of_many_texts_are_looked_up_at_once(spark, monkeypatch):
    wordpieces.id_cache.cache_clear()
    learned, learn = [], wordpieces.IdCache.learn
    monkeypatch.setattr(wordpieces.IdCache, "learn",
                        lambda self, units: learned.append(units.to_pylist()) or learn(self, units))
    texts = [b"x one.\ntwo\nTo one." + b" two three" * 200_000, b"", b"y", b"z two\nTo\n\nx"]
    byte = Tokenizer.from_file(public_tokenizers.path(BYTE))
    want = [one.ids for one in byte.encode_batch([text.decode() for text in texts],
                                                 add_special_tokens=False)]
    assert [ids.tolist() for ids in wordpieces.byte_level_ids(BYTE, texts)] == want
    assert [sorted(units) for units in learned] == [
        [b"\n\nx", b"\nTo", b"\ntwo", b"one.", b"three", b"two"]]
    assert [len(part) for part in wordpieces.parts(pa.array([b"ab", None, b"", b"abc", b"a"]), 3)
            ] == [3, 1, 1]
    monkeypatch.setattr(wordpieces, "GROUP_BYTES", 5)
    docs = spark.createDataFrame([(i, "ab " * (i % 3)) for i in range(20)], "doc_id long, text string")
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(docs.coalesce(1), path, BYTE, 0)
    assert {(r.doc_id, tuple(r.ids)) for r in token_files.read_token_files(spark, path).collect()} == {
        (r.doc_id, (*byte.encode(r.text, add_special_tokens=False).ids, 0)) for r in docs.collect()}


def test_coded_bytes_stay_as_they_are():
    """Files that were written before can be read, so a faster coder gives the same bytes."""
    pick = np.random.default_rng(1)
    ids = (pick.zipf(1.3, 300_000) % 50000).astype("<u4")
    assert [zlib.crc32(range_coder.encode(ids[:n])) for n in (9000, 300_000)] == [1657293917, 3559649200]
    assert range_coder.Model(2, 9).after.nbytes == 2 * 2 * (range_coder.BLOCK + 10)


@pytest.mark.parametrize("bits", [16, 32])
def test_ids_come_back_from_their_blocks(bits):
    pick = np.random.default_rng(1)
    for ids in ([], [5], [1] * 9000, range(5000), pick.integers(0, 50257, 9000),
                pick.zipf(1.3, 9000) % 50000, [0, (1 << bits) - 1]):
        ids = np.array(ids, dtype="<u4")
        assert (range_coder.decode(range_coder.encode(ids, bits)) == ids).all()


def test_predictable_ids_take_few_bytes():
    ids = np.tile(np.random.default_rng(2).integers(0, 50257, 50), 80)
    assert len(range_coder.encode(np.tile(ids, 100))) < 100 * len(ids) / 2


def test_damage_is_found():
    ids = np.random.default_rng(1).integers(0, 50257, 9000).astype("<u4")
    data = range_coder.encode(ids)
    for at in (0, 9, 40, len(data) // 2, len(data) - 9):
        broken = bytearray(data)
        broken[at] ^= 0x55
        with pytest.raises(range_coder.Damaged):
            range_coder.decode(bytes(broken))
    with pytest.raises(range_coder.Damaged):
        range_coder.decode(data[:-4])


def test_token_files_hold_all_documents_in_order(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 3000)
    docs = odd.documents(spark).repartition(4)
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(docs, path, BYTE, 0)
    files = token_files.read_token_files(spark, path).collect()
    byte = Tokenizer.from_file(public_tokenizers.path(BYTE))
    want = Counter((r.doc_id, tuple(byte.encode(r.text or "", add_special_tokens=False).ids + [0]))
                   for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in files) == want
    ordered = sorted(files, key=lambda r: r.start)
    ids = [-10 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)
    assert [r.start for r in ordered] == np.cumsum([0, *[r.n_tokens for r in ordered]])[:-1].tolist()
    digests = {r.start: (r.n_tokens, r.ids_crc32) for r in token_files.read_token_digests(
        spark, path).collect()}
    assert digests == {r.start: (r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes()))
                       for r in files}


def test_no_token_files(spark):
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(odd.documents(spark, []), path, BYTE, 0)
    assert token_files.read_token_digests(spark, path).collect() == []


def test_token_counts_are_the_library_lengths(spark):
    word = Tokenizer.from_file(public_tokenizers.path(WORD))
    docs = odd.documents(spark)
    got = odd.as_counter(token_counts(docs, WORD, 300), "doc_id", "n_bytes", "n_tokens",
                         "over_limit")
    want = Counter()
    for row in docs.collect():
        text = row.text or ""
        n = len(word.encode(text, add_special_tokens=False).ids)
        want[(row.doc_id, len(text.encode()), n, n > 300)] += 1
    assert got == want
    assert token_counts(odd.documents(spark, []), WORD, 1).collect() == []


def test_long_texts_are_cut_at_white_space():
    text = odd.prose(1, 500).encode() + b" " + b"x" * 900 + b"\n" + b"y"
    for limit in (10, 64, 1000):
        parts = pieces(text, limit)
        assert b"".join(parts) == text
        assert [w for p in parts for w in p.split()] == text.split()


def test_pieces_of_cut_texts_are_those_of_whole_texts():
    found, tool = piece_scan.pieces_of(PIECE), piece_scan.processor(PIECE)
    pick = random.Random(3)
    signs = ["a", "b", "the", "e", " ", "  ", "    ", "\n", "é", "日", "本語", "😀", "in", "ing",
             "▁", "1", "12", "\x00", "n", "t", "ation"]
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(20, 100))) for _ in range(80)]
    for text in [*texts, "a" * 300, "日本語" * 60, " " * 200]:
        whole = found.spelled(text)
        cuts = [0, *sentence_pieces._cuts(len(whole), found.longest, 40)]
        spans = list(zip(cuts, cuts[1:]))
        ends = piece_scan.best_states([piece_scan.transfer(found, whole, a, b) for a, b in spans])
        ids = [i for k, (a, b) in enumerate(spans) for i in piece_scan.backtrace(
            found, whole, a, b, ends[k - 1] if k else 0, ends[k])]
        assert ids == tool.encode(text), text


def test_products_of_chunks_do_not_depend_on_their_order():
    pick = np.random.default_rng(4)
    parts = [np.where(pick.random((3, 3)) < 0.6, 0.0, piece_scan.NEVER) for _ in range(7)]
    whole = parts[0]
    for n, part in enumerate(parts[1:], 1):
        whole = piece_scan.product(whole, part)
        assert (piece_scan.running(parts)[n] == whole).all()


def test_encoded_documents_decode_to_their_texts(spark):
    docs = odd.documents(spark)
    tool = piece_scan.processor(PIECE)
    encoded = sentence_pieces.encode_pieces(docs, PIECE, giant=300, chunk=100)
    want = Counter((r.doc_id, tuple(tool.encode(r.text or ""))) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    back = sentence_pieces.decode_pieces(encoded, PIECE)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(
        (r.doc_id, r.text or "") for r in docs.collect())
    digests = sentence_pieces.piece_digests(docs, PIECE).collect()
    assert all(r.restored for r in digests)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in digests) == Counter(
        (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in want.elements())
    assert sentence_pieces.piece_digests(odd.documents(spark, []), PIECE).collect() == []


def _katz(rows):
    """Scores by the definition, and the model's probability function."""
    def tokens(text):
        return [*odd.words(odd.lower(text)), None]

    one, two, after = Counter(), Counter(), Counter()
    for i, text in rows:
        if odd.is_training(i):
            found = tokens(text)
            before = ["", *found[:-1]]
            one.update(found)
            two.update(zip(before, found))
            after.update(before)
    total, kinds = sum(one.values()), len(one)

    def factors(counts):
        return katz.Discounts.of([sum(c == r for c in counts.values())
                                  for r in range(1, katz.K + 2)]).factors

    f1, f2 = factors(one), factors(two)

    def held(c, f):
        return c * f[c] if c <= katz.K else c

    unknown = 1 - sum(held(c, f1) for c in one.values()) / (total + katz.SPARED)

    def alone(w):
        return held(one[w], f1) / (total + katz.SPARED) if w in one else unknown

    seen, covered = Counter(), Counter()
    for (h, w), c in two.items():
        seen[h] += held(c, f2)
        covered[h] += alone(w)

    def chance(h, w):
        if (h, w) in two:
            return held(two[h, w], f2) / (after[h] + katz.SPARED)
        left = (1 - seen[h] / (after[h] + katz.SPARED)) / (1 - covered[h]) if after[h] else 1.0
        return left * alone(w)

    for h in ["", "\x01", *list(after)[:5]]:
        assert math.isclose(sum(chance(h, w) for w in one) + chance(h, "\x01"), 1.0, abs_tol=1e-9)
    out = []
    for i, text in rows:
        found = tokens(text)
        out.append((i, not odd.is_training(i), len(found), sum(w in one for w in found), total,
                    sum(math.log10((one[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in found),
                    sum(math.log10(chance(h, w)) for h, w in zip(["", *found[:-1]], found))))
    return out


def test_units_give_the_ids_of_whole_texts_and_are_encoded_once(monkeypatch):
    units, pick = piece_scan.Units(PIECE), random.Random(8)
    parts = [" ", "  ", "\n", "\n\n", "\t", "a", "the", "é", "日", "\u2581", "🎉", "\x00", "<s>", "-"]
    for size in (0, 1, 2, 400):
        texts = ["".join(pick.choices(parts, k=pick.randrange(12))) for _ in range(size)]
        assert units.of(pa.array(texts, pa.string())).to_pylist() == units.tool.encode(texts)

    class Counting:
        signs = 0

        def encode(self, text):
            self.signs += len(text)
            return piece_scan.processor(PIECE).encode(text)

    monkeypatch.setattr(units, "tool", Counting())
    units.of(pa.array(["some words of a text\nand a line"] * 1000))
    assert units.tool.signs < 100


def test_digests_take_one_python_step_for_usual_texts(spark):
    plan = sentence_pieces.piece_digests(odd.documents(spark), PIECE)
    usual = plan._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")
    # One for usual texts, one behind the chunks of giant ones.
    assert len(usual) - 1 == 2


def test_the_language_model_keeps_what_its_scores_need_and_reads_texts_once(spark, monkeypatch):
    written = []
    materialise, coded = katz.materialise, katz.coded

    def write(df, name):
        written.append(materialise(df, name))
        return written[-1]

    monkeypatch.setattr(katz, "materialise", write)
    scores = katz.katz_scores(odd.documents(spark), order=3)
    assert len(written) == 3 and scores.count() == len(odd.odd_rows())
    for table in written:
        assert not any(os.path.exists(name.split(":", 1)[-1]) for name in table.inputFiles())
    rows = pa.table({"doc_id": [1, None], "text": ["A b a", None]})
    opened = katz.Opened(coded(rows))
    assert opened.ids.to_pylist() == [1, None] and opened.sizes.tolist() == [4, 1]
    assert opened.word_of[0] == opened.word_of[2] and opened.word_of[3] == opened.word_of[4]


def test_written_tables_leave_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with dropping_shuffles(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


@pytest.mark.parametrize("hot", [1 << 21, 4])
def test_scores_are_those_of_the_definition(spark, monkeypatch, hot):
    monkeypatch.setattr(katz, "HOT", hot)
    rows = [row[:2] for row in odd.odd_rows()]
    rows += [(100 + n, f"{odd.prose(20 + n % 6, 30)} {odd.prose(50 + n, 5)}") for n in range(40)]
    docs = odd.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    got = [tuple(row) for row in katz.katz_scores(docs).collect()]

    def order(row):
        return (row[0] is None, row[0] or 0, row[2], row[6])

    want = sorted(_katz(rows), key=order)
    assert len(got) == len(want)
    for one, other in zip(sorted(got, key=order), want):
        assert one[:5] == other[:5]
        assert math.isclose(one[5], other[5], abs_tol=1e-6)
        assert math.isclose(one[6], other[6], abs_tol=1e-6)


def _katz3(rows):
    """Scores of a trigram model by the definition, probabilities recursive in the history."""
    def tokens(text):
        return ["", *odd.words(odd.lower(text)), None]

    counts, after = [Counter(), Counter(), Counter()], Counter()
    for i, text in rows:
        found = tokens(text)
        for at in range(1, len(found)) if odd.is_training(i) else ():
            for n in range(min(at + 1, 3)):
                gram = tuple(found[at - n:at + 1])
                counts[n][gram] += 1
                after[gram[:-1]] += 1
    total = after[()]
    factors = [katz.Discounts.of([sum(c == r for c in one.values())
                                  for r in range(1, katz.K + 2)]).factors for one in counts]

    def held(gram):
        c, f = counts[len(gram) - 1][gram], factors[len(gram) - 1]
        return c * f[c] if c <= katz.K else c

    unknown = 1 - sum(held(g) for g in counts[0]) / (total + katz.SPARED)
    followed = {}
    for n in (1, 2):
        for gram in counts[n]:
            followed.setdefault(gram[:-1], []).append(gram)

    @functools.cache
    def left(history):
        if not after[history]:
            return 1.0
        rest = 1 - sum(held(g) for g in followed[history]) / (after[history] + katz.SPARED)
        return rest / (1 - sum(chance(history[1:], g[-1]) for g in followed[history]))

    def chance(history, word):
        gram = (*history, word)
        if counts[len(history)][gram]:
            return held(gram) / (after[history] + katz.SPARED)
        return left(history) * chance(history[1:], word) if history else unknown

    for history in [("", "the"), ("the", "the"), *[g for g in list(followed) if len(g) == 2][:5]]:
        assert math.isclose(sum(chance(history, *w) for w in counts[0])
                            + chance(history, "\x01"), 1.0, abs_tol=1e-9)
    out = []
    for i, text in rows:
        found = tokens(text)
        out.append((i, len(found) - 1, sum(math.log10(chance(tuple(found[max(at - 2, 0):at]),
                                                             found[at]))
                                           for at in range(1, len(found)))))
    return out


@pytest.mark.parametrize("hot", [1 << 21, 4])
def test_trigram_scores_are_those_of_the_definition(spark, monkeypatch, hot):
    monkeypatch.setattr(katz, "HOT", hot)
    rows = [row[:2] for row in odd.odd_rows()]
    rows += [(100 + n, f"{odd.prose(20 + n % 6, 30)} {odd.prose(50 + n, 5)}") for n in range(40)]
    # Held out rows with histories that training goes on from otherwise.
    ids = [i for i in range(200, 400) if not odd.is_training(i)][:6]
    rows += [(i, " ".join(sorted(odd.prose(20 + n, 30).split()[:9]) + odd.prose(20 + n, 30).split()[:7]
                          + ["the", "new"])) for n, i in enumerate(ids)]
    docs = odd.documents(spark, [(i, t, "en", "s", 0) for i, t in rows])

    def order(row):
        return (row[0] is None, row[0] or 0, row[1], row[2])

    got = sorted([(r.doc_id, r.n_tokens, r.score) for r in
                  katz.katz_scores(docs, order=3).collect()], key=order)
    want = sorted(_katz3(rows), key=order)
    assert len(got) == len(want)
    for one, other in zip(got, want):
        assert one[:2] == other[:2]
        assert math.isclose(one[2], other[2], abs_tol=1e-6)


def test_scores_of_the_query_see_two_words_back(spark, tmp_path):
    a, b = "p q r", "s q t"
    held = next(i for i in range(1000, 2000) if not odd.is_training(i))
    other = next(i for i in range(held + 1, 2000) if not odd.is_training(i))
    rows = [(i, (a, b)[i % 2], "en", "s", 5) for i in range(100) if odd.is_training(i)]
    rows += [(held, a, "en", "s", 5), (other, "p q t", "en", "s", 5)]
    odd.documents(spark, rows, clashing=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in QUERIES["op2_katz_scores"](spark, str(tmp_path)).collect()}
    assert got[held] > got[other] + 1


def test_scores_of_no_documents(spark):
    assert katz.katz_scores(odd.documents(spark, [])).collect() == []


def test_scores_without_training(spark):
    ids = [i for i in range(200) if not odd.is_training(i)][:3]
    rows = [(i, "a b a", "en", "s", 3) for i in ids]
    for row in katz.katz_scores(odd.documents(spark, rows)).collect():
        assert row.held_out and row.n_known == 0 and row.train_tokens == 0
        assert row.score == 0.0 == row.base_score
