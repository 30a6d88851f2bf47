import datetime as dt
import random
import re

import pytest
from dateutil import parser
from pyspark.sql import functions as F

from feedloom.functions import dates, requirements as r, text as x, tokens as k


@pytest.mark.parametrize("place, want", [
    ("Umeå", "umeå"), ("Östra Göinge", "östra göinge"), ("Norra-Berg", "norra-berg"),
    ("Visby (hamnen)", "visby"), ("90325 Umeå", "umeå"), ("12-3 Kalix", "kalix"),
    ("Lund 4", "lund"), ("Kiruna (hus 3)", "kiruna"), ("Ystad ()", "ystad"),
    ("no-0150 oslo", "oslo"), ("a12 b3c cork", "cork"), ("centro, sevilla", "sevilla"),
    ("BOX 12, se-90 boden", "boden"), ("åäö9 é-5 x y", "x y"), ("", ""), (None, None),
])
def test_trim_location(values, place, want):
    assert values(x.trim_location, [place]) == [want]


@pytest.mark.parametrize("names, want", [
    (["Bageri Nord AB", "Bageri Nord Luleå AB"], ["bageri nord"]),
    (["Bageri Nord Luleå AB", "AB Bageri Nord"], ["bageri nord"]),
    (["  AB Hus", "Hus AB "], ["hus"]),
    (["Kafé Söder AB", "Torg"], ["torg", "kafé söder"]),
    (["Kafé Söder AB", "Torg", "Torg"], ["torg", "kafé söder"]),
    (["x abc ab y"], ["x abc y"]),
    (["kab hus"], ["khus"]),
    (["", "Torg"], [""]),
    (["bb", "aa"], ["bb", "aa"]),
    (None, []), ([], []),
])
def test_employer_names(values, names, want):
    assert values(x.employer_names, [names], "array<string>") == [want]


def test_label_split(values):
    labels = ["Snickare, timmer m.fl.", "A-lag/ B-lag", "kock och servitris/bagare", "m.fl.", "", None]
    assert values(x.label_split, labels) == [
        ["snickare", "timmer"], ["a-lag", " b-lag"], ["kock", "servitris", "bagare"], [""], [], []]


def test_mask_org_number(values):
    given = ["5561234567", "5501234567", "199001011234", "16556123456", " 55612345 ", "55x1234567",
             "556123", None]
    assert values(x.mask_org_number, given) == [
        "5561234567", None, None, "16556123456", " 55612345 ", None, "556123", None]


def test_nul_is_removed_only_where_it_is_one(values):
    bodies = ['{"a\\u0000b": "x\0y"}', '{"a": "\\\\u0000"}', '{"a": "\\\\\\u0000"}']
    assert values(x.strip_nul_json, bodies) == [
        '{"ab": "xy"}', '{"a": "\\\\u0000"}', '{"a": "\\\\"}']


def test_remote_phrase_may_span_text_and_title(spark):
    rows = spark.createDataFrame([("Vi kan arbeta", "hemifrån nu"), ("x", None), (None, "Remote WORK")],
                                 "d string, t string")
    got = rows.select(x.remote_work(F.col("d"), F.col("t"))).collect()
    assert [g[0] for g in got] == [True, False, True]


def test_epoch_is_shown_in_local_time_in_any_session_zone(spark, values):
    ms = [1570197314846, 1609459200000]
    want = ["2019-10-04T15:55:14", "2021-01-01T01:00:00"]
    assert values(x.epoch_to_local, ms, "bigint") == want
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(x.epoch_to_local, ms, "bigint") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


RUN_DATE = dt.date(2021, 5, 6)


@pytest.mark.parametrize("given, want", [
    ("2020-02-29 23:59:59", "2020-02-29T23:59:59"), ("2020-02-29", "2020-02-29T00:00:00"),
    ("2021-02-29", None), ("Sep 1, 2018 12:00:01 AM", "2018-09-01T00:00:01"),
    ("Dec 31, 2018 12:00:01 PM", "2018-12-31T12:00:01"), ("20190305T", "2019-03-05T00:00:00"),
    ("170305-00:00", "2005-03-17T00:00:00"), ("mar 5", "2021-03-05T00:00:00"),
    ("17", "2021-05-17T00:00:00"), ("10:30:00", "2021-05-06T10:30:00"),
    ("2020-01-02T03:04:05.5", "2020-01-02T03:04:05.500000"),
    ("2099-14-40", None), ("20190101q", None), (" ", None), ("", None), (None, None), ("soon", None),
])
def test_lenient_date(values, given, want):
    assert values(lambda c: dates.lenient_date(c, RUN_DATE), [given]) == [want]


def _general_parser(text):
    try:
        return parser.parse(text, default=dt.datetime.combine(RUN_DATE, dt.time())).isoformat()
    except (ValueError, OverflowError):
        return None


def _date_texts():
    rng = random.Random(7)
    name = lambda of: rng.choice([rng.choice(of), rng.choice(of)[:3]])
    case = lambda text: rng.choice([str.lower, str.upper, str.title, str])(text)
    for _ in range(4000):
        y, m, d = rng.choice([2020, 2021, 1999, 31, "0007"]), rng.randint(0, 13), rng.randint(0, 32)
        month, day = case(name(dates.MONTHS)), case(name(dates.DAYS))
        date = rng.choice([
            f"{y}-{m:02}-{d:02}", f"{y}/{m}/{d}", f"{y}-{m}/{d}", f"{y}{m:02}{d:02}",
            f"{y}{m:02}{d:02}T", f"{d} {month} {y}", f"{d:02}-{month}-{y}", f"{month} {d}, {y}",
            f"{day}, {month} {d} {y}", f"{day} {d} {month} {y}", f"{month} {d}", f"{day} {month} {d}",
            f"{d}", f"{month} {y}", month, day, "", "soon", f"no {month}", f"{d}.{m}.{y}",
            f"{y}-01-02\x01{m}\x0130\x01\x01"])
        h, least = rng.randint(0, 25), rng.choice([30, 59, 61])
        time = rng.choice([
            "", "", f"{h}:{least}", f"{h:02}:{least}:07", f"{h:02}:30:07.{rng.choice(['5', '050', '000', '123456'])}", f"{h}:30 {case('pm')}", f"{h}:30:00{case('am')}", f"{h}:30+01:00", "10:3"])
        yield date + rng.choice([" ", " ", "T", "  "]) * bool(date and time) + time


def test_listed_forms_agree_with_the_general_parser(values):
    """A form decides only how fast a text is read, never what it says."""
    given = sorted(set(_date_texts()))
    want = {text: _general_parser(text) for text in given}
    listed = dict(zip(given, values(lambda c: dates.listed_date(c, RUN_DATE), given)))
    assert {k: v for k, v in listed.items() if v is not None and v != want[k]} == {}
    assert sum(v is not None for v in listed.values()) > len(given) / 6
    nothing = dict(zip(given, values(dates.no_date, given)))
    assert {k: want[k] for k, v in nothing.items() if v and want[k] is not None} == {}
    assert nothing["soon"] and nothing[""]
    assert dict(zip(given, values(lambda c: dates.lenient_date(c, RUN_DATE), given))) == want


@pytest.mark.parametrize("given, want", [
    ("2020-02-29 23:59:59", "2020-02-29T23:59:59"), ("5 March 2021", "2021-03-05T00:00:00"),
    ("Sep 1, 2018 12:00:01 AM", "2018-09-01T00:00:01"), ("20190305T", "2019-03-05T00:00:00"),
    ("Monday, may 3", "2021-05-03T00:00:00"), ("17", "2021-05-17T00:00:00"),
    ("2021/3/5T7:08", "2021-03-05T07:08:00"), ("10:30:00.25", "2021-05-06T10:30:00.250000"),
])
def test_listed_forms_need_no_python(spark, values, given, want):
    assert values(lambda c: dates.listed_date(c, RUN_DATE), [given]) == [want]
    plan = spark.createDataFrame([(given,)], "v string").select(dates.listed_date(F.col("v"), RUN_DATE))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_usual_dates_do_not_see_gaps_of_the_session_zone(spark, values):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Stockholm")
    try:
        listed = lambda c: dates.listed_date(c, RUN_DATE)
        assert values(listed, ["2021-03-28 02:30:00"]) == ["2021-03-28T02:30:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_contacts(spark):
    person = ("fornamn string, efternamn string, befattning string, beskrivning string, epost string, "
              "telefonnummer string, mobilnummer string, fackligRepresentant boolean")
    rows = spark.createDataFrame([
        ("Bo", None, "chef", None, "b@x", None, "07", None),
        (" ", "", None, "d", None, None, None, True),
        ("Eva", "Ek", "hr", None, None, "08, 1", "07", False)], person)
    got = rows.select(F.inline(r.contacts(F.array(F.struct("*"))))).collect()
    assert [tuple(g) for g in got] == [
        ("Bo", None, "b@x", "07", "chef"), (None, "d", None, None, "Facklig representant"),
        ("Eva Ek", None, None, "08, 1, 07", "hr")]


def test_weight_split_is_a_partition(spark):
    rows = spark.createDataFrame([([10, None, 0, 9, 12],), ([],), (None,)], "w array<int>")
    items = F.transform("w", lambda v: F.struct(v.alias("vikt")))
    must, nice = r.weight_split(items)
    got = rows.select(must["vikt"], nice["vikt"]).collect()
    assert [tuple(g) for g in got] == [([10, 12], [None, 0, 9]), ([], []), (None, None)]


def model_standard_words(text):
    """The word rule written as an automaton over characters."""
    out, word = [], ""
    letter, digit = str.isalpha, lambda c: c.isnumeric()
    for i, c in enumerate(text.lower()):
        low = text.lower()
        before, after = (low[i - 1] if i else ""), (low[i + 1] if i + 1 < len(low) else "")
        joins = (before and after and (
            (c in ":·.'’" and letter(before) and letter(after))
            or (c in ",;.'’" and digit(before) and digit(after))))
        if letter(c) or digit(c) or c == "_" or joins:
            word += c
        else:
            out.append(word)
            word = ""
    return [w for w in [*out, word] if re.search(r"[^\W_]", w)]


def test_standard_words_match_the_rule(values):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab1å2_.,:;'’· -\n") for _ in range(60)) for _ in range(200)]
    texts += ["a" * 30_000 + "1b" * 10_000, "k:a 1:e 3,14 don't a.b.c. __ x__y"]
    assert values(k.standard_words, texts) == [model_standard_words(t) for t in texts]


def test_shingles_keep_single_words_and_short_texts(values):
    got = values(k.shingles, [["a", "b", "c"], ["a"], []], "array<string>")
    assert got == [[["a", "a b", "a b c"], ["b", "b c"], ["c"]], [["a"]], []]


def test_grams(values):
    assert values(k.prefix_grams, ["abcd", "ab", "å" * 40])[:2] == [["abc", "abcd"], None]
    assert len(values(k.suffix_grams, ["å" * 40])[0]) == 28
    assert values(k.label_grams, ["abc"]) == [["a", "ab", "abc"]]
