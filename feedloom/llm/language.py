"""Language identification: text, declared language, address suffix and host, fused by Bayes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.chunks import releasing
from feedloom.operators.joins import lookup_join, small_side
from feedloom.session import materialise

#: Labelled rows that the text model learns from, about; they are chosen by a hash.
TRAINING_ROWS = 4000
#: Buckets of byte trigrams, and what is added to each count.
BUCKETS, ADDED = 1 << 14, 0.1
#: Share of trigrams in any text that belong to no language: codes, addresses, names.
NOISE = 0.2
#: Trigrams overlap, so each counts as this share of an independent observation.
TEMPER = 0.4
#: Rows that a level of the host hierarchy counts as, towards the level below it.
STRENGTH = 5.0
#: Rows of a language counted beforehand as declaring it, and as declaring each other thing.
DECLARED_RIGHT, DECLARED_ADDED = 5.0, 0.5
#: The class of texts that read like none of the known languages.
UNKNOWN = "und"
#: Bytes looked up at once.
STRETCH = 1 << 20

# Everything in ASCII but letters counts as a blank.
BLANKED = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the letters of a text, in lower case."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(BLANKED) + b" ",
                        dtype=np.uint8)
    raw = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])].astype(np.int32)
    if len(raw) < 3:
        return raw[:0]
    return (raw[:-2] * 961 + raw[1:-1] * 31 + raw[2:] * 7919) & (BUCKETS - 1)


@dataclass(frozen=True)
class TextModel:
    """Log probabilities of trigram buckets, a column per class; the last class is ``UNKNOWN``."""

    classes: list[str]
    table: np.ndarray

    def log_likelihood(self, text: str) -> np.ndarray:
        found = trigrams(text)
        total = np.zeros(len(self.classes))
        for start in range(0, len(found), STRETCH):
            total += self.table.take(found[start:start + STRETCH], axis=0).sum(axis=0)
        return total * TEMPER


def train(labelled: DataFrame) -> TextModel:
    """A multinomial text model from rows ``(text, lang)``.

    About ``TRAINING_ROWS`` rows are used, chosen by a hash of text and label, so that the sample
    does not depend on their order; the counts that reach the driver have ``BUCKETS`` rows a
    language at most. Rows without a label or text are left out.
    """
    rows = labelled.select(F.lower(F.trim("lang")).alias("lang"), F.col("text").cast("string")) \
        .where("lang <> '' and text <> ''")
    total = rows.count()
    if total > TRAINING_ROWS:
        share = int(TRAINING_ROWS / total * (1 << 30))
        rows = rows.where(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < share)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                times = np.bincount(trigrams(text), minlength=BUCKETS)
                held[lang] = held.get(lang, 0) + times
        for lang, times in held.items():
            at = np.flatnonzero(times)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": times[at]})

    counted = rows.mapInPandas(count, "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    table = np.full((BUCKETS, len(langs) + 1), ADDED)
    for at, lang in enumerate(langs):
        mine = counted[counted["lang"] == lang]
        table[mine["bucket"].to_numpy(), at] += mine["n"].to_numpy()
    table[:, -1] = 1.0
    shares = table / table.sum(axis=0) * (1 - NOISE) + NOISE / BUCKETS
    return TextModel([*langs, UNKNOWN], np.log(shares))


def normalised(weights: Column) -> Column:
    """Weights as shares of their sum."""
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    return F.transform(weights, lambda w: w / total)


def times(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a * b)


def smoothed(counts: Column, prior: Column, strength: float = STRENGTH) -> Column:
    """Shares of a level, drawn towards those of the level above it."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, prior, lambda n, p: (n + p * strength) / (total + strength))


def summed(column: str, size: int) -> Column:
    return F.array(*[F.sum(F.col(column)[i]) for i in range(size)])


def identify(rows: DataFrame, model: TextModel, id_col: str) -> DataFrame:
    """Languages of ``rows``: the id, ``text``, ``declared``, ``suffix``, ``domain`` and ``host``.

    Gives per row the id, ``host``, ``declared`` (a primary subtag), ``text_lang``, ``lang`` and
    ``probability``. The posterior of a class is its share of

        P(text | class) * P(declared | class) * P(class | host without this row)

    where the host's shares are smoothed towards its domain's, those towards its suffix's and
    those towards all rows'; the counts are sums of what text and declaration make of each row.
    ``lang`` is ``UNKNOWN`` for a text that reads like no known language. A null or empty text
    says nothing, nor does a null or empty declaration; null address parts form one host of their
    own. Ties go to the first class by name, repeated rows are judged each, no rows give no rows.
    """
    size = len(model.classes)
    known = F.array(*[F.lit(c) for c in model.classes])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.log_likelihood(text or "").tolist()
                     for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns - 1)],
                 pa.array(found, pa.list_(pa.float64()))],
                names=[*batch.schema.names[:-1], "seen"])

    subtag = F.regexp_extract(F.lower(F.trim(F.coalesce("declared", F.lit("")))), "^[a-z]+", 0)
    source = rows.select(
        F.col(id_col), subtag.alias("declared"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("suffix", "domain", "host")],
        F.col("text").cast("string").alias("text"))
    kind = source.schema[id_col].dataType.simpleString()
    seen = source.mapInArrow(releasing(read), f"`{id_col}` {kind}, declared string, suffix string, "
                                   "domain string, host string, seen array<double>")
    best = F.array_max("seen")
    text_share = normalised(F.transform("seen", lambda v: F.exp(v - best)))
    # Languages that nobody learnt count as one kind of declaration.
    said = F.when(F.col("declared") == "", "").when(
        F.array_contains(known, F.col("declared")), F.col("declared")).otherwise("other")
    first = materialise(seen.select("*", text_share.alias("by_text"), said.alias("said"))
                        .drop("seen"), "by-text")

    # P(declared | class): a row for each declaration, as many as there are classes.
    stated = {row["said"]: row["n"] for row in first.where("said <> ''").groupBy("said").agg(
        summed("by_text", size).alias("n")).collect()}
    kinds = [*model.classes[:-1], "other"]
    table = np.array([stated.get(k, [0.0] * size) for k in kinds]) + DECLARED_ADDED
    table[:-1, :-1] += DECLARED_RIGHT * np.eye(size - 1)
    table = table / table.sum(axis=0)
    evidence = F.array(*[F.lit(1.0)] * size)
    for kind_, row in zip(kinds, table.tolist()):
        evidence = F.when(F.col("said") == kind_, F.array(*[F.lit(v) for v in row])) \
            .otherwise(evidence)
    judged = first.withColumn("own", normalised(times(F.col("by_text"), evidence)))

    place = ["suffix", "domain", "host"]
    hosts = materialise(judged.groupBy(*place).agg(summed("own", size).alias("n")), "hosts")
    everything = hosts.agg(summed("n", size).alias("n")).first()["n"]
    everything = [(n or 0.0) + 1.0 for n in everything]
    total = sum(everything)
    base = F.array(*[F.lit(n / total) for n in everything])
    suffixes = materialise(hosts.groupBy("suffix").agg(summed("n", size).alias("m")).select(
        "suffix", smoothed(F.col("m"), base).alias("above")), "suffixes")
    domains = lookup_join(hosts.groupBy("suffix", "domain").agg(summed("n", size).alias("m")),
                          suffixes, "suffix", "inner")
    domains = materialise(domains.select(
        "suffix", "domain", smoothed(F.col("m"), F.col("above")).alias("above")), "domains")
    priors = materialise(lookup_join(hosts, domains, ["suffix", "domain"], "inner"), "priors")

    with_prior = lookup_join(judged, priors, place, "inner")
    others = F.zip_with("n", "own", lambda n, o: F.greatest(n - o, F.lit(0.0)))
    shares = normalised(times(F.col("own"), smoothed(others, F.col("above"))))
    out = with_prior.select(
        id_col, "host", "declared",
        F.element_at(known, F.array_position("by_text", F.array_max("by_text")).cast("int"))
        .alias("text_lang"), shares.alias("shares"))
    return out.select(
        id_col, "host", "declared", "text_lang",
        F.element_at(known, F.array_position("shares", F.array_max("shares")).cast("int"))
        .alias("lang"), F.array_max("shares").alias("probability"))


# Second-level labels under which countries register names.
SECOND_LEVEL = ["co", "com", "org", "net", "ac", "gov", "edu"]


def page_rows(pages: DataFrame) -> DataFrame:
    """Rows for ``identify`` from ``pages`` (page_id, url, html): the text between the tags, the
    language of the html tag, and host, registered domain and last label of the address."""
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    labels = F.split("host", r"\.")
    second = F.element_at(labels, -2)
    deep = (F.size(labels) > 2) & second.isin(SECOND_LEVEL) & \
        (F.length(F.element_at(labels, -1)) == 2)
    keep = F.when(deep, 3).otherwise(2)
    last = F.slice(labels, F.greatest(F.size(labels) - keep + 1, F.lit(1)), keep)
    return pages.select(
        "page_id", text.alias("text"), host.alias("host"),
        F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]+)", 1)
        .alias("declared")).select(
            "*", F.concat_ws(".", last).alias("domain"),
            F.element_at(labels, -1).alias("suffix"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Rows for ``identify`` from ``documents``: the source stands for the host."""
    return docs.select("doc_id", "text", F.col("lang").alias("declared"),
                       F.lit("").alias("suffix"), F.lit("").alias("domain"),
                       F.col("source").alias("host"))


def keep_identified(docs: DataFrame, labelled: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is known with a probability of ``least`` or more.

    Rows are told apart by id and text; a row without an id is judged as any other.
    """
    key = F.xxhash64("doc_id", F.col("text").cast("string"))
    keyed = document_rows(docs).withColumn("key", F.xxhash64("doc_id", F.col("text").cast("string")))
    found = identify(keyed.drop("doc_id"), train(labelled), "key")
    # A row whose twin from another source is rejected goes with it.
    bad = materialise(found.where((F.col("lang") == UNKNOWN) | (F.col("probability") < least))
                      .select(F.col("key").alias("bad_key")).distinct(), "rejected")
    return docs.join(small_side(bad), key == F.col("bad_key"), "left_anti")
