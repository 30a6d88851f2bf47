"""Text expressions. Everything here is built from native functions and stays in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from feedloom import settings

# White space as Unicode text knows it, with the four separators U+001C..U+001F.
SPACE = r"[\s\x1C-\x1F]"
WORD = r"[\p{L}\p{N}_]"


def strip(c: Column) -> Column:
    """Trim white space of any kind from both ends (``trim`` removes only spaces)."""
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def null_if_empty(c: Column) -> Column:
    return F.when(c != "", c)


def null_safe(c: Column, replacement) -> Column:
    return F.coalesce(c, replacement if isinstance(replacement, Column) else F.lit(replacement))


def strip_nul(c: Column) -> Column:
    """Remove NUL characters from a string column."""
    return F.replace(c, F.lit("\0"), F.lit(""))


def strip_nul_json(c: Column) -> Column:
    """Remove raw and escaped NULs from JSON text, in keys and values at any depth."""
    # An escape counts only after an even number of backslashes.
    escaped = F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)\\u0000", "$1")
    return strip_nul(F.when(F.contains(c, F.lit("\\u0000")), escaped).otherwise(c))


def contains_any(text: Column, phrases: list[str]) -> Column:
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(p.lower())) for p in phrases])


def remote_work(description: Column, title: Column, phrases: list[str] | None = None) -> Column:
    """Whether a phrase occurs in "description title"; it may span the joining space."""
    text = F.concat(null_safe(description, ""), F.lit(" "), null_safe(title, ""))
    return contains_any(text, phrases or settings.REMOTE_PHRASES)


def slugify(c: Column) -> Column:
    return null_if_empty(F.translate(F.lower(c), "åäö ", "aao_"))


def words(c: Column) -> Column:
    """White-space separated words, empty ones left out."""
    return F.filter(F.split(c, rf"(?U){SPACE}+"), lambda w: w != "")


# A word of a place name is dropped if its start looks like one of these
# (postal or house number, part before a comma, code with a number, text in brackets).
PLACE_NOISE = "|".join([
    r"[0-9\-]",
    r".+,",
    WORD + r"+-\p{Nd}",
    r"\(",
    r".*\)",
    WORD + r"*\p{Nd}",
])
PLACE_STOPWORDS = ["box"]


def trim_location(c: Column) -> Column:
    kept = F.filter(
        words(F.lower(c)),
        lambda w: ~F.rlike(w, F.lit(f"^(?:{PLACE_NOISE})")) & ~w.isin(PLACE_STOPWORDS))
    return F.array_join(kept, " ")


def company_name(c: Column) -> Column:
    """Lower-cased name without its last " ab" and its first "ab "."""
    name = strip(F.lower(c))
    name = F.regexp_replace(name, r"(?s)^(.*) ab", "$1")
    return F.regexp_replace(name, r"(?s)^(.*?)ab ", "$1")


def shortest_first(names: Column) -> Column:
    """Array of (length, position, name), shortest first; equal lengths keep their order."""
    return F.array_sort(F.transform(names, lambda x, i: F.struct(
        F.length(x).alias("size"), i.alias("at"), x.alias("name"))))


def named(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def employer_names(names: Column) -> Column:
    """The shortest company name and every other one that does not start with it."""
    given = F.filter(null_safe(names, F.array().cast("array<string>")), lambda x: x.isNotNull())

    def kept(ranked: Column) -> Column:
        first = F.get(ranked, F.lit(0))
        others = F.filter(ranked, lambda r: (r["at"] == first["at"]) | (
            (r["name"] != "") & ~F.startswith(r["name"], first["name"])))
        return F.transform(others, lambda r: r["name"])

    return named(shortest_first(F.transform(given, company_name)), kept)


def _cleaned_label(label: Column) -> Column:
    return strip(F.replace(label, F.lit("m.fl."), F.lit("")))


def _label_parts(text: Column) -> Column:
    hyphenated = F.transform(F.split(text, "/"), lambda w: F.lower(w))
    plain = F.transform(F.split(text, "/|, | och "), lambda w: strip(F.lower(w)))
    # Most labels have nothing to be cut at, and looking for that is cheaper than a pattern.
    whole = ~(F.contains(text, F.lit("/")) | F.contains(text, F.lit(", "))
              | F.contains(text, F.lit(" och ")))
    return (F.when(F.contains(text, F.lit("-")), hyphenated)
            .when(whole, F.array(F.lower(text))).otherwise(plain))


def label_split(label: Column) -> Column:
    """Keywords of a taxonomy label. A hyphenated label is cut at slashes only, untrimmed."""
    return F.when(F.length(label) > 0, _label_parts(_cleaned_label(label))).otherwise(
        F.array().cast("array<string>"))


def labels_split(labels: Column) -> Column:
    """Keywords of several labels as one array; each label is cleaned once."""
    cleaned = F.transform(F.filter(labels, lambda x: F.length(x) > 0), _cleaned_label)
    return F.flatten(F.transform(cleaned, _label_parts))


def mask_org_number(c: Column) -> Column:
    """Null for a personal number: a long number whose month digit is below 2 or no digit."""
    digit = F.when(F.length(c) == 12, F.substring(c, 5, 1)).otherwise(F.substring(c, 3, 1))
    personal = (F.length(strip(c)) > 9) & ~F.rlike(digit, F.lit("^[2-9]$"))
    return F.when(~personal, c)


def epoch_to_local(ms: Column, zone: str = settings.LOCAL_ZONE) -> Column:
    """Epoch milliseconds as local ISO text in ``zone``, whatever the session zone is."""
    instant = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(
        secs=(ms / 1000).cast("decimal(18,6)"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), instant)
    # As text: formatting functions would take the time through the session zone.
    return F.replace(F.left(local.cast("string"), F.lit(19)), F.lit(" "), F.lit("T"))
