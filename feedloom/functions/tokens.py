"""Token arrays of a text column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from feedloom import settings
from feedloom.functions.text import words

# The Swedish stop list of the Snowball project.
SWEDISH_STOPWORDS = """
och det att i en jag hon som han på den med var sig för så till är men ett om hade de av icke
mig du henne då sin nu har inte hans honom skulle hennes där min man ej vid kunde något från ut
när efter upp vi dem vara vad över än dig kan sina här ha mot alla under någon eller allt
mycket sedan ju denna själv detta åt utan varit hur ingen mitt ni bli blev oss din dessa några
deras blir mina samma vilken er sådan vår blivit dess inom mellan sådant varför varje vilka
ditt vem vilket sitta sådana vart dina vars vårt våra ert era vilkas
""".split()


def char_normalise(c: Column) -> Column:
    """Drop ``. : !`` and turn a comma or no-break space into a space."""
    spaces = settings.TOKEN_SPACE_CHARS
    return F.translate(c, spaces + settings.TOKEN_DROP_CHARS, " " * len(spaces))


def simple_words(c: Column) -> Column:
    return words(F.lower(char_normalise(c)))


def _grams(word: Column, sizes: tuple[int, int], cut) -> Column:
    least, most = sizes
    lengths = F.sequence(F.lit(least), F.least(F.lit(most), F.length(word)))
    return F.when(F.length(word) >= least, F.transform(lengths, lambda k: cut(word, k)))


def prefix_grams(word: Column, sizes: tuple[int, int] = settings.WORD_GRAMS) -> Column:
    return _grams(word, sizes, F.left)


def suffix_grams(word: Column, sizes: tuple[int, int] = settings.WORD_GRAMS) -> Column:
    return _grams(word, sizes, F.right)


# Characters that join two letters, two digits, or either, inside a word (Unicode word rules).
JOINS_LETTERS = ":·"
JOINS_DIGITS = ",;"
JOINS_BOTH = ".'’"
# Anything else that is not part of a word separates.
SEPARATOR = (
    rf"(?!(?<=\p{{L}}\p{{M}}?)[{JOINS_LETTERS}{JOINS_BOTH}](?=\p{{L}}))"
    rf"(?!(?<=\p{{N}})[{JOINS_DIGITS}{JOINS_BOTH}](?=\p{{N}}))"
    r"[^\p{L}\p{M}\p{N}_]"
)


def standard_words(c: Column) -> Column:
    """Words by the Unicode rules, lower case; a word needs a letter or digit.

    Separators are replaced one by one and the text is cut at blanks: no part of the pattern
    repeats, so long runs cost linear time and no stack.
    """
    cut = F.split(F.regexp_replace(F.lower(c), SEPARATOR, " "), " +")
    return F.filter(cut, lambda w: F.rlike(w, F.lit(r"[\p{L}\p{N}]")))


def is_stopword(word: Column) -> Column:
    return word.isin(SWEDISH_STOPWORDS)


def shingles(tokens: Column) -> Column:
    """Per position the word, then the 2- and 3-word shingles that start there."""
    longest = max(settings.SHINGLE_SIZES)
    shifted = [F.slice(tokens, F.lit(k + 1), F.size(tokens)) for k in range(longest)]
    starts = F.arrays_zip(*shifted)

    def at(start):
        sizes = [1, *range(settings.SHINGLE_SIZES[0], longest + 1)]
        joined = lambda n: F.concat(*[
            part for k in range(n) for part in ([F.lit(" ")] if k else []) + [start[str(k)]]])
        return F.array_compact(F.array(*[joined(n) for n in sizes]))

    return F.transform(starts, at)


def label_words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def label_grams(word: Column) -> Column:
    return prefix_grams(word, settings.LABEL_GRAMS)
