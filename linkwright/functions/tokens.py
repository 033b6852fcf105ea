"""Token and n-gram sets of normalised strings, as arrays without repeats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L


def words(x: Column) -> Column:
    return F.filter(F.split(x, " "), lambda t: t != "")


def _without(x: Column, stop: tuple[str, ...]) -> Column:
    return F.array_distinct(F.filter(F.split(x, " "), lambda t: (F.length(t) > 1) & ~t.isin(*stop)))


def name_tokens(x: Column) -> Column:
    return _without(x, L.NAME_STOPWORDS)


def address_tokens(x: Column) -> Column:
    return _without(x, L.ADDRESS_STOPWORDS)


def numbers(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t.rlike("^[0-9]+$"))


def char_ngrams(x: Column, n: int = 3) -> Column:
    grams = F.transform(F.sequence(F.lit(1), F.length(x) - (n - 1)), lambda i: F.substring(x, i, F.lit(n)))
    none = F.array().cast("array<string>")
    return F.when(x == "", none).when(F.length(x) < n, F.array(x)).otherwise(F.array_distinct(grams))


def significant_tokens(name: Column, address: Column) -> Column:
    """The tokens that blocking indexes, of names and addresses in one namespace."""
    n = F.filter(F.split(name, " "), lambda t: (F.length(t) >= 3) & ~t.isin(*L.COMPANY_WORDS))
    stop = tuple(dict.fromkeys(L.STREET_WORDS + L.COMPANY_WORDS))
    a = F.filter(
        F.split(address, " "),
        lambda t: ((t.rlike("^[0-9]+$") & (F.length(t) >= 2)) | ((F.length(t) >= 4) & ~t.isin(*stop))),
    )
    return F.array_union(n, a)


def padded_ngrams(x: Column, low: int = L.GRAM_MIN, high: int = L.GRAM_MAX) -> Column:
    """All n-grams, with repeats, inside each word with a space on either side; a word shorter than n counts once and for
    the shortest such n only."""

    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        lengths = F.sequence(F.lit(low), F.least(F.lit(high), F.length(padded)))
        return F.flatten(F.transform(lengths, lambda n: F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.substring(padded, i, n))))

    return F.flatten(F.transform(words(x), of_word))
