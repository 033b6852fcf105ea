"""Normalisation of names, addresses and countries as Column expressions; no Python runs on executors."""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon as L

#: White space of ASCII text, separators 0x1C to 0x1F included.
_SPACE = r"[\t-\r\x1c-\x20]"


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Of all characters: those that compatibility decomposition turns into one ASCII character, with it, and
    those that it turns into several. All other non-ASCII characters leave nothing."""
    one, several = {}, {}
    for i in range(0x80, sys.maxunicode + 1):
        if 0xAC00 <= i < 0xE000 or not unicodedata.decomposition(c := chr(i)):
            continue
        ascii_part = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if ascii_part:
            (one if len(ascii_part) == 1 else several)[c] = ascii_part
    return "".join(one), "".join(one.values()), several


_ONE_FROM, _ONE_TO, _SEVERAL = _fold_tables()


def ascii_fold(x: Column) -> Column:
    """Compatibility decomposition, of which only ASCII stays. Decomposition works on each character by itself, so it is
    a translation; the characters that become several are looked up only in the rows that have them."""
    x = F.coalesce(x, F.lit(""))
    drop = lambda s: F.regexp_replace(s, r"[^\x00-\x7F]", "")
    keys, values = F.array(*[F.lit(c) for c in _SEVERAL]), F.array(*[F.lit(v) for v in _SEVERAL.values()])
    spelled = F.array_join(F.transform(F.split(x, ""), lambda c: F.coalesce(F.element_at(F.map_from_arrays(keys, values), c), c)), "")
    some = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in _SEVERAL) + "]"
    fold = lambda s: drop(F.translate(s, _ONE_FROM, _ONE_TO))
    return F.when(~x.rlike(r"[^\x00-\x7F]"), x).when(x.rlike(some), fold(spelled)).otherwise(fold(x))


def _squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, _SPACE + "+", " "))


def normalize_text(x: Column) -> Column:
    x = F.lower(ascii_fold(x))
    x = F.replace(x, F.lit("&"), F.lit(" and "))
    x = F.translate(x, "@", "a")
    x = F.regexp_replace(x, r"'s\b", "")
    x = F.regexp_replace(x, r"[^0-9A-Za-z_\t-\r\x1c-\x20-]", " ")
    return _squeeze(x)


def normalize_name(x: Column) -> Column:
    """Domains survive as words, since their dot has become a space before any rule could see it."""
    x = F.regexp_replace(normalize_text(x), L.TRADE_MARKERS, "")
    x = reduce(lambda s, form: F.regexp_replace(s, form, ""), L.LEGAL_FORMS, x)
    return _squeeze(F.regexp_replace(x, "^[ -]+|[ -]+$", ""))


def normalize_address(x: Column) -> Column:
    x = F.regexp_replace(normalize_text(x), r"\b0+(\d+)\b", "$1")
    longer = F.create_map(*[F.lit(s) for pair in L.ADDRESS_ABBREVIATIONS.items() for s in pair])
    x = F.array_join(F.transform(F.split(x, " "), lambda t: F.coalesce(F.element_at(longer, t), t)), " ")
    return _squeeze(F.regexp_replace(x, L.UNIT, ""))


def normalize_country(x: Column) -> Column:
    """Trimmed and lower-cased; its letters stay as they are."""
    return F.lower(F.trim(F.coalesce(x, F.lit(""))))
