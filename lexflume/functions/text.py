"""Text expressions: white space, counts, keywords, cleaning."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Python's white space (str.isspace) as a class that Java, RE2 and Python regexes share.
PY_WS = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: The same characters, for trimming.
PY_SPACES = "".join(chr(c) for c in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
#: The word, number, percentage and flag patterns.
WORD = r"[A-Za-z0-9]+(?:[\-'’][A-Za-z0-9]+)*"
_AMOUNT = r"(?<![A-Za-z0-9_])[+-]?(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"
NUMBER = _AMOUNT + r"(?![A-Za-z0-9_])"
PERCENT = _AMOUNT + r"\s*%"
HTML_LIKE, URL_LIKE, WIDE_SPACE = r"<[^>]+>", r"(?i)https?://|www\.", PY_WS + "{2,}"
#: Currency signs and keyword groups of the default recipe.
CURRENCY = ("$", "€", "£", "¥", "₹", "₽", "₩", "₿")
KEYWORD_GROUPS: dict[str, list[str]] = {
    "crypto_assets": ["bitcoin", "btc", "ethereum", "eth", "crypto", "cryptocurrency"],
    "market_direction": ["rally", "surge", "jump", "gain", "rise", "bullish", "drop", "fall", "plunge", "decline", "bearish"],
    "regulation": ["sec", "regulator", "regulation", "approval", "ban", "lawsuit"],
    "instruments": ["etf", "futures", "options", "spot"],
    "macro": ["inflation", "interest rate", "rate cut", "rate hike", "federal reserve", "fed"],
    "risk_events": ["hack", "exploit", "liquidation", "bankruptcy", "fraud", "default"],
}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python's str.strip()."""
    return F.btrim(as_column(c), F.lit(PY_SPACES))


def filled(c: Column | str) -> Column:
    """Null as '' and stripped."""
    return strip(F.coalesce(as_column(c), F.lit("")))


def nonempty(c: Column | str) -> Column:
    return filled(c) != ""


def collapse_ws(c: Column | str) -> Column:
    return strip(F.regexp_replace(as_column(c), f"{PY_WS}+", " "))


def split_words(c: Column | str) -> Column:
    """Python's str.split()."""
    return F.filter(F.split(as_column(c), f"{PY_WS}+"), lambda x: x != "")


def count(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(as_column(c), F.lit(pattern)).cast("int")


def count_chars(c: Column | str, sign: str) -> Column:
    """Matches of a class of one character, without building an array of them."""
    t = as_column(c)
    return (F.length(t) - F.length(F.regexp_replace(t, f"{sign}+", ""))).cast("int")


def title_like_key(c: Column | str) -> Column:
    """Stripped, lower case, white space collapsed: the key of titles in the audit."""
    return F.lower(collapse_ws(F.coalesce(as_column(c), F.lit(""))))


def combined(*columns: Column | str) -> Column:
    """Non-empty stripped fields joined by one space."""
    return F.array_join(F.filter(F.array(*[filled(c) for c in columns]), lambda x: x != ""), " ")


def content_hash(title: Column | str, text: Column | str) -> Column:
    return F.sha2(F.concat(filled(title), F.lit("\n"), filled(text)), 256)


def keyword_pattern(keyword: str) -> str:
    """Case-insensitive and between ASCII word borders; spaces inside match any run of white space."""
    words = [re.escape(w) for w in keyword.split()]
    return r"(?i)(?<![A-Za-z0-9_])" + r"\s+".join(words) + r"(?![A-Za-z0-9_])"


def keyword_count(c: Column, keywords: Iterable[str]) -> Column:
    """Matches summed over the keywords, so overlapping ones count each on its own.

    Most texts lack most keywords: a plain search in the lower-cased text for the
    first word of each spares them the pattern.
    """
    total, low = F.lit(0), F.lower(c)
    for k in keywords:
        total = total + F.when(F.contains(low, F.lit(k.split()[0].lower())), count(c, keyword_pattern(k))).otherwise(F.lit(0))
    return total.cast("int")


def keyword_hits(c: Column, keywords: Sequence[str]) -> tuple[Column, Column]:
    """(array of the keywords that occur, in the given order; number of matches)."""
    found = F.array_compact(F.array(*[F.when(count(c, keyword_pattern(k)) > 0, F.lit(k)) for k in keywords]))
    return found, keyword_count(c, keywords)


def length_metrics(c: Column | str) -> dict[str, Column]:
    t = filled(c)
    return {
        "is_null": as_column(c).isNull().cast("byte"),
        "is_empty": (t == "").cast("byte"),
        "character_count": F.length(t),
        "word_count": count(t, WORD),
    }


def representation_features(c: Column | str, prefix: str, *, currency: Sequence[str] = CURRENCY, groups: Mapping[str, Sequence[str]] = KEYWORD_GROUPS) -> list[Column]:
    """The explainable counts of one text column that is filled (see filled), prefix__name each; with six groups there are 24."""
    t = as_column(c)
    upper, letters = count_chars(t, "[A-Z]"), count_chars(t, "[A-Za-z]")
    out = {
        "is_empty": (t == "").cast("byte"),
        "character_count": F.length(t),
        "word_count": count(t, WORD),
        "number_count": count(t, NUMBER),
        "percentage_count": count(t, PERCENT),
        "currency_symbol_count": count_chars(t, "[" + re.escape("".join(currency)) + "]"),
        "uppercase_character_count": upper,
        "alphabetic_character_count": letters,
        "uppercase_ratio": F.coalesce(F.try_divide(upper.cast("double"), letters), F.lit(0.0)).cast("float"),
        "question_mark_count": count_chars(t, r"\?"),
        "exclamation_mark_count": count_chars(t, "!"),
    }
    total = F.lit(0)
    for name, keywords in groups.items():
        n = keyword_count(t, keywords)
        out[f"keyword_{slug(name)}_count"] = n
        out[f"keyword_{slug(name)}_present"] = (n > 0).cast("byte")
        total = total + n
    out["financial_keyword_count"] = total.cast("int")
    return [v.alias(f"{prefix}__{k}") for k, v in out.items()]


def literal_pattern(label: str) -> str:
    """A label as a pattern for lower-cased, collapsed text."""
    return re.escape(" ".join(label.casefold().split()))


def file_token(name: object) -> str:
    """A name that any file system takes: other than letters, digits, dots, dashes and underscores becomes one underscore."""
    return re.sub(r"[^A-Za-z0-9._-]+", "_", str(name)).strip("_") or "_"


def slug(name: str) -> str:
    found = re.sub(r"[^a-z0-9]+", "_", name.casefold()).strip("_")
    if not found:
        raise ValueError(f"no feature name can be made from {name!r}")
    return found


# ---------------------------------------------------------------- cleaning that needs Python

#: Comments, tags and URLs in a text.
_COMMENT, _TAG, _SPACES = re.compile(r"<!--.*?-->", re.S), re.compile(r"</?[A-Za-z][^>]*>"), re.compile(r"\s+")
_ZERO_WIDTH = dict.fromkeys((0x200B, 0x200C, 0x200D, 0xFEFF))
_URL = re.compile(r"\b(?:https?://|www\.)[^\s<>\[\]{}\"']+", re.I)


def _mark_url(found: re.Match[str]) -> str:
    whole = found.group(0)
    kept = whole.rstrip(".,;:!?")
    return "<URL>" + whole[len(kept) :]


def clean_one(value: object, replace_urls: bool = True) -> str:
    """Entities, comments, tags, NFKC, zero-width signs, URLs, white space, in this order; case, digits, % and $ stay."""
    if value is None:
        return ""
    t = html.unescape(str(value))
    t = _TAG.sub(" ", _COMMENT.sub(" ", t))
    t = unicodedata.normalize("NFKC", t).translate(_ZERO_WIDTH)
    if replace_urls:
        t = _URL.sub(_mark_url, t)
    return _SPACES.sub(" ", t).strip()


@F.pandas_udf(T.StringType())
def clean_text(texts: pd.Series) -> pd.Series:
    return texts.map(clean_one)


@F.pandas_udf(T.StringType())
def title_key(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: clean_one(x, replace_urls=False).casefold())


@F.pandas_udf(T.StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        return t if t is None or t.isascii() else "".join(ch for ch in unicodedata.normalize("NFKD", t) if not unicodedata.combining(ch))

    return texts.map(one)


def clean_ascii(c: Column | str) -> Column:
    """The part of clean_text that expressions can do: tags, zero-width signs, white space."""
    t = F.regexp_replace(F.coalesce(as_column(c), F.lit("")), r"</?[A-Za-z][^>]*>", " ")
    return collapse_ws(F.regexp_replace(t, r"[\x{200b}\x{200c}\x{200d}\x{feff}]", ""))
