"""Text repair, validation and labelling as native Spark expressions."""

from __future__ import annotations

from functools import reduce
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from citylake.functions.base import NON_SPACE, SPACE, as_col, let, strip

# Lower-case letters that open a sentence, per language.
ITALIAN_SPANISH_LETTERS = "abcdefghijklmnopqrstuvwxyzáéíóúñ"
FRENCH_LETTERS = "abcdefghijklmnopqrstuvwxyzàâçéèêëîïôûùüÿñæœ"

# Weekday letters, and host names reserved for special use.
WEEKDAYS = ["L", "M", "X", "J", "V", "S", "D"]
RESERVED_TLDS = ["arpa", "invalid", "local", "localhost", "onion", "test"]

# English month names and their days outside leap years.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
]
MONTH_DAYS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]

# Matches only from the start of a run, so a long run is scanned once. The look-behind comes after
# the first space, where it is tried far less often.
SPACE_BEFORE_MARK = rf"(?U){SPACE}(?<!{SPACE}{{2}}){SPACE}*+([.,;:!?])"

# Noncharacter that stands for one piece of markup while text nodes are joined.
MARK = "\uffff"

MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
    r"|<[!?][^>]*>"
    r"|</?[a-z](?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>"
)

DATE = r"(?U)\b([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{2,4})\b"

URL = (
    r"(?i)^(?:https?|ftps?|sftp|ssh|git|rtmps?|rtsps?|telnet)://"
    r"(?:[^\s/?#@]+@)?"
    r"(?:localhost|\[[0-9a-f:.]+\]|(?:[0-9]{1,3}\.){3}[0-9]{1,3}"
    r"|(?:[\p{L}\p{N}](?:[\p{L}\p{N}_-]{0,61}[\p{L}\p{N}])?\.)+(?:\p{L}{2,63}|xn--[a-z0-9-]{1,59}))"
    r"(?::[0-9]{1,5})?(?:[/?#]\S*)?$"
)

MAIL = (
    r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~\x{80}-\x{10ffff}-]+"
    r"(?:\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~\x{80}-\x{10ffff}-]+)*"
    r"@(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?\.)+(\p{L}{2,63}|xn--[a-z0-9-]{1,59})$"
)


def unescape(c: Column | str) -> Column:
    """Decode HTML entities. Only rows with an ampersand travel to Python."""

    # Nested so that it ships to executors by value, without this package installed there.
    def entities(text: pd.Series) -> pd.Series:
        from html import unescape as decode

        return text.map(decode, na_action="ignore")

    c = as_col(c)
    decoded = F.pandas_udf(entities, StringType())
    return F.coalesce(decoded(F.when(c.contains("&"), c)), c)


def sentence_case(c: Column | str, letters: str) -> Column:
    """Upper-case a letter of ``letters`` at the start and after ``.!?`` plus one space."""
    pieces = F.split(as_col(c), rf"(?U)(?<=[.!?]{SPACE})")
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(F.contains(F.lit(letters), p.substr(1, 1)), upper_first(p)).otherwise(p),
        ),
        "",
    )


def upper_first(c: Column | str) -> Column:
    return let(
        as_col(c),
        lambda s: F.concat(F.upper(s.substr(1, 1)), F.substring(s, F.lit(2), F.length(s))),
    )


def fix_text(c: Column | str) -> Column:
    """Spacing around punctuation, sentence case, single spaces."""
    s = F.regexp_replace(as_col(c), SPACE_BEFORE_MARK, "$1")
    s = F.regexp_replace(s, rf"(?U)([.,!?;:])({NON_SPACE})", "$1 $2")
    s = F.regexp_replace(s, rf"(?U){SPACE}+", " ")
    return strip(sentence_case(s, ITALIAN_SPANISH_LETTERS))


def _romance_spacing(s: Column) -> Column:
    s = F.regexp_replace(s, SPACE_BEFORE_MARK, "$1")
    s = F.regexp_replace(s, rf"(?U)([.,;:!?])(?={NON_SPACE})", "$1 ")
    return F.regexp_replace(s, rf"(?U){SPACE}{{2,}}", " ")


def fix_french(c: Column | str) -> Column:
    s = _romance_spacing(strip(unescape(c)))
    return upper_first(sentence_case(s, FRENCH_LETTERS))


def fix_spanish(c: Column | str) -> Column:
    s = _romance_spacing(strip(c))
    s = F.regexp_replace(s, r"([?!¡¿]){2,}", "$1")
    s = upper_first(sentence_case(s, ITALIAN_SPANISH_LETTERS))
    return _open_mark(_open_mark(s, "?", "¿"), "!", "¡")


def _open_mark(text: Column, close: str, opening: str) -> Column:
    return let(
        text,
        lambda s: F.when(
            F.endswith(s, F.lit(close)) & ~F.startswith(s, F.lit(opening)),
            F.concat(F.lit(opening), s),
        ).otherwise(s),
    )


def end_phrase(c: Column | str) -> Column:
    """End the text with a full stop unless it already ends in ``.!?``."""

    def close(s: Column) -> Column:
        last = F.right(s, F.lit(1))
        return (
            F.when(last.isin(".", "!", "?"), s)
            .when(last.rlike(r"^[^\p{L}\p{N}]$"), F.regexp_replace(s, r"[^\p{L}\p{N}]++\z", "."))
            .when(last.rlike("^[A-Za-z0-9]$"), F.concat(s, F.lit(".")))
            .otherwise(s)
        )

    return let(strip(c), close)


def _spell(match: Column) -> Column:
    """``d/m/y`` in words if it is a real date, else as it was.

    Plain arithmetic: a date parser signals every bad date by an exception.
    """
    part = F.split(match, "[/-]")
    numbers = F.transform(part, lambda p: p.try_cast("int"))

    def spelled(n: Column) -> Column:
        day, month, year = (F.get(n, F.lit(i)) for i in range(3))
        year = F.when(year < 100, year + 2000).otherwise(year)
        leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
        days = F.get(F.array(*[F.lit(d) for d in MONTH_DAYS]), month - 1)
        days = days + F.when((month == 2) & leap, 1).otherwise(0)
        name = F.get(F.array(*[F.lit(m) for m in MONTHS]), month - 1)
        return F.when(day.between(1, days), F.concat_ws(" ", day, name, year)).otherwise(match)

    return let(numbers, spelled)


def spell_dates(c: Column | str) -> Column:
    """Rewrite each valid ``d/m/y`` or ``d-m-y`` in place as ``1 February 2025``."""

    def rewrite(s: Column) -> Column:
        between = F.split(s, DATE, -1)
        spelled = F.transform(F.regexp_extract_all(s, F.lit(DATE), F.lit(0)), _spell)
        glued = F.zip_with(between, spelled, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.when(s.rlike("[0-9][/-][0-9]"), F.array_join(glued, "")).otherwise(s)

    return let(as_col(c), rewrite)


def extract_mails(c: Column | str) -> Column:
    """Mail-shaped tokens joined by ``; ``; null when there is none."""
    c = as_col(c)
    tokens = F.split(c, r"(?U)[;,\s\x1c-\x1f\-]+")
    mails = F.filter(tokens, lambda t: t.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"))
    return F.when(c.contains("@"), F.nullif(F.array_join(mails, "; "), F.lit("")))


def slash_to_null(c: Column | str) -> Column:
    return let(as_col(c), lambda s: F.when(strip(s) != "/", s))


def html_text(c: Column | str) -> Column:
    """Text nodes of an HTML fragment joined by one space and stripped."""
    marked = F.regexp_replace(as_col(c), MARKUP, MARK)
    return strip(unescape(F.regexp_replace(marked, f"{MARK}+", " ")))


def valid_url(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(c.rlike(URL), c)


def valid_mail(c: Column | str) -> Column:
    """Syntax check: dotted local part of at most 64 characters, public-looking domain."""
    c = as_col(c)
    local = F.substring_index(c, "@", 1)
    top = F.lower(F.substring_index(c, ".", -1))
    ok = c.rlike(MAIL) & (F.length(c) <= 254) & (F.length(local) <= 64) & ~top.isin(RESERVED_TLDS)
    return F.when(ok, c)


def clean_weekdays(c: Column | str) -> Column:
    """Keep the weekday letters of a list, in order; null when none is left."""
    days = F.transform(F.split(as_col(c), "[; ,]"), lambda d: F.upper(strip(d)))
    kept = F.filter(days, lambda d: d.isin(WEEKDAYS))
    return F.nullif(F.array_join(kept, ","), F.lit(""))


def fold_text(c: Column | str) -> Column:
    """Lower-case, drop dots and hyphens, halve double spaces, fold acute vowels."""
    s = F.translate(F.lower(as_col(c)), ".-", "")
    s = F.replace(s, F.lit("  "), F.lit(" "))
    return F.translate(s, "áéíóú", "aeiou")


def clean_line(c: Column | str) -> Column:
    s = F.replace(as_col(c), F.lit('"'), F.lit(""))
    s = F.replace(s, F.lit("&amp;"), F.lit("&"))
    return F.replace(s, F.lit("&Ntilde;"), F.lit("ñ"))


def sha256(c: Column | str, empty_is_null: bool = True) -> Column:
    c = as_col(c)
    digest = F.sha2(c, 256)
    return F.when(c != "", digest) if empty_is_null else digest


def hash_array(c: Column | str) -> Column:
    return F.transform(as_col(c), lambda x: F.sha2(x, 256))


def norm(c: Column | str, collapse: bool = False) -> Column:
    s = F.lower(F.trim(as_col(c)))
    return F.regexp_replace(s, r"\s+", " ") if collapse else s


def map_values(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Replace the given values, keep all others."""
    c = as_col(c)
    out = None
    for old, new in mapping.items():
        out = F.when(c == old, new) if out is None else out.when(c == old, new)
    return c if out is None else out.otherwise(c)


def any_keyword(text: Column, words: Sequence[str]) -> Column:
    """Whether any word is a substring. The text is used once a word: hand in a column, not a costly expression."""
    return reduce(lambda found, word: found | text.contains(word), words, F.lit(False))


def decode_text(content: Column | str) -> Column:
    """Bytes to text: UTF-8 when valid, else ISO-8859-1."""
    content = as_col(content)
    text = content.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.decode(content, "ISO-8859-1"))

