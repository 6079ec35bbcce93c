"""SQL spellings of the text rules for the checking engine.

Its regular expressions have no look-ahead or look-behind and ASCII-only classes, so white
space is listed and look-ahead spacing is done by running the consuming form twice.
"""

from __future__ import annotations

WS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
NS = WS.replace("[", "[^", 1)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sub(s: str, pattern: str, to: str) -> str:
    return f"regexp_replace({s}, {text(pattern)}, {text(to)}, 'g')"


def strip(s: str) -> str:
    return sub(s, f"^{WS}+|{WS}+$", "")


def upper_first(s: str) -> str:
    return f"upper(left({s}, 1)) || substring({s}, 2)"


def sentence_case(s: str, letters: str) -> str:
    marked = f"regexp_replace({s}, {text(f'([.!?]{WS})')}, '\\1' || chr(1), 'g')"
    return (
        f"array_to_string(list_transform(string_split({marked}, chr(1)), "
        f"lambda p: CASE WHEN p <> '' AND contains({text(letters)}, left(p, 1)) "
        f"THEN {upper_first('p')} ELSE p END), '')"
    )


def fix_text(s: str, letters: str) -> str:
    s = sub(s, rf"{WS}+([.,!?;:])", r"\1")
    s = sub(s, rf"([.,!?;:])({NS})", r"\1 \2")
    s = sub(s, f"{WS}+", " ")
    return strip(sentence_case(s, letters))


def spacing(s: str) -> str:
    s = sub(s, rf"{WS}+([.,;:!?])", r"\1")
    for _ in range(2):
        s = sub(s, rf"([.,;:!?])({NS})", r"\1 \2")
    return sub(s, f"{WS}{{2,}}", " ")


def unescape(s: str) -> str:
    """The entities that occur in the provided pages; the ampersand comes last."""
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        s = f"replace({s}, '{entity}', '{char}')"
    return s


def html_text(s: str) -> str:
    blocks = "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}\s*>|\z)" for t in ("script", "style", "template"))
    markup = (
        rf"(?is)<!--.*?(?:-->|\z)|{blocks}|<[!?][^>]*>"
        r"|</?[a-z](?:[^'"
        '">]|"[^"]*"'
        r"|'[^']*')*>"
    )
    marked = f"regexp_replace({s}, {text(markup)}, chr(1), 'g')"
    return strip(unescape(sub(marked, r"\x01+", " ")))


def _first(inner: str) -> str:
    """Upper-case the first character of an expression that is costly to repeat."""
    return f"list_transform([{inner}], lambda t: {upper_first('t')})[1]"


def fix_french(s: str, letters: str) -> str:
    return _first(sentence_case(spacing(strip(unescape(s))), letters))


def fix_spanish(s: str, letters: str) -> str:
    s = sub(spacing(strip(s)), "([?!¡¿]){2,}", r"\1")
    s = _first(sentence_case(s, letters))
    for close, opening in (("?", "¿"), ("!", "¡")):
        s = (
            f"list_transform([{s}], lambda t: CASE WHEN ends_with(t, '{close}') AND NOT "
            f"starts_with(t, '{opening}') THEN '{opening}' || t ELSE t END)[1]"
        )
    return s


def end_phrase(s: str) -> str:
    return (
        f"list_transform([{strip(s)}], lambda t: CASE WHEN regexp_matches(t, '[.!?]$') THEN t "
        r"WHEN regexp_matches(t, '[^\p{L}\p{N}]$') THEN regexp_replace(t, '[^\p{L}\p{N}]+$', '.') "
        "WHEN regexp_matches(t, '[A-Za-z0-9]$') THEN t || '.' ELSE t END)[1]"
    )


def fold(s: str) -> str:
    s = f"replace(replace(replace(lower({s}), '.', ''), '-', ''), '  ', ' ')"
    return f"translate({s}, 'áéíóú', 'aeiou')"


def flags(s: str, keywords: dict[str, list[str]]) -> str:
    """Category labels of an expression, as select items."""
    items = []
    for label, words in keywords.items():
        hits = " OR ".join(f"contains({s}, {text(w)})" for w in words)
        items.append(f"CASE WHEN {hits} THEN 1 ELSE 0 END AS {label}")
    return ", ".join(items)
