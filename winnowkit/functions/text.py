"""String functions as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed


#: Unicode's white space.
SPACE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(text: Column) -> Column:
    """Trim Unicode white space, which Spark's own trim leaves unless it is told."""
    return F.trim(text, F.lit(SPACE))


def strip_plain(text: Column) -> Column:
    """``strip`` of a column or a lambda's variable, which is read several times: most texts have a plain sign at either end and stay as they are."""
    plain = lambda c: F.ascii(c).between(0x21, 0x7E)
    return F.when(plain(text) & plain(F.substring(text, -1, 1)), text).otherwise(strip(text))


def once(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def text_or_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit(""))


def squeeze(text: Column) -> Column:
    """Lower-cased, white-space runs made one space: titles are compared in this form."""
    return strip(F.regexp_replace(F.lower(text), r"(?U)[\s&&[^ ]]\s*| \s+", " "))  # all runs but a single space


def tokens(text: Column) -> Column:
    """The set of tokens of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(fixed.TOKEN), F.lit(0)))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two token sets, without repeats; 0 if either is empty."""
    return once(F.size(F.array_intersect(a, b)), lambda both: F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both.cast("double") / (F.size(a) + F.size(b) - both)))


def _canonical_level(word: Column) -> Column:
    out = word
    for synonym, canonical in fixed.LEVEL_SYNONYMS.items():
        out = F.when(word == synonym, canonical).otherwise(out)
    return out


def level_signature(raw_title: Column) -> Column:
    """Level words and numbers of a title in canonical spelling, sorted and joined with plus signs."""
    title = F.lower(F.coalesce(raw_title, F.lit("")))
    words = F.regexp_extract_all(title, F.lit(fixed.LEVEL_WORD), F.lit(0))
    words = F.transform(words, _canonical_level)
    numbers = F.transform(
        F.regexp_extract_all(title, F.lit(fixed.LEVEL_NUMBER), F.lit(1)), lambda n: F.replace(n, F.lit("_"), F.lit("."))
    )
    return F.array_join(F.array_sort(F.array_union(words, numbers)), "+")


def folded(text: Column) -> Column:
    """The text in lower case, with the letters that case-insensitive matching takes for ``i`` and ``s``, of which ASCII has none."""
    return F.lower(F.when(F.octet_length(text) == F.length(text), text).otherwise(F.translate(text, "\u0130\u0131\u017f", "iis")))


def says(text: Column, pattern: str) -> Column:
    """Whether the pattern, which is in lower case, is found in a folded text; false for null."""
    return F.coalesce(F.rlike(text, F.lit(by_first_letter(pattern))), F.lit(False))


def by_first_letter(pattern: str) -> str:
    """A pattern that is found in the same texts, with the alternatives of each first letter together: fewer are tried at a place of a text."""
    alternatives, depth, at = [""], 0, 0
    while at < len(pattern):
        sign = pattern[at : at + 2] if pattern[at] == "\\" else pattern[at]
        depth += (sign == "(") - (sign == ")")
        if sign == "|" and not depth:
            alternatives.append("")
        else:
            alternatives[-1] += sign
        at += len(sign)
    if "[" in pattern or "" in alternatives:
        return pattern
    groups: dict[str, list[str]] = {}
    for a in alternatives:
        head = re.match(r"(?:\\b)?[a-z](?![?*+{])", a)
        groups.setdefault(head[0] if head else a, []).append(a[head.end() :] if head else "")
    return "|".join(head + (f"(?:{'|'.join(rest)})" if len(rest) > 1 else rest[0]) for head, rest in groups.items())


def html_escape(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    for char, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def url_quote(text: Column) -> Column:
    """Form encoding in which only letters, digits and ``_.-~`` stay, and a space is a plus."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 0))
