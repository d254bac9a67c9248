"""Text cleaning as Column functions.

Each takes a string Column and returns one; null stays null and what cleans to
the empty string becomes null. ``python_oracles`` has plain equivalents that
the tests hold the Columns against.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's $ also matches before a final line break, so ends are written \z.
# Characters dropped at the ends, and what counts as white space.
BOM_CHARS = "﻿​‌‍￾"
WHITE = r"[\s\p{Z}\x0b\x85\x1c-\x1f]"


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_bom(c: Column) -> Column:
    """Without byte-order marks and zero-width characters at either end."""
    return empty_to_null(F.regexp_replace(c, f"^[{BOM_CHARS}]+|[{BOM_CHARS}]+\\z", ""))


def strip_white(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITE}+|{WHITE}+\\z", "")


def squash(c: Column) -> Column:
    """White space runs become one space, ends are trimmed."""
    return F.btrim(F.regexp_replace(c, f"{WHITE}+", " "))


def sanitize_string(c: Column) -> Column:
    return empty_to_null(squash(strip_bom(c)))


def sanitize_name(c: Column) -> Column:
    """As sanitize_string, carriage returns removed first."""
    return empty_to_null(squash(F.replace(strip_bom(c), F.lit("\r"), F.lit(""))))


def sanitize_title(c: Column) -> Column:
    """As sanitize_name, with en and em dashes as hyphens."""
    return empty_to_null(squash(F.translate(strip_bom(c), "\n–—\r", " --")))


def sanitize_content(c: Column) -> Column:
    """Lines squashed one by one, empty lines dropped, joined by line feeds."""
    lines = F.split(F.translate(strip_bom(c), "\r\0", ""), "\n", -1)
    return empty_to_null(F.array_join(F.filter(F.transform(lines, squash), lambda x: x != ""), "\n"))


def sanitize_url(c: Column) -> Column:
    return empty_to_null(F.translate(strip_white(strip_bom(c)), "\r\n\t", ""))


def flatten_string(c: Column) -> Column:
    """One line for a log: line breaks and tabs as spaces, runs squashed."""
    return F.coalesce(sanitize_string(c), F.lit(""))


def fold_accents(c: Column) -> Column:
    """Latin letters without their marks; ligatures and stroked letters stay."""
    plain, marked = accent_pairs()
    return F.translate(c, marked, plain)


def accent_pairs() -> tuple[str, str]:
    """(plain, marked) letters of the Latin blocks whose decomposition starts with ASCII."""
    import unicodedata

    pairs = []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = unicodedata.normalize("NFD", chr(cp))
        if len(parts) > 1 and parts[0].isascii():
            pairs.append((parts[0], chr(cp)))
    return "".join(p for p, _ in pairs), "".join(m for _, m in pairs)


#: Letters without a decomposition, and what they are read as.
STROKED = {
    "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H", "ı": "i", "ŧ": "t", "Ŧ": "T",
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "TH",
}
#: Characters read as an apostrophe.
APOSTROPHES = "’‘ʼʹ`´′＇"


def compatible_pairs() -> tuple[str, str]:
    """(plain, other): characters whose compatibility form, marks dropped, is one other character."""
    import unicodedata

    pairs = []
    for cp in [*range(0xA0, 0x530), *range(0x1E00, 0x2000), *range(0x2070, 0x20A0), *range(0x2460, 0x2500), *range(0xFF01, 0xFF5F)]:
        whole = unicodedata.normalize("NFKD", chr(cp))
        base = [x for x in whole if not unicodedata.combining(x)]
        if whole != chr(cp) and len(base) == 1 and base[0] != " ":
            pairs.append((base[0], chr(cp)))
    return "".join(p for p, _ in pairs), "".join(m for _, m in pairs)


def _spelt_out(c: Column) -> Column:
    for letter, plain in STROKED.items():
        if len(plain) > 1:
            c = F.replace(c, F.lit(letter), F.lit(plain))
    single = {k: v for k, v in STROKED.items() if len(v) == 1}
    return F.translate(c, "".join(single), "".join(single.values()))


def fold_ascii(c: Column) -> Column:
    """Latin letters as ASCII: marks, strokes and ligatures gone, free combining marks dropped; other scripts stay."""
    return F.regexp_replace(_spelt_out(fold_accents(c)), r"[\x{300}-\x{36f}]", "")


def match_key(c: Column, lower: bool = True) -> Column:
    """What names are compared by: compatibility forms without marks in any script, stroked letters
    spelt out, one kind of apostrophe, lower case if ``lower``, white space collapsed."""
    plain, other = compatible_pairs()
    unified = F.translate(F.translate(c, APOSTROPHES, "'" * len(APOSTROPHES)), other, plain)
    plain_text = F.regexp_replace(_spelt_out(unified), r"\p{M}+", "")
    return squash(F.lower(plain_text) if lower else plain_text)


def name_key(name: Column, country: Column) -> Column:
    """Folded, lower-case words of a name, a bar, the lower-case country code."""
    words = F.btrim(F.regexp_replace(F.lower(fold_accents(F.coalesce(name, F.lit("")))), r"[^\p{L}\p{N}]+", " "))
    return F.concat(words, F.lit("|"), F.lower(F.coalesce(country, F.lit(""))))


def norm_doi(c: Column) -> Column:
    """Lower-case DOI without resolver prefix."""
    return empty_to_null(F.lower(F.regexp_replace(F.btrim(c), r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")))


def key_alnum(c: Column, least: int = 4) -> Column:
    """Lower-case letters and digits alone; null if fewer than ``least``."""
    key = F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    return F.when(F.length(key) >= least, key)


def key_zeros(c: Column, least: int = 4) -> Column:
    """key_alnum without leading zeros."""
    key = F.regexp_replace(key_alnum(c, 0), "^0+", "")
    return F.when(F.length(key) >= least, key)


def key_prefix(c: Column, least: int = 4) -> Column:
    """key_zeros of what follows a leading run of letters."""
    key = F.regexp_replace(key_zeros(c, 0), "^[a-z]+0*", "")
    return F.when(F.length(key) >= least, key)


def upper_share(c: Column) -> Column:
    """Share of ASCII letters that are capitals; null without letters."""
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    return F.length(F.regexp_replace(c, "[^A-Z]", "")) / F.nullif(letters, F.lit(0))


def is_shouting(c: Column, least: int = 10, share: float = 0.8) -> Column:
    letters = F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    return F.coalesce((letters >= least) & (upper_share(c) >= share), F.lit(False))


def latin_share(c: Column) -> Column:
    """Share of letters that are Latin; null without letters."""
    letters = F.length(F.regexp_replace(c, r"\P{L}", ""))
    return F.length(F.regexp_replace(c, r"\P{IsLatin}", "")) / F.nullif(letters, F.lit(0))


def script_consistent(c: Column, expected: Column, least: float = 0.5) -> Column:
    """Whether a text is in the script a language expects: ``expected`` true for Latin, least share of its letters."""
    share = latin_share(c)
    return F.coalesce(F.when(expected, share >= least).otherwise(share <= 1 - least), F.lit(True))


def clean_for_lid(c: Column) -> Column:
    """What a language model should see: addresses, references and digits gone, white space collapsed."""
    bare = F.regexp_replace(c, r"(?:https?://|www\.)\S+|\S+@\S+\.\S+|\d+", " ")
    return F.coalesce(squash(bare), F.lit(""))


def truncate_text(c: Column, most: int) -> Column:
    """At most ``most`` characters, cut at the last white space if there is one in the second half."""
    head = F.substring(c, 1, most)
    whole = F.regexp_replace(head, r"\s+\S*\z", "")
    return F.when(F.length(c) <= most, c).otherwise(F.when(F.length(whole) * 2 >= most, whole).otherwise(head))


def sentence_chunks(c: Column, most: int) -> Column:
    """Sentences joined by spaces into chunks of at most ``most`` words; a longer sentence is a chunk of its own."""
    words = lambda s: F.size(F.split(F.btrim(s), r"\s+"))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, s: Column) -> Column:
        joined = F.when(acc["open"] == "", s).otherwise(F.concat_ws(" ", acc["open"], s))
        fits = (acc["open"] == "") | (words(joined) <= most)
        done = F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["open"]))
        return F.struct(done.alias("done"), F.when(fits, joined).otherwise(s).alias("open"))

    return F.aggregate(split_sentences(c), start, step, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.array_append(acc["done"], acc["open"])))


def safe_file_name(c: Column, most: int = 120) -> Column:
    """A name that any file system takes: ASCII letters, digits, dot, dash and underline; 'file' if nothing is left."""
    plain = F.regexp_replace(fold_ascii(F.coalesce(c, F.lit(""))), r"[^A-Za-z0-9._-]+", "_")
    bare = F.regexp_replace(plain, r"^[._-]+|[._-]+\z", "")
    stem, ending = F.regexp_replace(bare, r"\.[A-Za-z0-9]{1,8}\z", ""), F.regexp_extract(bare, r"\.[A-Za-z0-9]{1,8}\z", 0)
    cut = F.concat(F.substring(stem, F.lit(1), F.lit(most) - F.length(ending)), ending)
    return F.when(bare == "", "file").when(F.length(bare) <= most, bare).otherwise(cut)


def hallucinated(source: Column, output: Column) -> Column:
    """An output longer than three times its source plus 40 characters."""
    return F.length(output) > 3 * F.length(source) + 40


def split_sentences(c: Column) -> Column:
    """Sentences of a text: cut after . ! ? and the white space that follows."""
    return F.filter(F.split(F.btrim(c), r"(?<=[.!?])\s+"), lambda x: x != "")


class python_oracles:
    """Row-by-row equivalents of the cleaning Columns."""

    @staticmethod
    def _ensure(s: str | None) -> str:
        return (s or "").strip(BOM_CHARS)

    @classmethod
    def sanitize_string(cls, s: str | None) -> str | None:
        return " ".join(cls._ensure(s).split()) or None

    @classmethod
    def sanitize_name(cls, s: str | None) -> str | None:
        return " ".join(cls._ensure(s).replace("\r", "").split()) or None

    @classmethod
    def sanitize_title(cls, s: str | None) -> str | None:
        s = cls._ensure(s).replace("\r", "").replace("\n", " ").replace("–", "-").replace("—", "-")
        return " ".join(s.split()) or None

    @classmethod
    def sanitize_content(cls, s: str | None) -> str | None:
        lines = (" ".join(x.split()) for x in cls._ensure(s).replace("\r", "").replace("\0", "").split("\n"))
        return "\n".join(x for x in lines if x) or None

    @classmethod
    def sanitize_url(cls, s: str | None) -> str | None:
        return re.sub("[\r\n\t]", "", cls._ensure(s).strip()) or None
