"""Text normalisation, keys and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the source data uses it: Unicode spaces (a non-breaking space
# among them) and the four ASCII separators, which Java leaves out of \s.
_SPACE = r"[\s\x1c-\x1f]"
_U = "(?U)"
_SPACE_CHARS = "".join(
    chr(i)
    for i in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# Text that means "no value" in a series key.
NULL_LIKE = ("none", "nan", "<na>")


def collapse(c: Column) -> Column:
    """Runs of whitespace to one space, none at the ends. NULL stays NULL."""
    return F.trim(F.regexp_replace(c, f"{_U}{_SPACE}+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_text(c: Column) -> Column:
    """Collapse whitespace; blank becomes NULL."""
    return blank_to_null(collapse(c))


def normalize_punct(c: Column) -> Column:
    """Unify separators to single ``, `` and collapse whitespace; blank becomes NULL."""
    commas = F.translate(c, ":;|/", ",,,,")
    single = F.regexp_replace(commas, f"{_U},{_SPACE}*,+", ",")
    spaced = F.regexp_replace(single, f"{_U}{_SPACE}*,{_SPACE}*", ", ")
    return blank_to_null(collapse(spaced))


def identifier_texts(parts: Column) -> Column:
    """An array of cells normalised as text and as identifiers.

    Cells without any separator, the usual case, skip the separator steps.
    """
    plain = F.transform(parts, collapse)
    return F.transform(
        plain, lambda x: F.when(x.rlike("[,:;|/]"), normalize_punct(x)).otherwise(blank_to_null(x))
    )


def is_blank(c: Column) -> Column:
    """NULL or nothing but whitespace."""
    return F.coalesce(collapse_ends(c), F.lit("")) == ""


def wide_identifier(c: Column) -> Column:
    """Identifier of the wide matrix: NULL becomes '', whitespace collapsed."""
    return F.coalesce(collapse(c), F.lit(""))


def wide_identifiers(parts: Column) -> Column:
    return F.transform(parts, wide_identifier)


def amt_pack(c: Column) -> Column:
    """Commas to spaces unless a digit is directly on either side; collapse."""
    return collapse(F.regexp_replace(c, rf"{_U}(?<!\d),(?!\d)", " "))


def _squeezed(x: Column) -> Column:
    return F.when(x.contains("  "), F.regexp_replace(x, " {2,}", " ")).otherwise(x)


def _same_words(x: Column) -> Column:
    unified = F.regexp_replace(x, rf"{_U}\bfilm coated\b", "film-coated")
    unified = F.regexp_replace(unified, rf"{_U}\b(tablet|capsule)s\b", "$1")
    noted = x.contains("film coated") | x.contains("tablets") | x.contains("capsules")
    return F.when(noted, unified).otherwise(x)


def canon_values(parts: Column) -> Column:
    """Parts of a series key: cosmetic differences removed, quantities kept.

    Works on an array, one step per ``transform``. Written out per part, the
    generated code of a five-part key grows past what the JVM compiles.
    """
    clean = F.transform(parts, lambda x: F.lower(collapse(F.coalesce(x, F.lit("")))))
    bare = F.transform(
        clean, lambda x: F.when(x.isin(*NULL_LIKE), F.lit("")).otherwise(F.translate(x, ",.;:", ""))
    )
    return F.transform(F.transform(bare, _same_words), lambda x: F.trim(_squeezed(x)))


def canon_value(c: Column) -> Column:
    """One part of a series key."""
    return canon_values(F.array(c))[0]


def joined_label(first: Column, second: Column) -> Column:
    """``first_second``, or whichever of the two is present, else ''."""
    return F.concat_ws("_", blank_to_null(collapse_ends(first)), blank_to_null(collapse_ends(second)))


def collapse_ends(c: Column) -> Column:
    """Whitespace removed at both ends only."""
    return F.trim(c, F.lit(_SPACE_CHARS))


def piped(parts: Sequence[Column]) -> Column:
    """`` | ``-joined text with NULL as ''."""
    return F.concat_ws(" | ", *[F.coalesce(p, F.lit("")) for p in parts])


def hashed_key(parts: Sequence[Column]) -> Column:
    """Surrogate key of a row's parts.

    Each part carries its length, so text containing the separator cannot make
    two different rows collide. NULL and '' are the same part.
    """
    sized = []
    for p in parts:
        text = F.coalesce(p.cast("string"), F.lit(""))
        sized += [F.char_length(text).cast("string"), text]
    return F.sha2(F.concat_ws(":", *sized), 256)


def packed_id(c: Column) -> Column:
    """An id in half the bytes, to be shuffled: 64 hexadecimal digits as 32 bytes, any other text as its own bytes.

    The first byte tells the two apart, so different ids stay different. ``unpacked_id`` gives the text back.
    """
    c = c.cast("string")
    return F.when(c.rlike(r"^[0-9a-f]{64}\z"), packed_hash(c)).otherwise(F.concat(F.lit(b"\x00"), c.cast("binary")))


def packed_hash(c: Column) -> Column:
    """``packed_id`` of a ``hashed_key``."""
    return F.concat(F.lit(b"\x01"), F.unhex(c))


def unpacked_id(c: Column) -> Column:
    rest = F.substring(c, 2, 2**31 - 1)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def whole_id(c: Column) -> Column:
    """Id as text: ``102.0`` and ``102`` are the same id, any other text is itself, '' is NULL.

    Never by way of a number, which would make equal what differs in the 17th place.
    """
    return blank_to_null(F.regexp_replace(collapse_ends(c.cast("string")), r"^([0-9]+)\.0+$", "$1"))


def formulary(c: Column) -> Column:
    """``1``/``F1`` to F1, ``60``/``F2`` to F2, any-case ``cdl`` to CDL, '' to NULL."""
    s = collapse_ends(c)
    return (
        F.when(s.isin("1", "F1"), F.lit("F1"))
        .when(s.isin("60", "F2"), F.lit("F2"))
        .when(F.upper(s) == "CDL", F.lit("CDL"))
        .otherwise(blank_to_null(s))
    )


def event_label(code: Column) -> Column:
    """Readable label of an event code; undocumented codes stand for themselves.

    The order of the rules matters: a 15-year code also contains the text of a
    5-year code.
    """
    return (
        F.when(code.contains("PD_FLOWON"), code)
        .when(code.contains("APA"), code)
        .when(code.contains("15_YR_F1"), F.lit("15-year anniversary"))
        .when(code.contains("10_YR_F1"), F.lit("10-year anniversary"))
        .when(code.contains("5_YR_F1"), F.lit("5-year anniversary"))
        .when(code.contains("LEGIS"), F.lit("15-year anniversary (1.48%)"))
        .when(code.endswith("_NB"), F.lit("First new brand"))
        .when(code.endswith("_PD"), F.lit("Price disclosure"))
        .otherwise(code)
    )


def display_name(parts: Sequence[Column]) -> Column:
    """Non-empty parts joined by a middle dot, in the order given."""
    shown = F.filter(
        F.transform(F.array(*parts), collapse_ends), lambda x: ~x.isin("", "None", "nan", "<NA>")
    )
    return F.array_join(shown, " · ")


def series_key(drug: Column, form: Column, brand: Column, responsible: Column, pack: Column) -> Column:
    """Key of one price series. The item code is deliberately not part of it."""
    return F.array_join(canon_values(F.array(drug, form, brand, responsible, pack)), "|")


def loose_key(*parts: Column) -> Column:
    """A number that is the same for all parts that have one ``series_key``, and cheap: it only says which rows belong in one partition.

    Left out is every character that the key changes, adds or may remove: marks and spaces, the plural ``s``, and
    the letters of ``none``, ``nan`` and ``<na>``.
    """
    whole = F.concat_ws("", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.xxhash64(F.regexp_replace(F.lower(whole), "[^b-df-mp-rt-z0-9]+", ""))


def search_tokens(text: Column) -> Column:
    """Item codes named by one search text, lower-cased, as an array.

    Comma, semicolon or newline separate codes. Without those, spaces do, but
    only if every word looks like a code (letters and digits, at least one of
    each); otherwise the whole text is one code.
    """
    trimmed = F.lower(collapse_ends(text))
    by_mark = F.filter(
        F.transform(F.split(F.lower(text), "[,;\n]+"), collapse_ends), lambda t: t != ""
    )
    words = F.filter(F.split(F.lower(text), f"{_U}{_SPACE}+"), lambda t: t != "")
    codelike = F.forall(words, lambda t: t.rlike("^(?=.*[a-z])(?=.*[0-9])[a-z0-9]+$"))
    return (
        F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>"))
        .when(text.rlike("[,;\n]"), by_mark)
        .when((F.size(words) > 1) & codelike, words)
        .otherwise(F.array(trimmed))
    )
