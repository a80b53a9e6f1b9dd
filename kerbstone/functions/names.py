"""Street names and cross-street labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

_OFFSET = r"^\s*[0-9]+\s*'?\s*(?:FT\.?|FEET)?\s*[NSEW]{1,2}\s*/?O\s+"


def lookup(table: dict[str, str], key: Column) -> Column:
    """The table's value of a key, null where there is none."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[key]


def squeezed(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def without_notes(x: Column) -> Column:
    return F.regexp_replace(x, r"\(.*?\)", " ")


def ordinal(token: Column) -> Column:
    """1 is 1ST, 02 is 2ND, FIRST is 1ST; other tokens stay."""
    digits = F.regexp_replace(token, "^0+", "")
    digits = F.when(digits == "", "0").otherwise(digits)
    last, tens = F.right(digits, F.lit(1)), F.right(F.concat(F.lit("0"), digits), F.lit(2)).substr(1, 1)
    ending = F.when((tens == "1") | (F.right(digits, F.lit(2)) == "20"), "TH").otherwise(F.coalesce(lookup({"1": "ST", "2": "ND", "3": "RD"}, last), F.lit("TH")))
    return F.when(token.rlike("^[0-9]+$"), F.concat(digits, ending)).otherwise(F.coalesce(lookup(K.ORDINAL_WORDS, token), token))


def normalize(name: Column, numeric_as_ordinal: bool = True) -> Column:
    """The canonical form of a street name; null and blank give an empty string."""
    s = F.replace(without_notes(F.upper(F.coalesce(name, F.lit("")))), F.lit("&"), F.lit(" AND "))
    s = F.trim(F.regexp_replace(F.regexp_replace(s, "[^A-Z0-9 ]", " "), " +", " "))
    s = F.regexp_replace(s, f"(?: (?:{'|'.join(K.BOUNDS)}))+$", "")
    last = F.regexp_extract(s, " ([A-Z0-9]+)$", 1)
    suffix = lookup(K.SUFFIXES, last)
    core = F.when(suffix.isNotNull(), F.regexp_replace(s, " [A-Z0-9]+$", "")).otherwise(s)
    core = F.regexp_replace(F.regexp_replace(core, "^MC ", "MC"), f"^(?:(?:{'|'.join(K.LEADING)}) )+", "")
    if numeric_as_ordinal:
        core = F.array_join(F.transform(F.split(core, " "), ordinal), " ")
    core = F.coalesce(lookup(K.CORE_ALIASES, core), core)
    out = F.trim(F.concat_ws(" ", core, suffix))
    return F.coalesce(lookup(K.FULL_ALIASES, out), out)


def core_of(name: Column) -> Column:
    """All but the last token of a canonical name, or the name of one token."""
    return F.regexp_replace(name, " [^ ]+$", "")


def variants(name: Column) -> Column:
    """The canonical form and the one without its last token."""
    full = normalize(name)
    return F.array_distinct(F.array(full, core_of(full)))


def is_terminal(label: Column) -> Column:
    """Whether a limit names the end of the street."""
    s = F.trim(F.regexp_replace(F.translate(without_notes(F.upper(F.coalesce(label, F.lit("")))), ".-", "  "), r"\s+", " "))
    return (s == "") | s.isin(K.TERMINALS) | s.rlike("CITY LIMIT|CUL DE SAC|DEAD END| END$|^(?:END|BEG|BEGIN|START) ")


def label_alternatives(label: Column) -> Column:
    """The street names that a limit may mean, parentheses first, each once."""
    raw = F.upper(F.coalesce(label, F.lit("")))
    chunks = F.concat(F.regexp_extract_all(raw, F.lit(r"\((.*?)\)"), F.lit(1)), F.array(without_notes(raw)))
    led = F.transform(chunks, lambda c: F.regexp_replace(c, r"^\s*(?:OPP|OPPOSITE|APPROX|NEAR|AT)\s+", " "))
    pieces = F.flatten(F.transform(led, lambda c: F.split(c, "[/&,]| AND ")))
    pieces = F.transform(pieces, lambda p: F.regexp_replace(p, r"^[ .]+|[ .]+$", ""))
    pieces = F.transform(pieces, lambda p: F.when(p.rlike(_OFFSET + ".+$"), F.trim(F.regexp_replace(p, _OFFSET, ""))).otherwise(p))
    return F.array_distinct(F.filter(pieces, lambda p: p != ""))


def is_offset(label: Column) -> Column:
    """Whether a limit is a distance from a street (374' E/O X)."""
    return F.trim(without_notes(F.upper(F.coalesce(label, F.lit(""))))).rlike(_OFFSET + ".+$")


def is_soft(label: Column) -> Column:
    """Whether a limit does not pin an exact point."""
    return is_terminal(label) | is_offset(label)
