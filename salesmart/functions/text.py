"""Text expressions: names, ids, labels, safe casts."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F

# White space that Unicode strips, as far as decomposition leaves it.
_BLANKS = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
_HANGUL = range(0xAC00, 0xD7A4)  # syllables stay whole: both sides of a comparison keep them alike


def _decompositions() -> dict[str, str]:
    """Every character whose compatibility decomposition, without combining marks, is another text; empty for a mark."""
    found = {}
    for code in range(0x80, sys.maxunicode + 1):
        if code not in _HANGUL and not 0xD800 <= code < 0xE000:
            ch = chr(code)
            base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
            if base != ch:
                found[ch] = base
    return found


_BASE = _decompositions()
# Letters first: what has no counterpart in PLAIN is taken out.
ACCENTED = "".join(c for c, base in sorted(_BASE.items(), key=lambda m: not m[1]) if len(base) < 2)
PLAIN = "".join(base for base in _BASE.values() if len(base) == 1)
_LONGER = {c: base for c, base in _BASE.items() if len(base) > 1}


def _class_of(chars) -> str:
    """A regular expression class of some characters, as ranges."""
    codes, spans = sorted(map(ord, chars)), []
    for c in codes:
        if spans and c == spans[-1][1] + 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return "[" + "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]"


_LONGER_CLASS = _class_of(_LONGER)


def _spelled_out(c: Column) -> Column:
    """Ligatures, fractions and the like as their letters; only texts that have such characters are looked at."""
    # Two constants that the optimizer folds into one map.
    table = F.map_from_arrays(F.split(F.lit("".join(_LONGER)), ""), F.split(F.lit("\x01".join(_LONGER.values())), "\x01"))
    letters = F.transform(F.split(c, ""), lambda ch: F.coalesce(F.element_at(table, ch), ch))
    return F.when(c.rlike(_LONGER_CLASS), F.array_join(letters, "")).otherwise(c)


def norm_name(c: Column) -> Column:
    """Spelling-insensitive name: compatibility forms decomposed, no accents, lower case, trimmed, one spelling of ceviche.

    Letters written as base + combining mark lose the mark too.  A text of ASCII
    letters only has nothing to decompose and skips that.
    """
    ascii_only = F.octet_length(c) == F.char_length(c)
    plain = F.when(ascii_only, c).otherwise(F.translate(_spelled_out(c), ACCENTED, PLAIN))
    return F.replace(F.trim(F.lower(plain), F.lit(_BLANKS)), F.lit("cebiche"), F.lit("ceviche"))


def is_valid_id(c: Column) -> Column:
    """True when the id document is exactly eight digits; NULL counts as invalid."""
    return F.coalesce(c.rlike(r"\A[0-9]{8}\z"), F.lit(False))


def valid_id_flag(c: Column) -> Column:
    return is_valid_id(c).cast("int")


def pad_id(c: Column) -> Column:
    """Right-most eight characters after zero padding."""
    return F.right(F.concat(F.lit("00000000"), c.cast("string")), F.lit(8))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def safe_cast(c: Column, dtype: str) -> Column:
    """Cast that yields NULL for blank or malformed text."""
    return F.nullif(F.trim(c), F.lit("")).try_cast(dtype)


def or_default(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def as_text(c: Column, fmt: str | None = None) -> Column:
    """Text form for exports and logs; dates take a pattern."""
    return F.date_format(c, fmt) if fmt else c.cast("string")


def customer_label(c: Column) -> Column:
    """C- plus the id padded to five digits; longer ids stay whole."""
    text = c.cast("string")
    return F.concat(F.lit("C-"), F.when(F.length(text) >= 5, text).otherwise(F.lpad(text, 5, "0")))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-T"), quarter.cast("string"))


def order_ref(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def counter_text(**counters: Column) -> Column:
    """``a=1; b=2``; a NULL counter prints as empty."""
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("")))
        for name, value in counters.items()
    ]
    return F.concat_ws("; ", *parts)
