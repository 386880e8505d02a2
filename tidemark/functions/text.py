"""Normalisation of names, contacts and free text as Column expressions.

Blank strings become null everywhere, and white space means Unicode white space.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def trimmed(c: Column) -> Column:
    """Without white space at both ends."""
    return blank_to_null(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def squeezed(c: Column) -> Column:
    """Trimmed, with inner runs of white space as one space."""
    return F.regexp_replace(trimmed(c), r"(?U)\s+", " ")


def email(c: Column) -> Column:
    return F.lower(trimmed(c))


def email_ok(c: Column) -> Column:
    """An @ that is neither first nor last, with a dot somewhere after the first one."""
    at = F.instr(c, "@")
    return F.coalesce((at > 1) & (at < F.length(c)) & (F.instr(F.substring(c, at + 1, F.length(c)), ".") > 0), F.lit(False))


def phone(c: Column) -> Column:
    """+ and digits: ten digits get the country code 1, seven or more stay, fewer are no phone."""
    d = F.regexp_replace(trimmed(c), r"\D", "")
    n = F.length(d)
    return F.when(n == 10, F.concat(F.lit("+1"), d)).when(n >= 7, F.concat(F.lit("+"), d))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, str, str]:
    """Characters that become one letter or none, those letters, what other characters become, and a class of the latter.

    Hangul syllables are left out; they follow a rule.
    """
    single, base, gone, longer = [], [], [], {}
    for i in [*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, sys.maxunicode + 1)]:
        c = chr(i)
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if plain == c:
            continue
        if len(plain) == 1:
            single.append(c)
            base.append(plain)
        elif plain:
            longer[c] = plain
        else:
            gone.append(c)
    table = "\1".join(f"{c}\2{to}" for c, to in longer.items())
    return "".join(single + gone), "".join(base), table, "".join(longer)


def _syllable(x: Column) -> Column:
    """Letters of a Hangul syllable: 21 vowels by 28 finals, of which the first is none, for each initial."""
    i = F.ascii(x) - 0xAC00
    run = lambda first, n: F.lit("".join(map(chr, range(first, first + n))))
    part = lambda letters, at: F.substring(letters, at, F.lit(1))
    last = F.when(i % 28 > 0, part(run(0x11A8, 27), (i % 28).cast("int"))).otherwise("")
    return F.concat(part(run(0x1100, 19), F.floor(i / 588).cast("int") + 1), part(run(0x1161, 21), F.floor(i % 588 / 28).cast("int") + 1), last)


def folded(c: Column) -> Column:
    """Compatibility letters by their bases, without combining marks, for all of Unicode: NFKD and no marks.

    ASCII passes untouched and letters with a one-letter base are translated;
    only texts that hold characters of longer forms (ligatures, signs such as
    the trade mark, Hangul) are taken apart.
    """
    single, base, table, longer = _fold_tables()
    forms = F.str_to_map(F.lit(table), F.lit("\1"), F.lit("\2"))
    each = lambda x: F.when(x.between("\uac00", "\ud7a3"), _syllable(x)).otherwise(F.coalesce(F.element_at(forms, x), x))
    apart = F.array_join(F.transform(F.split(c, ""), each), "")
    rare = F.translate(c, longer, "") != c
    some = rare | c.rlike("[\uac00-\ud7a3]")
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(F.translate(F.when(some, apart).otherwise(c), single, base))


def person_key(c: Column) -> Column:
    """Folded lower-case letters, digits and underscores with single spaces, for matching people."""
    plain = F.regexp_replace(F.lower(folded(trimmed(c))), r"(?U)[^\w\s]", "")
    return squeezed(plain)


def slug(c: Column) -> Column:
    """Folded lower-case ASCII letters and digits, other runs as single hyphens."""
    plain = F.regexp_replace(F.lower(folded(trimmed(c))), "[^a-z0-9]+", "-")
    return blank_to_null(F.regexp_replace(plain, "^-|-$", ""))


def name_parts(c: Column) -> Column:
    """Struct(first, last) of "Last, First" or "First Last"; one word is a first name."""

    def parts(v: Column) -> Column:
        cut = F.instr(v, ",")
        words = F.split(v, " ")
        comma = F.struct(trimmed(F.substring(v, cut + 1, F.length(v))).alias("first"), trimmed(F.substring(v, F.lit(1), cut - 1)).alias("last"))
        one = F.struct(v.alias("first"), F.lit(None).cast("string").alias("last"))
        many = F.struct(F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " ").alias("first"), F.element_at(words, -1).alias("last"))
        none = F.struct(F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("last"))
        return F.when(v.isNull(), none).when(cut > 0, comma).when(F.size(words) == 1, one).otherwise(many)

    return let(squeezed(c), parts)


def full_name(first: Column, last: Column) -> Column:
    return blank_to_null(F.concat_ws(" ", trimmed(first), trimmed(last)))


def owners(owner: Column, names: Column) -> Column:
    """Array of (full_name, role): the owner first, then co-owners split at & and "and", each once by its key."""
    lead = squeezed(owner)
    pieces = F.transform(F.split(F.coalesce(names, F.lit("")), r"(?iU)&|\s+and\s+"), squeezed)
    pieces = F.filter(pieces, lambda x: x.isNotNull())
    row = lambda n, role: F.struct(n.alias("full_name"), F.lit(role).alias("role"), F.coalesce(person_key(n), F.lit("")).alias("key"))
    every = F.concat(F.array(row(lead, "owner")), F.transform(pieces, lambda x: row(x, "co_owner")))
    first = lambda x, i, a: ~F.exists(F.slice(a, F.lit(1), i), lambda y: y["key"] == x["key"])
    kept = let(every, lambda a: F.filter(a, lambda x, i: first(x, i, a)))
    out = F.transform(kept, lambda x: F.struct(x["full_name"].alias("full_name"), x["role"].alias("role")))
    return F.when(lead.isNull(), F.array().cast("array<struct<full_name:string,role:string>>")).otherwise(out)


def titled(c: Column) -> Column:
    """Each letter that follows a non-letter in upper case, all others in lower case."""
    chars = F.split(F.lower(c), "")
    letter = lambda x: x.rlike(r"^\p{L}$")
    up = lambda x, i, a: F.when((i == 0) | ~letter(F.get(a, i - 1)), F.upper(x)).otherwise(x)
    return let(chars, lambda a: F.array_join(F.transform(a, lambda x, i: up(x, i, a)), ""))


def lines(c: Column) -> Column:
    """Trimmed lines that aren't blank."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\R"), trimmed), lambda x: x.isNotNull())


def tags(c: Column) -> Column:
    """Items of a comma-separated list in which items may be quoted, trimmed and not blank."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r'\s*("(?:[^"]|"")*"\s*|[^,]*)(?:,|$)'), F.lit(1))
    plain = F.transform(found, lambda x: trimmed(F.replace(F.when(x.rlike(r'^".*"\s*$'), F.regexp_replace(x, r'^"|"\s*$', "")).otherwise(x), F.lit('""'), F.lit('"'))))
    return F.filter(plain, lambda x: x.isNotNull())


def whole_number(c: Column) -> Column:
    return trimmed(c).try_cast("int")


def decimal(c: Column, precision: int = 18, scale: int = 4) -> Column:
    return trimmed(c).try_cast(f"decimal({precision},{scale})")


def same_address(a: Column, b: Column) -> Column:
    """Equal but for case and white space."""
    return F.lower(squeezed(a)) == F.lower(squeezed(b))


def joined_address(*parts: Column) -> Column:
    return blank_to_null(F.concat_ws(" | ", *[trimmed(p) for p in parts]))
