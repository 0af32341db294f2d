"""Text columns: hashes, entity decoding, field clean-up."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkweft.plans.once import let


def content_hash(text: Column) -> Column:
    """SHA-256 of the UTF-8 text in hex."""
    return F.sha2(text, 256)


def _code_point(code: Column) -> Column:
    """Text of a numeric reference, with the HTML rules for invalid codes."""
    cp1252 = {n: bytes([n]).decode("cp1252", "ignore") for n in range(0x80, 0xA0)}
    low = "".join(cp1252[n] or chr(n) for n in range(0x80, 0xA0))
    noncharacter = (
        code.between(0x1, 0x8)
        | code.between(0xE, 0x1F)
        | code.between(0xFDD0, 0xFDEF)
        | code.isin(0xB, 0x7F)
        | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE)
    )
    return (
        F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\uFFFD"))
        .when(code.between(0x80, 0x9F), F.substr(F.lit(low), (code - 0x7F).cast("int"), F.lit(1)))
        .when(noncharacter, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _number(digits: Column) -> Column:
    """Code of `38` or `x26`; anything too long is beyond Unicode."""
    base16 = F.rlike(digits, F.lit("^[xX]"))
    plain = F.regexp_replace(digits, "^[xX]?0*", "")
    padded = F.concat(F.lit("0"), plain)
    value = F.when(base16, F.conv(padded, 16, 10)).otherwise(padded).cast("long")
    return F.when(F.length(plain) > 8, F.lit(0x110000)).otherwise(value)


def decode_entities(text: Column) -> Column:
    """Replace HTML character references, named and numeric, by their text.

    The names are the HTML5 table of the Python library; a name listed there
    without `;` also counts as the longest start of a longer word.
    """
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    bare = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))

    def piece(part: Column, table: Column) -> Column:
        number = F.regexp_extract(part, r"^&#([0-9]+|[xX][0-9A-Fa-f]+);?", 1)
        rest = F.regexp_replace(part, r"^&#(?:[0-9]+|[xX][0-9A-Fa-f]+);?", "")
        name = F.regexp_extract(part, r"^&([A-Za-z][A-Za-z0-9]*;)", 1)
        short = F.regexp_extract(part, f"^&({bare})", 1)

        def replaced(key: Column) -> Column:
            return F.concat(F.try_element_at(table, key), F.substr(part, F.length(key) + 2))

        return (
            F.when(F.startswith(part, F.lit("&amp;")), F.concat(F.lit("&"), F.substr(part, F.lit(6))))
            .when(
                F.startswith(part, F.lit("&#")) & (number != ""),
                F.concat(let(_number(number), _code_point), rest),
            )
            .when(
                F.rlike(part, F.lit("^&[A-Za-z]")),
                F.coalesce(replaced(name), replaced(short), part),
            )
            .otherwise(part)
        )

    parts = F.split(text, "(?=&)", -1)
    decoded = let(names, lambda table: F.transform(parts, lambda part: piece(part, table)))
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)


def strip(text: Column) -> Column:
    """Cut white space on both ends, Unicode blanks included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def before_break(text: Column) -> Column:
    """Part before the first newline which a tab follows, ends stripped."""
    return F.get(F.split(strip(text), "\n\t", -1), F.lit(0))


def second_word(text: Column) -> Column:
    return F.get(F.split(strip(text), " ", -1), F.lit(1))


def split_saving(text: Column) -> tuple[Column, Column]:
    """`$5.00 (10%)` → amount and percent; the percent is NULL if missing."""
    parts = F.split(text, " ", -1)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def join_paragraphs(texts: Column) -> Column:
    """Texts in order, a newline after each."""
    return F.array_join(F.transform(texts, lambda t: F.concat(t, F.lit("\n"))), "")
