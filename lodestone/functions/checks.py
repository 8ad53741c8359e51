"""Check digits and identifier rules as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: multiplication, permutation and inverse tables of the Verhoeff scheme
VERHOEFF_D = (
    (0, 1, 2, 3, 4, 5, 6, 7, 8, 9),
    (1, 2, 3, 4, 0, 6, 7, 8, 9, 5),
    (2, 3, 4, 0, 1, 7, 8, 9, 5, 6),
    (3, 4, 0, 1, 2, 8, 9, 5, 6, 7),
    (4, 0, 1, 2, 3, 9, 5, 6, 7, 8),
    (5, 9, 8, 7, 6, 0, 4, 3, 2, 1),
    (6, 5, 9, 8, 7, 1, 0, 4, 3, 2),
    (7, 6, 5, 9, 8, 2, 1, 0, 4, 3),
    (8, 7, 6, 5, 9, 3, 2, 1, 0, 4),
    (9, 8, 7, 6, 5, 4, 3, 2, 1, 0),
)
VERHOEFF_P = (
    (0, 1, 2, 3, 4, 5, 6, 7, 8, 9),
    (1, 5, 7, 6, 2, 8, 3, 0, 9, 4),
    (5, 8, 0, 3, 7, 9, 6, 1, 4, 2),
    (8, 9, 1, 6, 0, 4, 3, 5, 2, 7),
    (9, 4, 5, 3, 1, 2, 6, 8, 7, 0),
    (4, 2, 8, 6, 5, 7, 3, 9, 0, 1),
    (2, 7, 9, 3, 8, 0, 6, 4, 1, 5),
    (7, 0, 4, 6, 9, 1, 3, 2, 5, 8),
)
VERHOEFF_INV = (0, 4, 3, 2, 1, 5, 6, 7, 8, 9)
# fixed values: entity types, the fourth character of a PAN
PAN_TYPES = "PFCATBLJGH"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_valid(text: Column) -> Column:
    """13 to 19 digits that pass the Luhn check; separators are ignored."""
    d = digits(text)
    return F.length(d).between(13, 19) & F.call_function("luhn_check", d)


def _table(rows: tuple) -> Column:
    return F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])


def verhoeff(number: Column, offset: int = 0) -> Column:
    """Verhoeff checksum of a digit string read from the right; 0 is valid."""
    d, p = _table(VERHOEFF_D), _table(VERHOEFF_P)
    chars = F.split(F.reverse(number), "")

    def step(acc: Column, ch: Column) -> Column:
        place = F.get(F.get(p, acc["i"] % 8), ch.cast("int"))
        return F.struct((acc["i"] + 1).alias("i"), F.get(F.get(d, acc["c"]), place).alias("c"))

    return F.aggregate(F.filter(chars, lambda x: x != ""), F.struct(F.lit(offset).alias("i"), F.lit(0).alias("c")), step, lambda a: a["c"])


def aadhaar_valid(text: Column) -> Column:
    """Twelve digits, the first neither 0 nor 1, with a right check digit; blanks and hyphens are ignored."""
    d = F.regexp_replace(text, r"[\s-]", "")
    shaped = F.coalesce(F.rlike(d, F.lit("^[2-9][0-9]{11}$")), F.lit(False))
    return F.when(shaped, verhoeff(d) == 0).otherwise(F.lit(False))


def aadhaar_check_digit(first11: Column) -> Column:
    inv = F.array(*[F.lit(x) for x in VERHOEFF_INV])
    return F.get(inv, verhoeff(first11, 1))


def pan_valid(text: Column) -> Column:
    return F.coalesce(F.rlike(F.upper(F.trim(text)), F.lit(f"^[A-Z]{{3}}[{PAN_TYPES}][A-Z][0-9]{{4}}[A-Z]$")), F.lit(False))
