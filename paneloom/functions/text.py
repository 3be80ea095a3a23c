"""Names, keys and other text expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from paneloom import fixed_values


def compose_name(first: Column, last: Column) -> Column:
    """``first last``; null when either is null."""
    return F.concat(first, F.lit(" "), last)


def clean_name(
    name: Column,
    removals: Sequence[str] = fixed_values.NAME_REMOVALS,
    longest_first: bool = False,
) -> Column:
    """Remove literal fragments one after another, then trim.

    In the given order `` II`` goes before `` III``, so ``X III`` becomes
    ``XI``; ``longest_first`` removes longer fragments first instead.
    """
    if longest_first:
        removals = sorted(removals, key=len, reverse=True)
    for fragment in removals:
        name = F.replace(name, F.lit(fragment), F.lit(""))
    return F.trim(name)


def token_sort(name: Column) -> Column:
    """Whitespace-separated tokens in ascending order, joined by one space."""
    return F.array_join(F.array_sort(F.split(F.trim(name), r"\s+")), " ")


def recode(value: Column, mapping: Mapping) -> Column:
    """Replace mapped values, pass the others through."""
    return F.coalesce(map_values(value, mapping), value)


def map_values(value: Column, mapping: Mapping, default=None) -> Column:
    """Strict lookup: unmapped values become ``default`` (null)."""
    if not mapping:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(table, value)
    return found if default is None else F.coalesce(found, F.lit(default))


def canonical_entity(
    value: Column,
    aliases: Mapping[str, str] | None = None,
    codes: Mapping[str, str] | None = None,
) -> Column:
    """Last word of the label, then alias and code replacement.

    Case is ignored in both tables; a label in neither table comes back in
    title case.
    """
    words = F.split(F.trim(F.translate(value, "_", " ")), " ")
    label = F.lower(F.element_at(words, -1))
    fold = lambda table: {k.lower(): v for k, v in (table or {}).items()}
    aliased = map_values(label, fold(aliases))
    looked_up = F.lower(F.coalesce(aliased, label))
    return F.coalesce(map_values(looked_up, fold(codes)), aliased, F.initcap(label))


def name_group_key(name: Column, group: Column) -> Column:
    """``NAME_GROUP`` with the name's spaces and punctuation kept as given."""
    return F.upper(F.concat(name, F.lit("_"), group))


def name_birth_key(name: Column, birth: Column, group: Column) -> Column:
    """``NAME_yyyyMMdd``, or ``NAME_group`` while the birth date is unknown."""
    bare = F.replace(F.upper(F.trim(name)), F.lit(" "), F.lit(""))
    tail = F.coalesce(F.date_format(birth, "yyyyMMdd"), group)
    return F.concat(bare, F.lit("_"), tail)


def short_birth_key(first: Column, last: Column, birth: Column) -> Column:
    """Seven letters of the last name, three of the first, month, day, year."""
    return F.concat(
        F.lower(F.substring(last, 1, 7)),
        F.substring(first, 1, 3),
        F.month(birth).cast("string"),
        F.dayofmonth(birth).cast("string"),
        F.year(birth).cast("string"),
    )


def joined_key(*parts: Column) -> Column:
    """Parts joined by ``_``; null when any part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("_"), part.cast("string")]
    return F.concat(*pieces[1:])


def digits_in(value: Column) -> Column:
    """First run of digits, null when there is none."""
    return F.nullif(F.regexp_extract(value, r"(\d+)", 1), F.lit(""))


def strip_hash(value: Column) -> Column:
    return F.replace(value.cast("string"), F.lit("#"), F.lit(""))
