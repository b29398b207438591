"""Column expressions for read ids, basecalls and qualities as the delivered tables hold them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of the three operations, compared in lower case without blanks.
SUBSTITUTION = ("sub", "subst", "substitution", "snv", "snp", "mismatch", "x")
INSERTION = ("ins", "insertion", "i")
DELETION = ("del", "deletion", "d")


def movie_of(read_id: Column) -> Column:
    """Movie name of a read id, in lower case; null where the id has none.

    A leading ``@``, blanks, letter case and everything behind the hole number are ignored.
    """
    return _none_if_empty(F.regexp_extract(F.lower(read_id), r"^\s*@?\s*([^/\s@]+)/\d+", 1))


def hole_of(read_id: Column) -> Column:
    """Hole number of a read id as bigint; null where the id has none."""
    return _none_if_empty(F.regexp_extract(read_id, r"^\s*@?\s*[^/\s@]+/0*(\d{1,18})(?!\d)", 1)).cast("bigint")


def _none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def sequence_of(readbase: Column) -> Column:
    """The sequence of a usable readbase (only A, C, G, T in either case, blanks around it ignored), else null."""
    text = F.upper(F.trim(readbase))
    return F.when(text.rlike("^[ACGT]+$"), text)


def usable_qual(qual: Column, bclen: Column) -> Column:
    """Whether a quality string has ``bclen`` characters, not all of Phred 0; never null."""
    return F.coalesce((F.length(qual) == bclen) & (F.length(qual) > 0) & (F.translate(qual, "!", "") != ""), F.lit(False))


def operation_of(op: Column) -> Column:
    """``sub``, ``ins`` or ``del`` for any spelling of them, else null."""
    text = F.lower(F.trim(op))
    return F.when(text.isin(*SUBSTITUTION), "sub").when(text.isin(*INSERTION), "ins").when(text.isin(*DELETION), "del")
