"""Protein-level meaning of nucleotide calls, with Spark expressions over a codon table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from clonewell.functions.seq import amino_acid, in_frame, three_letters


def codon_changes(calls: DataFrame, orf: str, keys: list[str]) -> DataFrame:
    """``keys..., aa_pos, from_codon, to_codon, from_aa, to_aa, hgvs_p``: the codons that the substitutions of one genotype change together.

    ``calls`` has ``keys..., pos, kind, ref, alt``; substitutions of the same key in one codon are applied to it
    jointly. Calls outside the reading frame, or whose ref isn't the frame's base there, change nothing.
    ``hgvs_p`` is ``p.Ala5Val``, ``p.Ala5Ter`` or ``p.Ala5=``.
    """
    if len(orf) % 3:
        raise ValueError("a reading frame has a multiple of three bases")
    frame = F.lit(orf)
    pos = F.col("pos")
    subs = calls.where((F.col("kind") == "sub") & in_frame(pos, len(orf)) & (F.substr(frame, pos, F.lit(1)) == F.col("ref")))
    aa = ((pos - 1) / 3).cast("int") + 1
    changed = [F.max(F.when((pos - 1) % 3 == k, F.col("alt"))) for k in range(3)]  # the greatest of contradicting bases
    by = subs.groupBy(*keys, aa.alias("aa_pos")).agg(*(c.alias(f"_b{k}") for k, c in enumerate(changed)))
    start = (F.col("aa_pos") - 1) * 3
    old = F.substr(frame, start + 1, F.lit(3))
    new = reduce(lambda a, k: F.concat(a, F.coalesce(f"_b{k}", F.substr(frame, start + k + 1, F.lit(1)))), range(3), F.lit(""))
    out = by.select(*keys, "aa_pos", old.alias("from_codon"), new.alias("to_codon"))
    out = out.withColumns({"from_aa": amino_acid(F.col("from_codon")), "to_aa": amino_acid(F.col("to_codon"))})
    return out.withColumn("hgvs_p", protein_notation(F.col("from_aa"), F.col("aa_pos"), F.col("to_aa")))


def protein_notation(old: Column, pos: Column, new: Column) -> Column:
    """``p.Ala5Val`` of one-letter codes; ``=`` for the same one."""
    return F.concat(F.lit("p."), three_letters(old), pos.cast("string"), F.when(old == new, "=").otherwise(three_letters(new)))


def _edited_codons(calls: DataFrame, orf: str, keys: list[str]) -> DataFrame:
    """``keys..., codon, text``: each codon with calls as they leave it; at most one of several contradicting calls of a base counts, the greatest.

    Calls outside the frame, and substitutions whose ref isn't the frame's base, change nothing. ``NinsX`` stands before base N.
    """
    frame, pos = F.lit(orf), F.col("pos")
    valid = calls.where(in_frame(pos, len(orf)) & ((F.col("kind") != "sub") | (F.substr(frame, pos, F.lit(1)) == F.col("ref"))))
    codon, place = ((pos - 1) / 3).cast("int") + 1, (pos - 1) % 3

    def of(kind: str, k: int) -> Column:
        return F.max(F.when((F.col("kind") == kind) & (place == k), F.coalesce("alt", F.lit(""))))

    by = valid.groupBy(*keys, codon.alias("codon")).agg(*(of(kind, k).alias(f"_{kind}{k}") for kind in ("sub", "ins", "del") for k in range(3)))
    bases = [
        F.concat(F.coalesce(f"_ins{k}", F.lit("")), F.when(F.col(f"_del{k}").isNotNull(), "").otherwise(F.coalesce(f"_sub{k}", F.substr(frame, F.col("codon") * 3 - 2 + k, F.lit(1)))))
        for k in range(3)
    ]
    return by.select(*keys, "codon", F.concat(*bases).alias("text"))


def protein_of(bases: Column) -> Column:
    """One-letter amino acids of whole codons; bases left over at the end are ignored."""
    n = F.floor(F.length(bases) / 3).cast("int")
    return F.when(n == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: amino_acid(F.substr(bases, i * 3 - 2, F.lit(3)))), ""))


def _long(aa: Column) -> Column:
    return F.when(F.length(aa) == 0, "").otherwise(F.array_join(F.transform(F.split(aa, ""), three_letters), ""))


def protein_blocks(calls: DataFrame, orf: str, keys: list[str]) -> DataFrame:
    """``keys..., first, last, old, new, old_aa, new_aa, fs``: the stretches of codons that the calls of one genotype change together.

    The frame is tracked along the calls: a stretch goes on while it is out of frame, with the codons in between read as they
    come to stand, and ends where later calls bring the frame back. One that never comes back is a frameshift (``fs``), and what lies behind its first
    codon isn't read. So each substitution is read in the frame it stands in. One window per genotype, over its few calls.
    """
    if len(orf) % 3:
        raise ValueError("a reading frame has a multiple of three bases")
    frame, along = F.lit(orf), W.partitionBy(*keys).orderBy("codon")
    shifted = _edited_codons(calls, orf, keys).withColumn("_s", F.length("text") - 3)
    shifted = shifted.withColumn("_before", F.pmod(F.coalesce(F.sum("_s").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), F.lit(3)))
    marked = shifted.select("*", F.sum(F.when(F.col("_before") == 0, 1).otherwise(0)).over(along).alias("_block"), F.lead("_before").over(along).alias("_next"), F.lead("codon").over(along).alias("_nc"))
    between = F.when(F.col("_next") != 0, F.substr(frame, F.col("codon") * 3 + 1, (F.col("_nc") - F.col("codon") - 1) * 3)).otherwise("")
    pieces = marked.withColumn("_piece", F.concat("text", between))
    whole = pieces.groupBy(*keys, "_block").agg(
        F.min("codon").alias("first"), F.max("codon").alias("last"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("codon", "_piece"))), lambda x: x["_piece"]), "").alias("new"), (F.pmod(F.sum("_s"), F.lit(3)) != 0).alias("fs")
    )
    old = F.substr(frame, F.col("first") * 3 - 2, (F.col("last") - F.col("first") + 1) * 3)
    return whole.select(*keys, "first", "last", old.alias("old"), "new", protein_of(old).alias("old_aa"), protein_of(F.col("new")).alias("new_aa"), "fs")


def _notations() -> dict[str, Column]:
    """``p``, ``aa``, ``codon`` and ``c`` of a stretch: ``Ala5Val``, ``A5V``, ``GCT5GTT``, ``13_15delinsGTT``; ``Ala5_Arg6delinsCys`` and so on of indels."""
    first, at, new, new_aa, old_aa = F.substring("old_aa", 1, 1), F.col("first").cast("string"), F.col("new"), F.col("new_aa"), F.col("old_aa")
    simple = (F.col("first") == F.col("last")) & (F.length(new) == 3)
    span = F.when(F.col("first") == F.col("last"), F.concat(three_letters(first), at)).otherwise(F.concat(three_letters(first), at, F.lit("_"), three_letters(F.substr("old_aa", F.length("old_aa"), F.lit(1))), F.col("last").cast("string")))
    fs, same = F.col("fs"), new_aa == old_aa
    bases = F.concat((F.col("first") * 3 - 2).cast("string"), F.lit("_"), (F.col("last") * 3).cast("string"))
    return {
        "p": F.when(fs, F.concat(three_letters(first), at, F.lit("fs"))).when(same, F.concat(span, F.lit("="))).when(simple, F.concat(span, three_letters(new_aa))).when(new_aa == "", F.concat(span, F.lit("del"))).otherwise(F.concat(span, F.lit("delins"), _long(new_aa))),
        "aa": F.when(fs, F.concat(first, at, F.lit("fs"))).when(same, F.concat(old_aa, at, F.lit("="))).otherwise(F.concat(old_aa, at, F.when(new_aa == "", "-").otherwise(new_aa))),
        "codon": F.when(fs, F.concat(F.substring("old", 1, 3), at, F.lit("fs"))).otherwise(F.concat("old", at, F.when(new == "", "-").otherwise(new))),
        "c": F.when(fs, F.concat((F.col("first") * 3 - 2).cast("string"), F.lit("fs"))).when(new == "", F.concat(bases, F.lit("del"))).otherwise(F.concat(bases, F.lit("delins"), new)),
    }


def translations(calls: DataFrame, orf: str, keys: list[str]) -> DataFrame:
    """``keys..., hgvs_c, hgvs_p, codon_changes, codon_hgvs, aa_changes, off_target``: one row per key that has calls.

    ``hgvs_c`` lists the calls inside the frame, ``off_target`` those outside it (``=`` for none). The others list the stretches of
    ``protein_blocks``: ``p.Ala5Val``, ``p.Ala5=``, ``p.Ala5del``, ``p.Ala5_Arg6delinsCys``, ``p.Ala5fs``, several as ``p.[...;...]``; without
    in-frame changes ``p.=``, ``c.=`` and ``WT``.
    """
    inside = in_frame(F.col("pos"), len(orf))

    def listed(cond: Column) -> Column:
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("pos", "mut")))), lambda x: x["mut"]), ";")
        return F.when(text == "", "=").otherwise(text)

    whole = calls.groupBy(*keys).agg(listed(inside).alias("hgvs_c"), listed(~inside).alias("off_target"))
    named = protein_blocks(calls, orf, keys).select(*keys, "first", *(c.alias(n) for n, c in _notations().items()))
    lists = named.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("first", "p", "aa", "codon", "c"))).alias("_b"))
    both = whole.join(lists, keys, "left")
    joined = lambda n, sep: F.array_join(F.transform("_b", lambda x: x[n]), sep)
    boxed = lambda n, mark: F.when(F.col("_b").isNull(), f"{mark}=").when(F.size("_b") == 1, F.concat(F.lit(mark), joined(n, ";"))).otherwise(F.concat(F.lit(f"{mark}["), joined(n, ";"), F.lit("]")))
    plain = lambda n: F.when(F.col("_b").isNull(), "WT").otherwise(joined(n, "|"))
    return both.select(*keys, "hgvs_c", boxed("p", "p.").alias("hgvs_p"), plain("codon").alias("codon_changes"), boxed("c", "c.").alias("codon_hgvs"), plain("aa").alias("aa_changes"), "off_target")


def variant_class(hgvs_p: Column, aa_changes: Column) -> Column:
    """``WT``, ``fs``, ``stop`` (some stop that wasn't there), ``syn`` (all changes silent) or ``mis``."""
    parts = F.split(aa_changes, r"\|")
    silent = F.forall(parts, lambda x: x.endswith("="))
    return F.when(aa_changes == "WT", "WT").when(F.exists(parts, lambda x: x.endswith("fs")), "fs").when(silent, "syn").when(hgvs_p.contains("Ter"), "stop").otherwise("mis")


def apply_calls(sequence: Column, calls: Column) -> Column:
    """The sequence with an array of calls ``pos, kind, alt`` applied, from the last position to the first; calls off the sequence change nothing.

    An insertion ``NinsX`` stands before position N.
    """
    last_first = F.reverse(F.array_sort(F.transform(calls, lambda c: F.struct(c["pos"].alias("pos"), c["kind"].alias("kind"), c["alt"].alias("alt")))))

    def put(s: Column, c: Column) -> Column:
        head, tail = F.substr(s, F.lit(1), c["pos"] - 1), F.substr(s, c["pos"] + F.when(c["kind"] == "ins", 0).otherwise(1), F.length(s))
        return F.when((c["pos"] < 1) | (c["pos"] > F.length(s)), s).otherwise(F.concat(head, F.when(c["kind"] == "del", "").otherwise(c["alt"]), tail))

    return F.aggregate(last_first, sequence, put)
