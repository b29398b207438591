"""Column expressions on sequences, qualities and variant texts, all on the JVM; those with lambdas over arrays are interpreted there, the others run in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Complements, and the standard genetic code with bases in the order TCAG.
_BASES, _COMPLEMENTS = "ACGTUNRYSWKMBDHVacgtn", "TGCAANYRSWMKVHDBtgcan"
_ORDER = "TCAG"
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: _AMINO[16 * i + 4 * j + k] for i, a in enumerate(_ORDER) for j, b in enumerate(_ORDER) for k, c in enumerate(_ORDER)}
# Three-letter names of amino acids.
THREE = dict(zip("ARNDCQEGHILKMFPSTWYV*", "Ala Arg Asn Asp Cys Gln Glu Gly His Ile Leu Lys Met Phe Pro Ser Thr Trp Tyr Val Ter".split()))
# Fixed value: degenerate base codes as sets of bases.
IUPAC = dict(A="A", C="C", G="G", T="T", R="AG", Y="CT", S="CG", W="AT", K="GT", M="AC", B="CGT", D="AGT", H="ACT", V="ACG", N="ACGT")


def clean_sequence(c: Column) -> Column:
    """Upper case without any white space."""
    return F.upper(F.regexp_replace(c, r"\s+", ""))


def reverse_complement(c: Column) -> Column:
    """Reverse complement; degenerate codes are complemented too, other characters stay."""
    return F.reverse(F.translate(c, _BASES, _COMPLEMENTS))


def degenerate_pattern(code: str) -> str:
    """Regular expression for a degenerate code such as ``SWN``; an N in the text matches too."""
    return "".join(f"[{IUPAC[x]}N]" for x in code.upper())


def phred(qual: Column) -> Column:
    """Array of Phred values of a quality string with offset 33; empty for an empty string."""
    return F.when(F.length(qual) == 0, F.array().cast("array<int>")).otherwise(F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33))


def quality_string(values: Column, cap: int = 93) -> Column:
    """Quality string of an array of Phred values, each held within 0 and ``cap``."""
    return F.array_join(F.transform(values, lambda q: F.char(F.greatest(F.lit(0), F.least(q, F.lit(cap))) + 33)), "")


def mean_phred(qual: Column) -> Column:
    """Mean Phred value, rounded half to even; null for an empty string."""
    values = phred(qual)
    return F.bround(F.aggregate(values, F.lit(0), lambda a, q: a + q) / F.nullif(F.size(values), F.lit(0))).cast("int")


def without(c: Column, part: Column) -> Column:
    """All occurrences of ``part`` cut out; an empty or null part changes nothing."""
    return F.when(F.coalesce(F.length(part), F.lit(0)) == 0, c).otherwise(F.replace(c, part, F.lit("")))


def first_position(c: Column, part: Column) -> Column:
    """1-based position of the first occurrence; null if there is none."""
    return F.nullif(F.instr(c, part), F.lit(0))


def last_position(c: Column, part: Column) -> Column:
    """1-based position of the last occurrence; null if there is none."""
    back = F.instr(F.reverse(c), F.reverse(part))
    return F.when(back > 0, F.length(c) - back - F.length(part) + 2)


def digits(c: Column) -> Column:
    """All digits of a text, joined; null if there is none. Signs are lost, as ``12_13`` gives 1213."""
    return F.nullif(F.regexp_replace(c, r"\D+", ""), F.lit(""))


def positions_of(text: Column, motif: str) -> Column:
    """1-based positions of all matches of a motif, overlapping ones too; an N in the text matches any base."""
    pattern = "^" + degenerate_pattern(motif)
    last = F.length(text) - len(motif) + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.filter(starts, lambda i: F.substr(text, i, F.lit(len(motif))).rlike(pattern))


def between_flanks(text: Column, up: str, down: str, length: int, slack: int) -> Column:
    """The part between two flanks if exactly one pair of matches lies ``length`` bases apart, up to ``slack``; else null.

    An exact match of both flanks is tried first; only then are N read as any base.
    """
    exact = F.regexp_extract(text, f"{up}([ACGTN]{{{length - slack},{length + slack}}}?){down}", 1)
    pairs = F.flatten(
        F.transform(
            positions_of(text, up),
            lambda a: F.transform(
                F.filter(positions_of(text, down), lambda b: (b - a - len(up) >= length - slack) & (b - a - len(up) <= length + slack)),
                lambda b: F.substr(text, a + len(up), b - a - len(up)),
            ),
        )
    )
    return F.when(exact != "", exact).when(F.size(pairs) == 1, F.get(pairs, F.lit(0)))


def flank_ends(up: str, down: str, n: int = 5) -> tuple[str, str]:
    """The last ``n`` bases of the flank before a barcode and the first ``n`` of the one behind it."""
    return up[max(0, len(up) - n) :], down[:n]


def calls_of(geno: Column) -> Column:
    """Array of calls ``pos, kind (sub, ins, del), ref, alt, q, mut`` of a packed genotype; ``=`` gives an empty one.

    Texts that are no call are left out. ``mut`` is the call without its quality.
    """

    body = r"^(-?\d+)(?:([ACGT])>([ACGT])|(ins)([ACGT]+)|(del)):(-?\d+)$"
    calls = F.filter(F.transform(F.split(geno, ";"), lambda x: F.trim(x)), lambda x: x.rlike(body))

    def call(x: Column) -> Column:
        parts = F.split(F.regexp_replace(x, body, "$1,$2,$3$5,$4$6,$7"), ",")
        return F.struct(
            parts[0].cast("int").alias("pos"), F.when(parts[3] == "", "sub").otherwise(parts[3]).alias("kind"), parts[1].alias("ref"), parts[2].alias("alt"), parts[4].cast("int").alias("q"), F.substring_index(x, ":", 1).alias("mut")
        )

    return F.transform(calls, call)


def insertion_notation(mut: Column) -> Column:
    """``NinsX`` as ``(N-1)_NinsX``; other calls as they are."""
    n = F.regexp_extract(mut, r"^(-?\d+)ins", 1)
    return F.when(n != "", F.concat((n.cast("int") - 1).cast("string"), F.lit("_"), mut)).otherwise(mut)


def in_frame(pos: Column, orf_length: int | Column) -> Column:
    """Whether a position relative to the reading frame lies inside it."""
    return (pos >= 1) & (pos <= orf_length)


def size_ratio(a: Column, b: Column) -> Column:
    """|log2(a / b)| of two positive sizes; null else."""
    return F.when((a > 0) & (b > 0), F.abs(F.log2(a / b)))


def older_merge(size1: Column, size2: Column, barcode_dist: Column, geno_dist: Column, similarity: Column, min_jaccard: float) -> Column:
    """Whether the older clustering joins two clusters: always without any distance, else if their calls are similar enough and either both are small
    (4 reads at most) or their sizes differ by a factor whose logarithm to base 2 is at least 2^(distance of barcodes - 3)."""
    uneven = (F.greatest(size1, size2) <= 4) | (size_ratio(size1, size2) >= F.pow(F.lit(2.0), barcode_dist - 3))
    return (barcode_dist + geno_dist == 0) | (uneven & (similarity >= min_jaccard))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays as sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.nullif(union, F.lit(0)))


def log_ratio(selected: Column, all_: Column, pseudo: Column) -> Column:
    """log10(selected + pseudo) - log10(all); null where a logarithm doesn't exist."""
    return F.when((selected + pseudo > 0) & (all_ > 0), F.log10(selected + pseudo) - F.log10(all_))


def log_ratio_sd(sd1: Column, mean1: Column, sd0: Column, mean0: Column, pseudo: Column) -> Column:
    """Standard deviation of a log ratio by the delta method."""
    part = lambda sd, mean: F.when(mean > 0, F.pow(sd / (F.lit(2.302585092994046) * mean), 2))
    return F.sqrt(part(sd1, mean1 + pseudo) + part(sd0, mean0))


def finite(c: Column) -> Column:
    """Whether a double is neither null, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))


def product_sd(product: Column, *terms: tuple[Column, Column]) -> Column:
    """Standard deviation of a product (or quotient) from (value, sd) of its terms."""
    return F.abs(product) * F.sqrt(reduce(lambda a, b: a + b, (F.pow(sd / value, 2) for value, sd in terms)))


def amino_acid(codon: Column) -> Column:
    """One-letter amino acid of a codon by the standard code; null for anything else."""
    table = F.create_map(*(F.lit(x) for pair in CODONS.items() for x in pair))
    return F.try_element_at(table, F.upper(codon))


def three_letters(amino: Column) -> Column:
    """Three-letter name of a one-letter amino acid; ``Ter`` for a stop."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in THREE.items() for x in pair)), amino)
