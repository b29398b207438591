"""Barcode similarity joins by blocking: exact recall for edit distances up to k, without comparing all pairs."""

from __future__ import annotations

from functools import reduce
from itertools import combinations, pairwise, product

from pyspark.sql import Column, DataFrame, functions as F


def _pieces(seq: Column, k: int) -> Column:
    """Array of (number, text, length of the whole) of the k + 1 pieces a sequence is cut into, as evenly as possible."""
    n, parts = F.length(seq), k + 1
    cut = lambda i: (n * i / parts).cast("int")
    return F.array(*(F.struct(F.lit(i).alias("i"), F.substr(seq, cut(i) + 1, cut(i + 1) - cut(i)).alias("text"), n.alias("n")) for i in range(parts)))


def neighbors(left: DataFrame, right: DataFrame, k: int, same: bool = False) -> DataFrame:
    """``a, b, dist``: pairs of distinct texts of ``left`` and ``right`` (columns ``seq``) with an edit distance of at most k.

    By the pigeonhole principle, one of the k + 1 pieces of b stands unchanged in a, moved by at most
    k. So pieces of the right side are joined by equality with the substrings of the left side that
    could be one, and candidates are confirmed by ``levenshtein`` with a limit. Recall is complete. Of the shifts only
    those are tried that leave enough edits for the rest: piece i of k + 1 (from 0) may have moved by i at most, and,
    seen from the other end, by k - i beyond the difference of the lengths.

    The right side gives k + 1 rows a text, the left side more, so the larger one belongs right. Pairs of
    sequences that share a frequent piece are candidates; the join is skewed by such pieces at most in
    the number of distinct sequences, as each text is taken once.

    With ``same``, left and right are the same texts, and each pair comes once with a < b. Texts shorter
    than k + 1 are compared through empty pieces, by length. Null texts pair with nothing.
    """
    lefts = left.select(F.col("seq").alias("a")).where("a IS NOT NULL").distinct()
    rights = right.select(F.col("seq").alias("b")).where("b IS NOT NULL").distinct()
    pieces = rights.select("b", F.explode(_pieces(F.col("b"), k)).alias("p")).select("b", "p.i", F.col("p.text").alias("piece"), F.col("p.n").alias("n"))
    # on the left side, for each length b may have and each shift, the substring where the piece would be
    longest = 0 if same else k  # of equal texts the longer one looks for the shorter one
    sizes = lefts.select("a", F.explode(F.array(*(F.length("a") + d for d in range(-k, longest + 1)))).alias("n")).where("n >= 0")
    spots = F.flatten(F.array(*(_spots(k, i) for i in range(k + 1))))
    probes = sizes.select("a", "n", F.explode(F.filter(spots, lambda s: (s["at"] >= 1) & (s["at"] + s["len"] - 1 <= F.length("a")))).alias("s"))
    probes = probes.select("a", "n", "s.i", F.col("s.piece").alias("piece")).distinct()
    pairs = probes.join(pieces, ["i", "piece", "n"]).select("a", "b")
    if same:
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.distinct().withColumn("dist", F.levenshtein("a", "b", k)).where("dist >= 0")


def _spots(k: int, i: int) -> Column:
    """Where piece i of a text b of length n may stand in a: array of (i, piece, at, len)."""
    cut = lambda j: (F.col("n") * j / (k + 1)).cast("int")
    width, extra = cut(i + 1) - cut(i), F.length("a") - F.col("n")
    shifts = F.filter(F.array(*(F.lit(d) for d in range(-i, i + 1))), lambda d: F.abs(d - extra) <= k - i)
    return F.transform(shifts, lambda d: F.struct(F.lit(i).alias("i"), F.substr(F.col("a"), cut(i) + 1 + d, width).alias("piece"), (cut(i) + 1 + d).alias("at"), width.alias("len")))


def _frames(parts: int, k: int, extra: int) -> list[tuple[tuple[int, ...], list[tuple[int, int, int]]]]:
    """For all ways that k of a text's pieces may hold all edits: (those pieces, runs of pieces between them as (from, to, shift)), where the other text has ``extra`` characters more."""
    found = {}
    for touched in combinations(range(parts), k):
        ends = [-1, *touched, parts]
        for inner in product(range(-k, k + 1), repeat=max(0, k - 1)):
            shifts = [0, *inner, extra] if k else [0]
            if sum(abs(y - x) for x, y in pairwise(shifts)) <= k:
                runs = tuple((x + 1, y, s) for (x, y), s in zip(pairwise(ends), shifts) if x + 1 < y)
                found.setdefault((touched, runs), None)
    return [(touched, list(runs)) for touched, runs in found]


def family_neighbors(texts: DataFrame, k: int, parts: int | None = None) -> DataFrame:
    """``a, b, dist``: ``neighbors`` of the texts (column ``seq``) among themselves, each pair once with a < b, for texts that share long pieces, such as barcodes joined from several loci.

    Texts are cut into many pieces (``parts``, 5 k if not given), and all but k of them must stand unchanged, moved by what the edits between allow. So
    candidates agree in nearly all of their characters, not in one piece of k + 1, which a frequent barcode of one locus fills; they are joined by a hash of
    what is unchanged, and confirmed by ``levenshtein``. Recall is complete. Keys grow with the k-th power of ``parts``, so this is for small k.
    """
    parts = max(k + 1, 5 * k if parts is None else parts)
    known = texts.select("seq").where("seq IS NOT NULL").distinct()

    def keys(n: Column, extra: int) -> list[Column]:
        cut = lambda j: (n * j / parts).cast("int")
        return [F.xxhash64(F.lit(str(touched)), n, *(F.substr(F.col("seq"), cut(x) + 1 + s, cut(y) - cut(x)) for x, y, s in runs)) for touched, runs in _frames(parts, k, extra)]

    own = known.select(F.col("seq").alias("b"), F.explode(F.array(*keys(F.length("seq"), 0))).alias("key"))
    # the longer text of a pair looks for the shorter one
    probes = known.select(F.col("seq").alias("a"), F.explode(F.array(*(key for d in range(k + 1) for key in keys(F.length("seq") - d, d)))).alias("key"))
    pairs = probes.join(own, "key").where((F.length("a") > F.length("b")) | (F.col("a") < F.col("b")))
    near = pairs.select("a", "b", F.levenshtein("a", "b", k).alias("dist")).where("dist >= 0")
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "dist").distinct()


def nearest(queries: DataFrame, library: DataFrame, k: int) -> DataFrame:
    """``seq, hit, diffs, nhits``: for each distinct query text within k of a library text, the nearest one.

    ``nhits`` counts the library texts at that distance; ``hit`` is null where there are several.
    """
    near = neighbors(library, queries, k)
    best = near.groupBy(F.col("b").alias("seq")).agg(F.min(F.struct("dist", F.col("a").alias("hit"))).alias("m"), *(F.count_if(F.col("dist") == d).alias(f"n{d}") for d in range(k + 1)))
    nhits = reduce(lambda c, d: c.when(F.col("m.dist") == d, F.col(f"n{d}")), range(k + 1), F.when(F.lit(False), F.lit(0).cast("bigint")))
    return best.select("seq", F.when(nhits == 1, F.col("m.hit")).alias("hit"), F.col("m.dist").alias("diffs"), nhits.alias("nhits"))


def alignment_distance(nm: Column, cigar: Column, query_length: Column, target_length: Column) -> Column:
    """``mismatch, indel, dist`` of an aligned barcode: mismatches are the edits less inserted and deleted bases; indels are those bases and the difference of lengths.

    So an inner indel of one base costs 2 (once as an indel, once by the lengths), one at an end, which the alignment leaves out, 1.
    """
    total = lambda op: F.coalesce(F.aggregate(F.regexp_extract_all(cigar, F.lit(rf"(\d+){op}"), 1), F.lit(0), lambda a, x: a + x.cast("int")), F.lit(0))
    inner = total("I") + total("D")
    mismatch, indel = nm - inner, inner + F.abs(query_length - target_length)
    return F.struct(mismatch.alias("mismatch"), indel.alias("indel"), (mismatch + indel).alias("dist"))


def alignment_cost(nm: Column, cigar: Column, query_length: Column, target_length: Column) -> Column:
    """The ``dist`` of ``alignment_distance``."""
    return alignment_distance(nm, cigar, query_length, target_length)["dist"]


def _differing(a: Column, b: Column) -> Column:
    """Places at which two texts differ, over the length of the shorter one."""
    places = F.sequence(F.lit(1), F.least(F.length(a), F.length(b)))
    return F.when(F.least(F.length(a), F.length(b)) == 0, F.lit(0)).otherwise(F.size(F.filter(places, lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1)))))


def pipeline_distance(a: Column, b: Column, edits: Column) -> Column:
    """The distance by ``alignment_distance`` of two barcodes with known edit distance: the best of an alignment of all of both, and of one that leaves what the longer one has too many over at an end."""
    over = F.abs(F.length(a) - F.length(b))
    front, back = _differing(a, b), _differing(F.reverse(a), F.reverse(b))
    return (F.least(edits, front, back) + over).cast("int")


def barcode_distances(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """``a, b, dist``: pairs of distinct texts whose ``pipeline_distance`` is at most k; it is never below the edit distance, so none is missed."""
    near = neighbors(left, right, k).where("a <> b")
    return near.select("a", "b", pipeline_distance(F.col("a"), F.col("b"), F.col("dist")).alias("dist")).where(F.col("dist") <= k)
