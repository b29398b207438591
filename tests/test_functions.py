"""Column functions on hand-made values."""

import pytest
from pyspark.sql import functions as F

from clonewell.functions import latest, reads, seq as S


def one(spark, *cols):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(cols))).first())


def test_reverse_complement_and_degenerate(spark):
    assert one(spark, S.reverse_complement(F.lit("ACGTN")), S.reverse_complement(F.lit("")), S.clean_sequence(F.lit(" ac\ngt "))) == ("NACGT", "", "ACGT")
    assert S.degenerate_pattern("SW") == "[CGN][ATN]"


def test_phred(spark):
    got = one(spark, S.phred(F.lit("!I~")), S.phred(F.lit("")), S.mean_phred(F.lit("#$")), S.mean_phred(F.lit("")), S.quality_string(F.array(F.lit(100), F.lit(-3), F.lit(40))))
    assert got == ([0, 40, 93], [], 2, None, "~!I")


def test_positions_and_flanks(spark):
    got = one(
        spark,
        S.first_position(F.lit("GTCAGTC"), F.lit("GTC")),
        S.last_position(F.lit("GTCAGTC"), F.lit("GTC")),
        S.first_position(F.lit("AAAA"), F.lit("GTC")),
        S.without(F.lit("GTCAGTC"), F.lit("GTC")),
        S.positions_of(F.lit("AANA"), "AA"),
        S.positions_of(F.lit("A"), "AA"),
        S.between_flanks(F.lit("TTACGTCCCCGGAATT"), "ACG", "GGA", 5, 1),
        S.between_flanks(F.lit("TTNCGTCCCCGGAATT"), "ACG", "GGA", 5, 1),
        S.between_flanks(F.lit("TTNCGTCC"), "ACG", "GGA", 5, 1),
    )
    assert got == (1, 5, None, "A", [1, 2, 3], [], "TCCCC", "TCCCC", None)


def test_calls(spark):
    (c,) = one(spark, S.calls_of(F.lit("-5A>G:30; 13insAC:2;31del:7;junk;4N>A:1")))
    assert [(x.pos, x.kind, x.ref, x.alt, x.q, x.mut) for x in c] == [(-5, "sub", "A", "G", 30, "-5A>G"), (13, "ins", "", "AC", 2, "13insAC"), (31, "del", "", "", 7, "31del")]
    assert one(spark, S.calls_of(F.lit("=")), S.calls_of(F.lit(None).cast("string")), S.insertion_notation(F.lit("13insA")), S.insertion_notation(F.lit("7C>T"))) == ([], None, "12_13insA", "7C>T")


def test_numbers(spark):
    got = one(
        spark,
        S.digits(F.lit("12_13insA")),
        S.digits(F.lit("abc")),
        S.size_ratio(F.lit(8), F.lit(2)),
        S.size_ratio(F.lit(0), F.lit(2)),
        S.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))),
        S.jaccard(F.array().cast("array<string>"), F.array().cast("array<string>")),
        S.log_ratio(F.lit(0.0), F.lit(0.0), F.lit(0.1)),
        S.finite(F.lit(float("inf"))),
        S.finite(F.lit(None).cast("double")),
        S.finite(F.lit(1.5)),
    )
    assert got == ("1213", None, 2.0, None, 0.5, 1.0, None, False, False, True)


def test_codons(spark):
    assert len(S.CODONS) == 64 and S.CODONS["ATG"] == "M" and S.CODONS["TGA"] == "*"
    assert one(spark, S.amino_acid(F.lit("atg")), S.amino_acid(F.lit("NNN")), S.three_letters(F.lit("*"))) == ("M", None, "Ter")


@pytest.mark.parametrize(
    "text, want",
    [("m1_2_3/45/ccs", ("m1_2_3", 45)), ("@M1_2_3/0045/CCS np=9", ("m1_2_3", 45)), (" m1_2_3/45 ", ("m1_2_3", 45)), ("nothing", (None, None)), ("", (None, None)), (None, (None, None))],
)
def test_read_ids(spark, text, want):
    assert one(spark, reads.movie_of(F.lit(text).cast("string")), reads.hole_of(F.lit(text).cast("string"))) == want


def test_usable_values(spark):
    got = one(
        spark,
        reads.sequence_of(F.lit(" acGT ")),
        reads.sequence_of(F.lit("ACNT")),
        reads.sequence_of(F.lit("")),
        reads.usable_qual(F.lit("!!!"), F.lit(3)),
        reads.usable_qual(F.lit("!I!"), F.lit(3)),
        reads.usable_qual(F.lit("II"), F.lit(3)),
        reads.usable_qual(F.lit(None).cast("string"), F.lit(3)),
        reads.operation_of(F.lit(" SNV")),
        reads.operation_of(F.lit("?")),
        reads.operation_of(F.lit("Ins")),
    )
    assert got == ("ACGT", None, None, False, True, False, False, "sub", None, "ins")


def test_recency_key_orders_and_unpacks(spark):
    rows = [(1, "2026-01-01 00:00:00"), (2, None), (-9, "2026-01-01 00:00:00"), (3, "1969-05-05 01:02:03"), (2**62, "9998-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "id bigint, t string").select("id", F.col("t").cast("timestamp").alias("t"))
    got = df.select("id", latest.recency_key(F.col("t"), F.col("id")).alias("k")).orderBy("k").select("id", latest.id_of(F.col("k"))).collect()
    assert [r[0] for r in got] == [2**62, -9, 1, 3, 2] and all(a == b for a, b in got)
