"""Sources, sheets, extraction, translation, read calling and streams on small files and tables."""

import gzip

import pytest
from pyspark.sql import functions as F

from clonewell.operators import caller, extract as X, translate as T
from clonewell.functions import seq as S
from clonewell.sources import fastq, sheets, tables
from clonewell.streaming import counts


def write(path, text, packed=False):
    (gzip.open(path, "wt") if packed else open(path, "w")).write(text)
    return str(path)


def fq(records):
    return "".join(f"@{i}\n{s}\n+\n{q}\n" for i, s, q in records)


RECORDS = [(f"r{k} pos={k}" if k % 2 else f"r{k}", "ACGT"[: k % 4 + 1], ("@" + "I" * (k % 4))) for k in range(200)]


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("split", [37, 500, 1 << 20])
def test_fastq_is_read_whole_at_any_split(spark, tmp_path, packed, split):
    path = write(tmp_path / "x_R1.fastq", fq(RECORDS), packed)
    got = fastq.read_fastq(spark, path, split).collect()
    assert sorted((r.read_id + (f" {r.comment}" if r.comment else ""), r.seq, r.qual) for r in got) == sorted(RECORDS)


def test_fastq_split_inside_a_header_gives_each_record_once(tmp_path):
    """Every size of splits, on records with @ in comments, qualities and ids."""
    from clonewell.sources.fastq import FastqReader

    records = [("r1 to=me@lab", "ACGT", "@@II"), ("r@2 @", "AC", "@+"), ("r3", "A", "@"), ("r4 x@y@z", "ACGTACGT", "+@II@@@@"), ("r5", "", "")]
    path = write(tmp_path / "x.fastq", fq(records))
    size = (tmp_path / "x.fastq").stat().st_size
    for split in range(1, size + 2):
        reader = FastqReader({"path": path, "splitbytes": str(split)})
        rows = [r for p in reader.partitions() for r in reader.read(p)]
        assert sorted((f"{i} {c}" if c else i, s, q) for i, c, s, q, _, _ in rows) == sorted(records), split


def test_fastq_folder_roundtrip_and_empty(spark, tmp_path):
    (tmp_path / "in").mkdir()
    path = write(tmp_path / "in" / "s1_R1.fastq", fq(RECORDS))
    write(tmp_path / "in" / "none.fastq", "")
    df = fastq.read_fastq(spark, str(tmp_path / "in"))
    assert df.count() == 200
    fastq.write_fastq(df.coalesce(1), str(tmp_path / "out"), F.col("comment"))
    (part,) = (tmp_path / "out").glob("*.gz")
    assert fastq.read_fastq(spark, str(part)).select("read_id", "comment", "seq", "qual").exceptAll(df.select("read_id", "comment", "seq", "qual")).count() == 0
    samples = spark.createDataFrame([("s1",), ("s",)], "sample string")
    assert {(r.sample, r.mate) for r in tables.with_sample(df, samples).collect()} == {("s1", 1)}
    assert path


def test_mates(spark):
    a = spark.createDataFrame([("r1", "A", "I"), ("r2", "C", "I")], "read_id string, seq string, qual string")
    assert fastq.paired(a, a).count() == 2
    with pytest.raises(Exception, match="mate"):
        fastq.paired(a, a.limit(1)).collect()


def test_text_sources(spark, tmp_path):
    fa = write(tmp_path / "a.fa", ">one first\nac gt\nAC\n>two\n\nTT\n")
    assert sorted(map(tuple, tables.read_fasta(spark, fa).collect())) == [("one", "ACGTAC"), ("two", "TT")]
    counters = write(tmp_path / "c.txt", "failed=3\nbad line\nfailed = 4\nok=1\n")
    assert sorted(map(tuple, tables.read_counters(spark, counters).collect())) == [("failed", 7), ("ok", 1)]
    counted = write(tmp_path / "u.txt", "   3 7\n  12 NA\n")
    assert sorted(map(tuple, tables.read_counts(spark, counted).collect())) == [("7", 3), ("NA", 12)]
    calls = write(tmp_path / "g.csv", '"r1","="\n"r2","5A>G:3;7del:2"\n')
    assert tables.read_delimited(spark, calls, tables.CALLS, header=False).count() == 2
    tables.write_csv(spark.createDataFrame([("x", 1)], "a string, b int"), str(tmp_path / "csv"))
    tables.write_maps(spark.createDataFrame([("m", "A", "F5", 1.0)], "mut string, assay string, cond string, score double"), str(tmp_path / "maps"))
    assert (tmp_path / "maps" / "assay=A" / "cond=F5").exists()


SHEET = """#BEGIN ARGUMENTS
TITLE="run 1"   # a name
BARCODE=SWSW
ORFSTART=3
ORFEND=11
MAXDROPS=5
MINQUALITY=20
MINJACCARD=.2
MINMATCHES=1
MAXDIFF=2
MINCALLQUALITY=40
MODE=virtual
#END ARGUMENTS
#BEGIN SAMPLES
sample\tassay
s1\tA
#END SAMPLES
"""


def test_sheets():
    p = sheets.LibraryParameters.parse(SHEET)
    assert p.title == "run 1" and p.orf_end == 11 and p.min_jaccard == 0.2
    assert sheets.table(sheets.sections(SHEET)["SAMPLES"]) == [{"sample": "s1", "assay": "A"}]
    for bad in (SHEET.replace("MODE=virtual", "MODE=other"), SHEET.replace("ORFEND=11", "ORFEND=12"), SHEET.replace("MAXDIFF=2", "MAXDIFF=x"), SHEET.replace("#END SAMPLES", ""), SHEET.replace("MODE=virtual", "rm -rf $X")):
        with pytest.raises((ValueError, KeyError)):
            sheets.LibraryParameters.parse(bad)


REF = "AACCGGTTACGATCGATTACGGATCCATGCAT"
BC = "GCGCGCGCGC"


def sam(name, flag, pos, cigar, seq, qual):
    return "\t".join([name, str(flag), "ref", str(pos), "60", cigar, "*", "0", "0", seq, qual, "AS:i:1", "NM:i:0", "MD:Z:5"])


def test_extraction(spark, tmp_path):
    amp = X.Amplicon.from_full(REF[:4] + "S" * 10 + REF[4:], "S" * 10, 21, 35)
    assert amp.expected() == [5] and amp.sequence == REF and (amp.orf_start, amp.orf_end) == (11, 25)
    n = len(REF)
    good = REF[:4] + BC + REF[4:14] + "A" + REF[15:20] + REF[22:]  # one substitution, two bases deleted
    lines = [
        "@HD\tVN:1",
        sam("ok", 0, 1, f"4M10I16M2D{n - 22}M", good, "I" * len(good)),
        sam("plain", 0, 1, f"{n}M", REF, "I" * n),
        sam("un", 4, 0, "*", "*", "*"),
        sam("short", 0, 1, "12M", REF[:12], "I" * 12),
        sam("poor", 0, 1, f"4M10I{n - 4}M", REF[:4] + BC + REF[4:], "I" * 4 + "#" * 10 + "I" * (n - 4)),
        # the same insertion placed one base early: C|CBC... instead of CC|BC
        sam("moved", 0, 1, f"3M10I{n - 3}M", REF[:4] + BC + REF[4:], "I" * (n + 10)),
    ]
    reads = tables.read_sam(spark, write(tmp_path / "x.sam", "\n".join(lines) + "\n"))
    got = {r.read_id: r for r in X.extract(reads, amp, max_drops=5, min_quality=20).collect()}
    assert {k: v.fate for k, v in got.items()} == {"ok": "ok", "plain": "missingBarcode", "un": "failedQC", "short": "insufficientCoverage", "poor": "lowQualBarcode", "moved": "ok"}
    assert got["ok"].combo == BC and got["ok"].geno == f"5{REF[14]}>A:40;11del:40;12del:40"
    assert got["moved"].combo == BC and got["moved"].geno == "="
    assert X.forward_pairs(reads).count() == 5


def test_translation(spark):
    orf = "ATGGCTTAA"
    calls = [("a", 5, "sub", "C", "T", "5C>T"), ("b", 4, "sub", "G", "A", "4G>A"), ("b", 5, "sub", "C", "A", "5C>A"), ("c", 6, "sub", "T", "C", "6T>C"), ("d", -5, "sub", "A", "G", "-5A>G"), ("d", 31, "del", "", "", "31del"), ("e", 5, "ins", "", "A", "5insA"), ("f", 7, "sub", "G", "A", "7G>A"), ("g", 6, "sub", "T", "G", "6T>G"), ("g", 9, "sub", "A", "G", "9A>G")]
    df = spark.createDataFrame(calls, "k string, pos int, kind string, ref string, alt string, mut string")
    got = {r.k: r for r in T.translations(df, orf, ["k"]).collect()}
    assert {k: r.hgvs_p for k, r in got.items()} == {"a": "p.Ala2Val", "b": "p.Ala2Asn", "c": "p.Ala2=", "d": "p.=", "e": "p.Ala2fs", "f": "p.=", "g": "p.[Ala2=;Ter3=]"}
    assert got["d"].off_target == "-5A>G;31del" and got["d"].hgvs_c == "=" and got["a"].aa_changes == "A2V" and got["d"].aa_changes == "WT"


def test_translation_tracks_the_frame(spark):
    """Ten inserted bases and, much later, one deleted one: all codons between are read as they stand, and what follows is in frame again."""
    orf = "ATG" + "GCTGAACGT" * 9 + "TAA"

    def calls(key, text):
        parts = spark.range(1).select(F.explode(S.calls_of(F.lit(";".join(f"{x}:1" for x in text.split(";"))))).alias("c")).select("c.*").collect()
        return [(key, r.pos, r.kind, r.ref, r.alt, r.mut) for r in parts]

    cases = {"ins3": "7insAAA", "del3": "7del;8del;9del", "back": "7insA;11del", "open": "10insACGTACGTAC;80del;40A>G", "later": "7insA;11del;14C>T", "six": "4del;5del;6del;7del;8del;9del", "cross": "6del;7del;8del"}
    rows = [r for k, t in cases.items() for r in calls(k, t)]
    df = spark.createDataFrame(rows, "k string, pos int, kind string, ref string, alt string, mut string")
    got = {r.k: r for r in T.translations(df, orf, ["k"]).collect()}
    edited = {k: spark.range(1).select(T.apply_calls(F.lit(orf), S.calls_of(F.lit(";".join(f"{x}:1" for x in t.split(";")))))).first()[0] for k, t in cases.items()}
    protein = lambda s: "".join(S.CODONS[s[i : i + 3]] for i in range(0, len(s) - 2, 3))
    assert got["ins3"].hgvs_p == "p.Glu3delinsLysGlu" and got["ins3"].aa_changes == "E3KE" and got["ins3"].codon_hgvs == "c.7_9delinsAAAGAA"
    assert got["del3"].hgvs_p == "p.Glu3del" and got["del3"].aa_changes == "E3-" and got["del3"].codon_changes == "GAA3-"
    assert got["six"].hgvs_p == "p.[Ala2del;Glu3del]"
    assert got["cross"].aa_changes == "AE2A" and got["cross"].hgvs_p == "p.Ala2_Glu3delinsAla"
    assert got["back"].aa_changes == "ER3" + protein(edited["back"])[2:4] and not got["back"].aa_changes.endswith("fs")
    assert got["later"].aa_changes == got["back"].aa_changes + "|A5V"
    old, new = protein(orf), protein(edited["open"])
    assert len(edited["open"]) % 3 == 0 and got["open"].aa_changes == old[3:27] + "4" + new[3:30]


def test_apply_calls(spark):
    def apply(seq, geno):
        out = list(seq)
        for c in sorted(geno, key=lambda c: -c[0]):
            if 1 <= c[0] <= len(seq):
                out[c[0] - 1 : c[0] - (c[1] == "ins")] = "" if c[1] == "del" else c[2]
        return "".join(out)

    for calls in ([(3, "sub", "T"), (5, "del", ""), (7, "ins", "GG")], [(99, "sub", "A"), (-1, "del", "")], [(1, "del", ""), (8, "ins", "C")]):
        text = ";".join({"sub": f"{p}A>{a}:1", "del": f"{p}del:1", "ins": f"{p}ins{a}:1"}[k] for p, k, a in calls)
        got = spark.range(1).select(T.apply_calls(F.lit("ACGTACGT"), S.calls_of(F.lit(text)))).first()[0]
        assert got == apply("ACGTACGT", calls)


def test_read_caller(spark):
    flank = lambda b: f"TTAACC{b}GGTTAA"
    reads = spark.createDataFrame([("s", "1", flank("ACGTACGT")), ("s", "2", flank("ACGTACGA")), ("s", "3", "TTTT"), ("s", "4", flank("CCCCCCCC"))], "sample string, read_id string, seq string")
    lib = spark.createDataFrame([("ACGTACGT",), ("GGGGGGGG",)], "seq string")
    barcodes = caller.read_barcodes(reads, "AACC", "GGTT", 8, 1)
    got = sorted(map(tuple, caller.call_reads(barcodes, lib, 1).collect()), key=repr)
    assert got == [("s", "failedExtraction", None, 1), ("s", "hit", "ACGTACGT", 2), ("s", "noMatch", None, 1)]
    back = reads.select("sample", "read_id", S.reverse_complement(F.col("seq")).alias("seq2"), F.lit("A").alias("seq"))
    assert caller.call_reads(caller.read_barcodes(back, "AACC", "GGTT", 8, 1), lib, 1).where("fate = 'hit'").first().n == 2


def test_stream_gives_the_counts_of_the_table(spark, tmp_path):
    t = spark.read.parquet("/root/testdata/sf0.001/barcode_lines.parquet")
    t.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = counts.running_fates(counts.arriving_lines(spark, str(tmp_path / "in"), t.schema, 1))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("fates").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("fates").collect())) == sorted(map(tuple, counts.running_fates(t).collect()))
    assert counts.daily_counts(t).agg(F.sum("n")).first()[0] == t.count()
