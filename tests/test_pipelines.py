"""Both pipelines on simulated reads whose clones and effects are known."""

import random

import pytest

from clonewell.operators.extract import Amplicon
from clonewell.plans.pipelines import build_library, score_assay
from clonewell.sources.sheets import LibraryParameters
from clonewell.sources.tables import read_sam

ORF = "ATGGCTGATTGTGAATTTGGTCATATTAAACTTATGAATCCTCAACGTTCTACTGTTTGGTATTAA"
LEFT, RIGHT = "ACGTTGCAAC", "GGATCCTTAG"
CHANGES = {5: "T", 12: "A", 22: "G"}  # position in the frame -> base


def simulate(r):
    """(SAM lines, barcode -> set of changed positions)."""
    clones, lines = {}, []
    for k in range(8):
        code = "".join(r.choice("ACGT") for _ in range(12))
        clones[code] = set(r.sample(sorted(CHANGES), k % 3))
    full = len(LEFT) + len(ORF) + len(RIGHT)
    for code, changed in clones.items():
        for n in range(6):
            orf = "".join(CHANGES[i] if i in changed else b for i, b in enumerate(ORF, 1))
            seen = code if n else code[:5] + ("A" if code[5] != "A" else "C") + code[6:]  # one read with an error
            seq = LEFT + seen + orf + RIGHT
            lines.append("\t".join([f"{code}/{n}", "0", "ref", "1", "60", f"{len(LEFT)}M12I{full - len(LEFT)}M", "*", "0", "0", seq, "I" * len(seq)]))
    lines.append("\t".join(["lost", "4", "*", "0", "0", "*", "*", "0", "0", "ACGT", "IIII"]))
    return lines, clones


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    lines, clones = simulate(random.Random(4))
    path = tmp_path_factory.mktemp("sam") / "reads.sam"
    path.write_text("\n".join(lines) + "\n")
    amp = Amplicon.from_full(LEFT + "N" * 12 + ORF + RIGHT, "N" * 12, len(LEFT) + 13, len(LEFT) + 12 + len(ORF))
    p = LibraryParameters("t", "N" * 12, len(LEFT) + 13, len(LEFT) + 12 + len(ORF), 5, 10.0, 0.2, 1, 1, 30, "virtual")
    return build_library(read_sam(spark, str(path)), amp, p), clones


def test_clones_are_recovered(built):
    lib, clones = built
    got = {r.virtual: r for r in lib.strict.collect()}
    assert set(got) == set(clones)
    for code, changed in clones.items():
        assert got[code]["size"] == 6 and got[code].geno == (";".join(f"{p}{ORF[p - 1]}>{CHANGES[p]}" for p in sorted(changed)) or "=")
    assert {r.fate: r.n for r in lib.fates().collect()} == {"ok": 48, "failedQC": 1}
    assert lib.soft.count() == 8 and {r.aa_changes for r in got.values() if r.geno == "="} == {"WT"}


def test_scores_follow_the_counts(spark, built):
    lib, clones = built
    table = lib.strict.selectExpr("virtual AS barcode", "aa_changes", "hgvs_p")
    samples = spark.createDataFrame([("a1", "A", "All", 1), ("a2", "A", "All", 2), ("s1", "A", "Sel", 1), ("s2", "A", "Sel", 2)], "sample string, assay string, cond string, replicate int")
    codes = sorted(clones)
    rows = []
    for s in ("a1", "a2", "s1", "s2"):
        for code in codes:
            times = 20 if s[0] == "a" or not clones[code] else 5
            rows += [(s, f"{s}/{code}/{n}", code if n else code[:-1]) for n in range(times)]
    rows.append(("a1", "x", None))
    out = score_assay(spark.createDataFrame(rows, "sample string, read_id string, barcode string"), table, samples, "A", "Sel")
    assert {(r.sample, r.fate) for r in out.counts.where("fate <> 'hit'").collect()} == {("a1", "failedExtraction")}
    assert out.counts.where("fate = 'hit'").groupBy().sum("n").first()[0] == len(rows) - 1
    lr = {r.lib_row: r.lr for r in out.ratios.collect()}
    assert min(lr[c] for c in codes if not clones[c]) > max(lr[c] for c in codes if clones[c])
    assert out.variants.count() > 0 and out.joint.where("mut = '='").count() == 0
