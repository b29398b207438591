"""Similarity joins, components, clusters and consensus against brute force and hand-made cases."""

import math
import random
import time

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from clonewell.operators import cluster as C, consensus as K, neighbors as N
from clonewell.operators.components import components
from clonewell.session import stage


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("k", [1, 2, 3])
def test_neighbors_are_complete(spark, k):
    r = random.Random(k)
    texts = {"", "A", "AC", "ACGT"}
    for _ in range(25):
        t = "".join(r.choice("ACGT") for _ in range(r.randint(5, 12)))
        texts.add(t)
        for _ in range(3):
            i = r.randrange(len(t))
            t = r.choice([t[:i] + t[i + 1 :], t[:i] + r.choice("ACGT") + t[i:], t[:i] + r.choice("ACGT") + t[i + 1 :]])
            texts.add(t)
    df = spark.createDataFrame([(t,) for t in [*texts, None, "ACGT"]], "seq string")
    want = {(a, b, distance(a, b)) for a in texts for b in texts if a < b and distance(a, b) <= k}
    assert set(map(tuple, N.neighbors(df, df, k, same=True).collect())) == want


@pytest.mark.parametrize("k, parts", [(0, None), (1, None), (1, 2), (2, None), (2, 4)])
def test_neighbors_in_families_are_complete(spark, k, parts):
    r = random.Random(10 * k + (parts or 0))
    loci = ["".join(r.choice("ACGT") for _ in range(n)) for n in (0, 1, 6, 7, 8)]
    texts = {"", "A", "AC", "CA"}
    for _ in range(90):
        t = r.choice(loci) + r.choice(loci)
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(t) + 1)
            t = r.choice([t[:i] + t[i + 1 :], t[:i] + r.choice("ACGT") + t[i:], t[:i] + r.choice("ACGT") + t[i + 1 :]])
        texts.add(t)
    df = spark.createDataFrame([(t,) for t in [*texts, None, "AC"]], "seq string")
    want = {(a, b, d) for a in texts for b in texts if a < b and (d := distance(a, b)) <= k}
    got = list(map(tuple, N.family_neighbors(df, k, parts).collect()))
    assert len(got) == len(want) and set(got) == want


def test_clusters_of_a_frequent_locus(spark):
    """12,000 barcodes that share their first locus, each with one read of its own calls: few are compared, where all pairs of them were before."""
    r, began = random.Random(4), time.time()
    codes = ["ACGTTGCATTGACCAGTACCATGGT" + "".join(r.choice("ACGT") for _ in range(25)) for _ in range(12_000)]
    reads = [(f"r{i:05d}{x}", c) for i, c in enumerate(codes) for x in "ab"] + [("s1", codes[0][:-1] + ("A" if codes[0][-1] != "A" else "C")), ("s2", codes[1][:-1])]
    calls = spark.createDataFrame([(f"r{i:05d}a", i, f"{i}A>G", 90) for i in range(12_000)], "read_id string, pos int, mut string, q int")
    seeds = stage(C.seed_clusters(spark.createDataFrame(reads, "read_id string, barcode string"), calls, 0.2, 1, 32))
    got = {x.read_id: x.cluster for x in C.merge_clusters(seeds, calls, 1, 0.2, 32).collect()}
    assert len(got) == 24_002 and got["s1"] == "s1" and got["s2"] == "s2", "no cluster has twice as many reads"
    more = seeds.unionByName(spark.createDataFrame([("t1", codes[0], "r00000b")], "read_id string, barcode string, cluster string"))
    got = {x.read_id: x.cluster for x in C.merge_clusters(more, calls, 1, 0.2, 32).collect()}
    assert got["s1"] == got["t1"] == "r00000b" and got["s2"] == "s2" and got["r00000a"] == "r00000a"
    assert time.time() - began < 60


def test_clusters_of_a_frequent_barcode(spark, monkeypatch):
    """400 clusters of one barcode and 120 barcodes beside it: they are paired by common calls only, and no table holds each with each."""
    hot, rows = "ACGTTGCATTGACCAGTACCATGGTTCAGCATGCCATTGACGATCCGTAAC", []
    calls = [(f"h{i:03d}{x}", i, f"{i}A>G", 90) for i in range(400) for x in "ab"]
    reads = [(f"h{i:03d}{x}", hot, f"h{i:03d}a") for i in range(400) for x in "ab"]
    codes = [hot[:p] + c + hot[p + 1 :] for p in range(40) for c in "ACGT" if c != hot[p]]
    reads += [(f"v{j:03d}", c, f"v{j:03d}") for j, c in enumerate(codes)]
    calls += [(f"v{j:03d}", 1000 + j, f"{1000 + j}A>G" if j > 9 else f"{j}A>G", 90) for j in range(len(codes))]
    plain = C.stage

    def counted(df, name="stage"):
        out = plain(df, name)
        rows.append((out.count(), name))
        return out

    monkeypatch.setattr(C, "stage", counted)
    seeds, called = spark.createDataFrame(reads, "read_id string, barcode string, cluster string"), spark.createDataFrame(calls, "read_id string, pos int, mut string, q int")
    got = {x.read_id: x.cluster for x in C.merge_clusters(seeds, called, 1, 0.2, 32).collect()}
    assert got == {r: f"h{int(r[1:]):03d}a" if r[0] == "v" and int(r[1:]) < 10 else c for r, _, c in reads}
    assert max(rows)[0] <= len(reads), "120 x 400 pairs before"


def test_calls_decide_on_joins(spark):
    """Clusters one base apart, by calls: none likely, one in common, likely ones of one side only, unlikely ones that are likely together."""
    reads, calls = [], []
    cases = {"AA": ([], []), "CC": ([("1A>G", 90)], [("1A>G", 90)]), "GG": ([("1A>G", 90)], []), "TT": ([], [("2A>G", 90)]), "AC": ([("3A>G", 20)], [("3A>G", 5)]), "AG": ([("4A>G", 20)], [("5A>G", 5)]), "AT": ([("6A>G", 20), ("7C>T", 90)], [("6A>G", 20)])}
    for at, (ours, theirs) in cases.items():
        for i in range(3):
            last = i == 2
            reads.append((f"{at}{i}", at * 10 + ("C" if last else "A"), f"{at}{2 if last else 0}"))
            calls += [(f"{at}{i}", int(m[0]), m, q) for m, q in (theirs if last else ours if i == 0 else [])]
    seeds = spark.createDataFrame(reads, "read_id string, barcode string, cluster string")
    got = {x.read_id: x.cluster for x in C.merge_clusters(seeds, spark.createDataFrame(calls, "read_id string, pos int, mut string, q int"), 1, 0.2, 32).collect()}
    assert {at for at in cases if got[f"{at}2"] == f"{at}0"} == {"AA", "CC", "AC", "AG", "AT"}


def test_nearest(spark):
    q = spark.createDataFrame([("ACGT",), ("ACGA",), ("TTTT",), (None,)], "seq string")
    lib = spark.createDataFrame([("ACGT",), ("ACGG",)], "seq string")
    assert sorted(map(tuple, N.nearest(q, lib, 1).collect())) == [("ACGA", None, 1, 2), ("ACGT", "ACGT", 0, 1)]


def test_alignment_cost(spark):
    df = spark.createDataFrame([(1, "12M1I13M", 26, 25), (1, "25M", 25, 25), (0, None, 5, 5)], "nm int, c string, q int, t int")
    assert [r[0] for r in df.select(N.alignment_cost(F.col("nm"), F.col("c"), F.col("q"), F.col("t"))).collect()] == [2, 1, 0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=14))
def test_components(spark, pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    assert {(r.node, r.component) for r in components(df, "a", "b").collect()} == {(x, root(x)) for x in up}


CALLS = [("r1", 10, "10A>G", 40), ("r2", 10, "10A>G", 35), ("r3", 10, "10A>G", 30), ("r3", 50, "50C>T", 20), ("r4", 10, "10A>G", 20), ("r7", 10, "10A>G", 90), ("r8", 99, "99C>T", 90)]
READS = [("r1", "ACGTACGT"), ("r2", "ACGTACGT"), ("r3", "ACGTACGT"), ("r4", "ACGTACGA"), ("r5", "TTTTTTTT"), ("r6", "TTTTTTTA"), ("r7", "GGGGGGGG"), ("r8", "GGGGGGGG"), ("r9", None)]


@pytest.fixture(scope="module")
def clustered(spark):
    calls = spark.createDataFrame(CALLS, "read_id string, pos int, mut string, q int")
    reads = spark.createDataFrame(READS, "read_id string, barcode string")
    seeds = C.seed_clusters(reads, calls, 0.2, 1, 32)
    return calls, seeds, C.merge_clusters(seeds, calls, 1, 0.2, 32)


def test_seed_clusters(clustered):
    got = {r.read_id: r.cluster for r in clustered[1].collect()}
    assert got["r1"] == got["r2"] == got["r3"] == "r1" and got["r4"] == "r4" and got["r7"] != got["r8"] and "r9" not in got


def test_main_clusters(clustered):
    got = {r.read_id: r.cluster for r in clustered[2].collect()}
    assert got["r4"] == "r1", "a small cluster joins one of at least twice its size"
    assert got["r5"] != got["r6"], "two single reads don't join"


def test_consensus(spark, clustered):
    calls, _, clusters = clustered
    geno = {r.cluster: (r["size"], r.geno) for r in K.consensus_genotypes(clusters, calls, 32).collect()}
    assert geno["r1"] == (4, "10A>G") and geno["r7"] == (1, "10A>G") and geno["r5"] == (1, "=")
    assert {r.cluster: r.consensus for r in K.consensus_barcodes(clusters).collect()}["r1"] == "ACGTACGT"


def test_singleton_threshold(spark):
    clusters = spark.createDataFrame([("a", "x", "A"), ("b", "y", "B")], "read_id string, cluster string, barcode string")
    calls = spark.createDataFrame([("a", 5, "5A>G", 32), ("b", 5, "5A>G", 31)], "read_id string, pos int, mut string, q int")
    assert {r.cluster: r.geno for r in K.consensus_genotypes(clusters, calls, 32).collect()} == {"x": "5A>G", "y": "="}


def test_tied_barcodes(spark):
    data = [("1", "c", "ACGTAC"), ("2", "c", "ACTTAC"), ("3", "c", "ACGTAG"), ("4", "d", "AA"), ("5", "d", "CC")]
    got = K.consensus_barcodes(spark.createDataFrame(data, "read_id string, cluster string, barcode string"))
    assert {r.cluster: r.consensus for r in got.collect()} == {"c": "ACGTAC", "d": "AA"}
    assert K.plurality(["ACGT", "ACT", "ACT"], [1, 1, 1]) == "ACT"


def test_empty(spark):
    calls = spark.createDataFrame([], "read_id string, pos int, mut string, q int")
    reads = spark.createDataFrame([], "read_id string, barcode string")
    seeds = C.seed_clusters(reads, calls)
    assert seeds.collect() == [] and C.merge_clusters(seeds, calls).collect() == []


def test_components_of_a_long_shuffled_chain(spark):
    ids = list(range(600))
    random.Random(3).shuffle(ids)
    df = spark.createDataFrame(list(zip(ids, ids[1:])), "a bigint, b bigint")
    assert {r.component for r in components(df, "a", "b", max_rounds=14).collect()} == {0}


def greedy_walk(reads, calls, max_diff, min_jaccard, min_quality, order):
    """The one-by-one clustering that the rounds replace: pairs of reads in a given order, each joined at once if it may be."""
    def similar(left, right):
        seen = {}
        for side, ids in enumerate((left, right)):
            for i in ids:
                for m, q in calls.get(i, {}).items():
                    seen.setdefault(m, []).append((side, q))
        likely = {m: {s for s, q in v if q > 0} for m, v in seen.items() if sum(q > 0 for _, q in v) > 1 or sum(q for _, q in v) > min_quality}
        both = sum(len(s) == 2 for s in likely.values())
        return not likely or both / len(likely) > min_jaccard

    member = {r: {r} for r in reads}
    codes = sorted(set(reads.values()))
    known = {(a, b): distance(a, b) for a in codes for b in codes}
    for c in codes:
        ids = [r for r in reads if reads[r] == c]
        likely = {}
        for r in ids:
            for m, q in calls.get(r, {}).items():
                likely.setdefault(m, []).append(q)
        kept = {r: {m for m, q in calls.get(r, {}).items() if len(likely[m]) > 1 or sum(likely[m]) > min_quality} for r in ids}
        for i, r in enumerate(ids):
            for s in ids[:i]:
                a, b = kept[r], kept[s]
                if not a and not b or a & b and len(a & b) / len(a | b) > min_jaccard:
                    joined = member[r] | member[s]
                    for x in joined:
                        member[x] = joined
    for d in range(1, max_diff + 1):
        pairs = [(r, s) for r in reads for s in reads if r < s and known[reads[r], reads[s]] == d]
        order.shuffle(pairs)
        for r, s in pairs:
            one, two = member[r], member[s]
            if one is two or abs(math.log2(len(one) / len(two))) < d:
                continue
            if max(known[reads[x], reads[y]] for x in one for y in two) > 2 * d or not similar(one, two):
                continue
            joined = one | two
            for x in joined:
                member[x] = joined
    return {r: min(m) for r, m in member.items()}


def test_agreement_with_the_one_by_one_walk(spark):
    """On a simulated library: share of pairs of reads on which both clusterings agree, of all pairs that one of them puts together."""
    r = random.Random(12)
    clones = [("".join(r.choice("ACGT") for _ in range(20)), {f"{r.randint(1, 90)}A>G" for _ in range(r.randint(0, 3))}) for _ in range(25)]
    reads, calls = {}, {}
    for k in range(260):
        code, muts = clones[min(24, int(r.expovariate(0.12)))]
        if r.random() < 0.25:
            at = r.randrange(20)
            code = code[:at] + r.choice("ACGT") + code[at + 1 :]
        reads[f"r{k:03d}"] = code
        calls[f"r{k:03d}"] = {m: r.randint(25, 60) for m in muts if r.random() < 0.95} | ({f"{r.randint(91, 150)}C>T": r.randint(1, 20)} if r.random() < 0.2 else {})
    df = spark.createDataFrame(list(reads.items()), "read_id string, barcode string")
    called = spark.createDataFrame([(k, int(m[:-3]), m, q) for k, v in calls.items() for m, q in v.items()], "read_id string, pos int, mut string, q int")
    seeds = stage(C.seed_clusters(df, called, 0.2, 1, 32))
    ours = {x.read_id: x.cluster for x in C.merge_clusters(seeds, called, 1, 0.2, 32).collect()}
    together = lambda c: {(a, b) for a in c for b in c if a < b and c[a] == c[b]}
    mine, shares, among = together(ours), [], []
    walks = [together(greedy_walk(reads, calls, 1, 0.2, 32, random.Random(seed))) for seed in range(5)]
    for k, w in enumerate(walks):
        shares.append(len(w & mine) / len(w | mine))
        among += [len(w & v) / len(w | v) for v in walks[:k]]
    print(f"agreement with the walk {min(shares):.3f} to {max(shares):.3f}; of walks in different orders {min(among):.3f} to {max(among):.3f}")
    assert min(shares) > 0.9 and set(ours) == set(reads)


def test_a_barcode_of_very_many_states(spark):
    """100,000 reads of one barcode, each with calls of its own and one that all share: links grow with the states, not with their pairs."""
    reads = spark.range(100_000).select(F.concat(F.lit("r"), F.format_string("%06d", "id")).alias("read_id"), F.lit("ACGT" * 6).alias("barcode"))
    calls = reads.select("read_id", F.explode(F.array(F.lit("5A>G"), F.concat(F.lit("9ins"), "read_id"))).alias("mut")).select("read_id", F.lit(5).alias("pos"), "mut", F.lit(60).alias("q"))
    got = C.seed_clusters(reads, calls, 0.2, 1, 32).groupBy("cluster").count().collect()
    assert [tuple(x) for x in got] == [("r000000", 100_000)]
