"""Queries of the numbered problems on the smallest tables: against SQL, brute force, or their own conditions."""

import compare
import pytest

from clonewell.llm import queries as Q
from clonewell.llm.leakage import words_of


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_same_rows_as_sql(spark, small_tables, name):
    folder, con = small_tables
    assert compare.spark_rows(Q.QUERIES[name](spark, folder)) == compare.sql_rows(con, Q.SQL[name])


def test_leaks_are_those_of_brute_force(spark, small_tables):
    folder, con = small_tables
    grams = {}
    for i, t in con.execute("SELECT item_id, text FROM eval_items").fetchall():
        w = words_of(t)
        n = min(12, len(w))
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    want = set()
    for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall():
        w = words_of(t)
        for n in {len(g) for g in grams}:
            want |= {(d, i) for k in range(len(w) - n + 1) for i in grams.get(tuple(w[k : k + n]), ())}
    assert set(map(tuple, Q.QUERIES["p6_found"](spark, folder).collect())) == want
    assert Q.QUERIES["p6_leaks"](spark, folder).where("verbatim").count() == len(want)


def test_mixture(spark, small_tables):
    folder, con = small_tables
    cap = dict(con.execute("SELECT replace(replace(lower(source), ' ', '-'), '_', '-'), max_repeat FROM mix_targets").fetchall())
    rows = Q.QUERIES["p7_mix"](spark, folder).collect()
    assert rows and all(1 <= r.copies <= cap[r.source] for r in rows)
    shares = Q.QUERIES["p7_shares"](spark, folder).collect()
    assert len(shares) == 10 and sum(r.reached_share for r in shares) == pytest.approx(1)


def test_garbled(spark, small_tables):
    folder, _ = small_tables
    found = Q.QUERIES["p8_found"](spark, folder)
    assert found.columns == ["doc_id"] and found.count() == Q.QUERIES["p8_repaired"](spark, folder).count() > 0
