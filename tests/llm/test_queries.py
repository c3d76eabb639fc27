import pytest
from conftest import SF_MID, SF_SMALL
from oracle_harness import compare, duck

import __spark_entry__ as entry
from seclake.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF_MID), name, queries.QUERIES[name], queries.ORACLE[name], SF_MID)


def test_each_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_simhash_query_equals_brute_force(spark):
    import numpy as np
    from seclake.llm import simhash
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    prints = {i: simhash.fingerprint(t, 4) for i, t in docs.items()}
    ids = sorted(prints)
    bits = np.array([prints[i] for i in ids], dtype=np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4
    group = np.arange(len(ids))
    while True:
        new = np.array([group[near[k]].min() for k in range(len(ids))])
        if (new == group).all():
            break
        group = new
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in queries.op6(spark, SF_SMALL).collect()}
    assert got == {(i, f"{prints[i]:016x}", ids[g]) for i, g in zip(ids, group)}
