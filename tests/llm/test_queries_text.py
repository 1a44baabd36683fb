"""The text queries against their SQL, and what they promise for odd rows."""

import pytest

import __spark_entry__ as entry
from oracle import ROOT, compare, connection

ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", ["op1_mixture", "op2_url_filter", "op3_chat_format", "op4_exact_dedup", "op5_line_dedup"])
def test_query(spark, name):
    folder = f"{ROOT}/sf0.01"
    rows, extra, missing = compare(spark, connection(folder), entry.queries()[name], ORACLE[name], folder)
    assert rows and not extra and not missing, (list(extra.items())[:3], list(missing.items())[:3])


def test_all_ten_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
