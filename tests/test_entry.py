import importlib.util
import os
import re

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data here")


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_the_text_package():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(root, "cauldra")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    text = open(os.path.join(folder, f), encoding="utf-8").read()
                    assert not re.search(r"(?:from|import)\s+[\w.]*\bllm\b", text), f


@needs_data
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", ["p2_found", "p5_found", "bronze_first_wins", "latest_snapshot", "variant_fanout", "tag_parse", "weight_parse"])
def test_queries_equal_their_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from collections import Counter
    from pathlib import Path

    from run_checks import plain

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    df = entry.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    cur = con.execute(entry.oracle_sql()[name])
    at = [x[0] for x in cur.description]
    assert sorted(at) == cols
    assert Counter(tuple(plain(r[c]) for c in cols) for r in df.collect()) == Counter(tuple(plain(r[at.index(c)]) for c in cols) for r in cur.fetchall())
