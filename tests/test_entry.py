"""Driver contract: entry smoke check, one oracle per query, and every
query checked against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_sql import oracle_queries
from conftest import SF0001
from usagelens.schemas import ACTIVITY_SNAPSHOT

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert [(f.name, f.dataType) for f in df.schema.fields] == \
        [(f.name, f.dataType) for f in ACTIVITY_SNAPSHOT.fields]
    assert df.count() > 0


OWN = sorted(oracle_queries())  # the queries of the library itself; others test their own


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.queries()) and set(OWN) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_optional_subpackage_may_be_absent(tmp_path):
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "usagelens"), tmp_path / "usagelens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "oracle_sql.py"):
        shutil.copy(os.path.join(root, name), tmp_path / name)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries()), *sorted(e.oracle_sql()))"],
                          cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.stdout.split() == OWN + OWN, said.stderr


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF0001}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("NULL" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF0001)
    cur = duck.execute(entry.oracle_sql()[name])
    if name.endswith(("_rejects", "_fallback", "_lenient")):
        assert not df.isEmpty()  # the dirty inputs have something to reject
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, df.collect()) == _canon(ocols, cur.fetchall())


_CAP_NODES = ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject", "Sample")


def _is_top_k_report(name):
    return name == "limited_scan" or name.startswith(("top5_", "least5_"))


@pytest.mark.parametrize("name", [n for n in OWN if not _is_top_k_report(n)])
def test_no_row_caps_outside_top_k_reports(spark, name):
    """Whole tables: only the scan-limit feature and the top/least-k reports
    may contain a limit; the products rank with WindowGroupLimit (k per series)."""
    import contextlib
    import io
    df = entry.queries()[name](spark, SF0001)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    assert not [node for node in _CAP_NODES if node in plan], plan
