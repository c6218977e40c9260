import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_works_without_the_subpackage():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith("skylattice.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
assert len(e.queries()) > 50 and not [n for n in e.queries() if n.startswith("op") or n == "pipeline"]
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def names():
    sys.path.insert(0, str(ROOT))
    from skylattice.plans import registry

    return registry.QUERIES


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not Path(DATA).exists(), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(names()))
def test_query_has_the_rows_of_its_sql(spark, duck, name):
    from skylattice.plans import registry

    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    plain = lambda v: round(v, 5) + 0.0 if isinstance(v, float) else v
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name not in registry.SQL:
        assert got
        return
    r = duck.execute(registry.SQL[name])
    at = [[d[0] for d in r.description].index(c) for c in columns]
    assert [len(x) for x in got] and len(got) == len(rows := sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=str))
    off = [(a, b) for a, b in zip(got, rows, strict=True) if str(a) != str(b)]
    assert not off, off[:3]
