import pytest

from hunkmill import queries as core
from tests.compare import database, duck_rows, spark_rows

SF = "/root/testdata/sf0.001"
QUERIES, SQL = core.queries(), core.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return database(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, db, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(db, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 1


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_need_the_llm_subpackage():
    import pathlib

    root = pathlib.Path(core.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "hunkmill.llm" not in path.read_text()
