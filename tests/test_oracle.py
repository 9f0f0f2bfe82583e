"""Every registered query equals its DuckDB SQL on the sf0.001 tables."""

import pytest

from oracle_compare import TABLES, compare

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["window_end", "province", "n"]
    assert df.limit(5).count() > 0


def _names():
    """The reference's operators; the training-data queries have tests of their own."""
    import __spark_entry__ as entry
    return sorted(entry.CORE_QUERIES)


def test_every_query_has_sql():
    import __spark_entry__ as entry
    assert set(_names()) <= set(entry.oracle_sql()) <= set(entry.queries())


# stream queries: on folder tables below (the file layout is checked at every round's gate)
@pytest.mark.parametrize("name", [n for n in _names() if not n.startswith("stream_")])
def test_query_matches_sql(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res["status"] == "ok", res


@pytest.fixture(scope="module")
def folder_tables(spark, tmp_path_factory):
    """The same tables as folders of three part files, the layout of any large table."""
    root = tmp_path_factory.mktemp("folders")
    for name in TABLES:
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(3).write.parquet(
            str(root / f"{name}.parquet"))
    return str(root)


@pytest.mark.parametrize("name", _names())
def test_query_matches_sql_on_folder_tables(spark, folder_tables, name):
    res = compare(spark, folder_tables, [name], verbose=False)[name]
    assert res["status"] == "ok" and res["spark_rows"] > 0, res
