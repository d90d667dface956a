"""Readers and the feature writer."""

from __future__ import annotations

import datetime
import os

import pytest
from frames import rows

from tallyloom.session import scratch_path, stored
from tallyloom.sources import readers

CUSTOMERS = '''customer_id,FN,Active,club_member_status,fashion_news_frequency,age,postal_code
a,1.0,,ACTIVE,NONE,25,00123
b,NaN,1,NA,None,,x
c,,,"LEFT, CLUB","say ""hi""",31.5,9
'''
TRANSACTIONS = """t_dat,customer_id,article_id,price,sales_channel_id
2020-01-01,a,108775015,0.05,2
2020-01-05,a,7,0.1,1
2020-01-03,b,7,0.2,1
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv")
    (path / "customers.csv").write_text(CUSTOMERS)
    (path / "transactions.csv").write_text(TRANSACTIONS)
    (path / "articles.csv").write_text("article_id,prod_name,index_group_no\n7,Top,3\n8,,\n")
    return path


def test_customers(spark, folder):
    df = readers.load_customers(spark, str(folder / "customers.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["string", "double", "double", "string", "string", "double", "string"]
    assert rows(df, "customer_id") == [
        ("a", 1.0, None, "ACTIVE", "NONE", 25.0, "00123"), ("b", None, 1.0, None, None, None, "x"),
        ("c", None, None, "LEFT, CLUB", 'say "hi"', 31.5, "9")]


def test_transactions(spark, folder):
    path = str(folder / "transactions.csv")
    df = readers.load_transactions(spark, path)
    assert dict(df.dtypes)["t_dat"] == "date" and dict(df.dtypes)["article_id"] == "int"
    assert dict(df.dtypes)["sales_channel_id"] == "tinyint"
    assert df.first()["t_dat"] == datetime.date(2020, 1, 1)
    both = readers.load_transactions(spark, path, date_range=("2020-01-01", "2020-01-03"))
    assert both.count() == 2  # both ends count
    limited = readers.load_transactions(spark, path, sample_size=2, date_range=("2020-01-02", "2020-01-05"))
    assert rows(limited.select("article_id")) == [(7,)]  # the row limit comes first


def test_load_all(spark, folder):
    paths = [str(folder / f"{name}.csv") for name in ("customers", "articles", "transactions")]
    customers, articles, transactions = readers.load_all(spark, *paths, sample_sizes={"customers": 1})
    assert (customers.count(), articles.count(), transactions.count()) == (1, 2, 3)
    assert dict(articles.dtypes)["index_group_no"] == "tinyint"
    with pytest.raises(ValueError, match="unknown tables"):
        readers.load_all(spark, *paths, sample_sizes={"sample_customers": 1})


def test_bad_number_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text("t_dat,customer_id,article_id,price,sales_channel_id\n2020-01-01,a,x7,0.1,1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.load_transactions(spark, str(tmp_path / "t.csv")).collect()


def test_unknown_format(spark, folder):
    with pytest.raises(ValueError, match="unsupported format"):
        readers.load_customers(spark, str(folder / "customers.csv"), fmt="xml")


def test_write_features_by_month(spark, folder, tmp_path):
    df = readers.load_transactions(spark, str(folder / "transactions.csv"))
    path = str(tmp_path / "out")
    readers.write_features(df, path, month_of="t_dat")
    assert [d for d in os.listdir(path) if d.startswith("year_month")] == ["year_month=2020-01"]
    assert spark.read.parquet(path).count() == 3
    readers.write_features(df, path)  # overwrites
    assert set(spark.read.parquet(path).columns) == set(df.columns)


def test_stored_tables_go_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and (root is None or first.startswith(root))
    assert rows(stored(spark.range(3), "ids"), "id") == [(0,), (1,), (2,)]


def _parts(folder, *texts):
    folder.mkdir()
    for i, text in enumerate(texts):
        (folder / f"part-{i}.csv").write_text(text)
    return str(folder)


def test_sample_is_the_head_of_the_first_files(spark, tmp_path):
    rows = "".join(f"{i},2\n" for i in range(10, 2000))
    path = _parts(tmp_path / "parts", "article_id,product_code\n9,1\n", "article_id,product_code\n" + rows)
    ids = lambda n: [r.article_id for r in readers.load_articles(spark, path, sample_size=n).collect()]
    assert ids(1) == [9]
    assert ids(3) == [9, 10, 11]
    stored = str(tmp_path / "stored.parquet")
    spark.range(100).repartition(3).sortWithinPartitions("id").write.parquet(stored)
    first = sorted(f for f in os.listdir(stored) if f.startswith("part-"))[0]
    want = [r.id for r in spark.read.parquet(f"{stored}/{first}").limit(4).collect()]
    assert [r.id for r in readers.load_articles(spark, stored, fmt="parquet", sample_size=4).collect()] == want


def test_files_with_another_column_order_are_rejected(spark, tmp_path):
    path = _parts(tmp_path / "parts", "article_id,product_code\n9,1\n", "product_code,article_id\n1,8\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.load_articles(spark, path).collect()


def test_scratch_is_cleared(spark, monkeypatch):
    import os

    from tallyloom import session

    monkeypatch.setattr(session, "_SCRATCH", [])  # other tests still read theirs
    table = session.stored(spark.range(5), "cleared")
    path = session._SCRATCH[0].removeprefix("file:")
    assert table.count() == 5 and os.path.isdir(path)
    assert session.clear_scratch(spark) == 1 and not os.path.exists(path) and session.clear_scratch(spark) == 0
