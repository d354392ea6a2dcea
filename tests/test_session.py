import datetime as dt
import os

import pytest

from quotemill import session
from quotemill.operators.exports import export_missing
from quotemill.operators.keys import matching
from quotemill.operators.tables import write_master
from quotemill.plans.capital import capital_ranking
from quotemill.plans.facts import load_tdcc, reset_fact_tables
from quotemill.plans.master import build_master
from quotemill.schemas import CAPITAL_CODE, CAPITAL_NAME, CAPITAL_VALUE


class Session:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_configured_folder_is_used():
    spark = Session(spark_checkpoint_dir="hdfs://x/shared/", spark_master="yarn")
    assert session.shared_dir(spark) == "hdfs://x/shared"
    assert session.stage_path(spark, "n").startswith("hdfs://x/shared/quotemill/session/n-")
    assert session.stage_path(spark, "n") != session.stage_path(spark, "n")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://h:7077"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(spark_master=master))


def test_a_local_session_gets_its_own_once():
    spark = Session(spark_master="local[2]")
    own = session.shared_dir(spark)
    assert os.path.isdir(own) and session.shared_dir(spark) == own


def test_staged_in_a_real_session(spark):
    folder = os.path.join(session.shared_dir(spark), "quotemill", spark.conf.get("spark.app.id"))
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert session.staged(spark.range(3), "x").count() == 3
    (new,) = set(os.listdir(folder)) - before
    assert new.startswith("x-")


def test_staged_tables_are_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    session.staged(spark.range(3), "x")
    (tmp_path / "quotemill" / "of another application").mkdir()
    session.remove_staged(spark)
    session.remove_staged(spark)
    assert os.listdir(tmp_path / "quotemill") == ["of another application"]


def _files(folder):
    return sorted(os.path.join(at, f) for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_a_scope_takes_what_was_staged_in_it(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    outside = session.staged(spark.range(1), "outside")
    before = _files(tmp_path)
    with session.staging(spark):
        session.staged(spark.range(3), "x")
        with session.staging(spark) as inner:
            rows = session.staged(spark.range(5), "y")
            kept = inner.keep(rows.where("id > 1"), "kept")
            mine = len(_files(tmp_path))
        assert 0 < len(_files(tmp_path)) - len(before) < mine - len(before)
        assert kept.count() == 3
    assert _files(tmp_path) == before and outside.count() == 1


def test_a_failing_scope_leaves_nothing(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    with pytest.raises(KeyError):
        with session.staging(spark):
            session.staged(spark.range(3), "x")
            raise KeyError("x")
    assert _files(tmp_path) == []
    assert session.staged(spark.range(3), "x").count() == 3  # no scope is open any more


@pytest.fixture
def staging_folder(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    return tmp_path / "shared"


def test_jobs_leave_nothing_staged(spark, staging_folder, database, tmp_path):
    """Every job, called and its result written in a scope."""
    as_of = dt.datetime(2024, 5, 6)
    page = "<tr>h</tr><tr><td><b>股票<b></tr><tr><td>1　a<td>i<td>s<td>m<td>g<td>c<td></tr>"
    pages = spark.createDataFrame([("twse", "u", as_of, page)], "source string, url string, captured timestamp, html string")
    prices = spark.createDataFrame([("1", "2024-05-06")], "stock string, date string")
    capital = tmp_path / "capital.csv"
    capital.write_text(f"{CAPITAL_CODE},{CAPITAL_NAME},{CAPITAL_VALUE}\n" + '="1",a,"2,000"\n', "utf-8")

    with session.staging(spark):
        sets, rejects = build_master(pages)
        write_master(sets["codes"], str(tmp_path / "codes"))
        assert rejects.count() == 0 and _files(staging_folder)
    assert spark.read.option("header", True).csv(str(tmp_path / "codes")).count() == 1
    with session.staging(spark):
        table, _ = capital_ranking(spark, str(capital))
        assert [r.row_index for r in table.collect()] == [0]
    reset_fact_tables(spark, f"{database}.b", f"{database}.t")
    with session.staging(spark):
        names = spark.table(f"{database}.t").columns
        rows = spark.createDataFrame([tuple("1" if n == "stock" else "20240506" if n == "date" else "1" for n in names)], names)
        load_tdcc(rows, f"{database}.t").write.parquet(str(tmp_path / "rejects"))
    titles = spark.createDataFrame([("x_12345678901.zip",), ("y",)], "title string")
    needles = spark.createDataFrame([("12345678901",)], "needle string")
    with session.staging(spark):
        assert matching(titles, needles).count() == 1
    # this one needs no scope of the caller's
    assert export_missing(prices, "date", str(tmp_path / "out"), as_of).count() == 1
    assert _files(staging_folder) == []
