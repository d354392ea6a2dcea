import datetime as dt
import os
import random
import threading
import zipfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quotemill.operators import exports
from quotemill.operators.rejects import accepted, rejected
from quotemill.operators.snapshots import by_title_date, dated_titles, latest_snapshot, stale_sources
from quotemill.plans.master import stale_master_sources
from quotemill.plans.snapshots import select_snapshots, snapshot_intake
from quotemill.schemas import SNAPSHOT_CATEGORIES
from quotemill.sources.archives import archive_rows
from quotemill.sources.catalog import glob_pattern, in_folder, snapshot_catalog

AS_OF = dt.datetime(2024, 1, 3)
MARKERS = [m for m, _ in SNAPSHOT_CATEGORIES]


def titles(spark, *names):
    return spark.createDataFrame([(n, f"/p/{i}") for i, n in enumerate(names)], "title string, path string")


def test_dated_titles(spark):
    dated = dated_titles(
        titles(
            spark,
            "技術指標_day_240102.zip",
            "技術指標_day_240103.zip",
            "技術指標_week_231229.zip",
            "3大法人_690101.zip",
            "3大法人_680101.zip",
            "融資融卷_249999.zip",
            "融資融卷_2311.zip",
            "技術指標_day_240102 (1).zip",
            "other.zip",
        ),
        MARKERS,
    )
    assert {r.title for r in rejected(dated).collect()} == {
        "融資融卷_249999.zip", "融資融卷_2311.zip", "技術指標_day_240102 (1).zip",
    }
    latest = {r.category: (r.title, r.snap_date) for r in latest_snapshot(accepted(dated)).collect()}
    assert latest == {
        "技術指標_day_": ("技術指標_day_240103.zip", dt.date(2024, 1, 3)),
        "技術指標_week_": ("技術指標_week_231229.zip", dt.date(2023, 12, 29)),
        "3大法人_": ("3大法人_680101.zip", dt.date(2068, 1, 1)),
    }
    assert by_title_date(accepted(dated)).first().title == "3大法人_680101.zip"


def test_selection(spark):
    catalog = titles(
        spark,
        "技術指標_day_240102.zip",
        "技術指標_day_240103.zip",
        "copy of 技術指標_day_240103.zip",
        "全台卷商交易資料_a.zip",
        "全台卷商交易資料_b.zip",
        "全台卷商交易資料_b.zip",
        "other.zip",
    )
    got = sorted(map(tuple, select_snapshots(catalog).collect()))
    assert got == [
        ("Broker", "全台卷商交易資料_a.zip", "/p/3"),
        ("Broker", "全台卷商交易資料_b.zip", "/p/4"),
        ("Tech", "copy of 技術指標_day_240103.zip", "/p/2"),
        ("Tech", "技術指標_day_240103.zip", "/p/1"),
    ]
    assert select_snapshots(catalog.limit(0)).count() == 0


def test_staleness_is_strict(spark):
    as_of = dt.datetime(2024, 1, 3)
    expected = spark.createDataFrame([("fresh",), ("old",), ("none",), ("two",)], "title string")
    catalog = spark.createDataFrame(
        [
            ("fresh", dt.datetime(2024, 1, 2)),
            ("old", dt.datetime(2024, 1, 1, 23, 59, 59)),
            ("two", dt.datetime(2023, 1, 1)),
            ("two", dt.datetime(2024, 1, 2, 1)),
            ("not expected", dt.datetime(2020, 1, 1)),
        ],
        "title string, modificationTime timestamp_ntz",
    )
    as_of = F.lit(as_of).cast("timestamp_ntz")
    stale = {r.title: r.stale for r in stale_sources(expected, catalog, as_of).collect()}
    assert stale == {"fresh": False, "old": True, "none": True, "two": False}
    assert {r.title for r in stale_master_sources(expected, catalog, as_of).collect()} == {"old", "none"}


def archive(path, **members):
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_LZMA) as zf:
        for name, text in members.items():
            zf.writestr(name, text)
    return path


@pytest.fixture
def folder(tmp_path):
    src = tmp_path / "landing"
    src.mkdir()
    archive(src / "a.zip", **{
        "top/": "",
        "top/x.csv": 'h1,h2\r\n1,"two\r\nlines"\r\n',
        "top/sub/y.csv": "only,台\r\n",
        "empty.csv": "",
    })
    whole = archive(src / "b.zip", **{"z.csv": "".join(f"{i},{i * i}\n" for i in range(10_000))})
    (src / "cut.zip").write_bytes(whole.read_bytes()[:500])
    archive(src / "bad.zip", **{"bin.csv": b"\xff\xfe\xff"})
    return src


def test_archive_rows(spark, folder):
    rows = archive_rows(spark, str(folder)).withColumn(
        "archive", F.regexp_extract("archive", "[^/]+$", 0)
    )
    good = accepted(rows)
    a = good.where("archive = 'a.zip'").drop("archive").collect()
    assert sorted(map(tuple, a)) == [
        ("top/sub/y.csv", 0, ["only", "台"]),
        ("top/x.csv", 0, ["h1", "h2"]),
        ("top/x.csv", 1, ["1", "two\r\nlines"]),
    ]
    b = good.where("archive = 'b.zip'")
    assert [(r.row_pos, r.cells) for r in b.orderBy("row_pos").collect()] == [
        (i, [str(i), str(i * i)]) for i in range(10_000)
    ]
    bad = {r.archive: (r.member, r.reject_reason.split(":")[0]) for r in rejected(rows).collect()}
    assert bad == {"cut.zip": (None, "BadZipFile"), "bad.zip": ("bin.csv", "UnicodeDecodeError")}


def test_long_fields_and_other_members_beside_a_bad_one(spark, tmp_path):
    archive(tmp_path / "a.zip", **{
        "1 good.csv": "a," + "x" * 300_000 + "\n",
        "2 bad.csv": "good so far\n".encode() * 5000 + "台".encode("cp950"),
        "3 good.csv": "b,c\n",
    })
    rows = archive_rows(spark, str(tmp_path))
    assert sorted((r.member, len(r.cells[1])) for r in accepted(rows).where("size(cells) = 2").collect()) == [
        ("1 good.csv", 300_000), ("3 good.csv", 1)
    ]
    assert [r.member for r in rejected(rows).collect()] == ["2 bad.csv"]
    assert rejected(archive_rows(spark, str(tmp_path), encoding="cp950")).count() == 0


def test_archives_are_not_loaded_whole(spark, tmp_path):
    """One above the length that file contents may have."""
    archive(tmp_path / "small.zip", **{"x.csv": "1\n"})
    rng = random.Random(1)
    archive(tmp_path / "large.zip", **{"y.csv": "".join(f"{rng.random()}\n" for _ in range(5000))})
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        rows = archive_rows(spark, str(tmp_path))
        assert rows.count() == 5001 and rejected(rows).count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_one_archive_is_read_in_many_tasks(spark, tmp_path):
    archive(tmp_path / "one.zip", **{f"{i:03}.csv": f"{i},{'x' * i}\n" * 3 for i in range(200)})
    (tmp_path / "none.zip").write_bytes(b"PK no archive")
    found = archive_rows(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    good = [r for r in found if r.reject_reason is None]
    assert sorted((r.member, r.row_pos) for r in good) == [(f"{i:03}.csv", n) for i in range(200) for n in range(3)]
    assert all(r.cells == [str(int(r.member[:3])), "x" * int(r.member[:3])] for r in good)
    assert len({r.task for r in good}) == 8
    assert [(r.archive.split("/")[-1], r.member) for r in found if r.reject_reason] == [("none.zip", None)]


def test_a_damaged_member_does_not_hide_those_of_other_archives(spark, tmp_path):
    archive(tmp_path / "good.zip", **{f"{i}.csv": f"{i}\n" for i in range(20)})
    damaged = archive(tmp_path / "damaged.zip", **{f"{i}.csv": f"{i} {'y' * 2000}\n" for i in range(20)})
    content = bytearray(damaged.read_bytes())
    content[60:64] = b"\xff\xff\xff\xff"  # in the first member
    damaged.write_bytes(content)
    rows = archive_rows(spark, str(tmp_path))
    bad = rejected(rows).select("archive", "member").collect()
    assert bad and {(r.archive.split("/")[-1], r.member) for r in bad} == {("damaged.zip", None)}
    assert accepted(rows).where(F.col("archive").endswith("good.zip")).count() == 20


def test_catalog_does_not_read_content(spark, folder):
    os.utime(folder / "a.zip", (1704153600, 1704153600))
    catalog = snapshot_catalog(spark, str(folder), "[ab].zip")
    got = {r.title: (r.length, r.modificationTime) for r in catalog.collect()}
    assert set(got) == {"a.zip", "b.zip"}
    assert got["a.zip"] == ((folder / "a.zip").stat().st_size, dt.datetime(2024, 1, 2))
    assert "content" not in catalog._jdf.queryExecution().executedPlan().toString()
    for same in (f"file:{folder}", f"file://{folder}/", str(folder)):
        assert in_folder(catalog, same).count() == 2
    assert in_folder(catalog, str(folder.parent)).count() == 0
    assert in_folder(catalog, "elsewhere").count() == 0
    assert in_folder(catalog.withColumn("trashed", F.lit(True)), f"file:{folder}").count() == 0


@pytest.mark.parametrize(
    "glob, names, others",
    [
        ("*.zip", [".zip", "a.zip", "a\n.zip"], ["a.zip\n", "a.zip.b", "azip"]),
        ("a?[0-9][^x].{csv,z?p}", ["a_1y.csv", "ab2z.zip"], ["a_1x.csv", "a1y.csv", "a_1y.txt"]),
        (r"\*,{a},[!]^]", ["*,a,b"], ["x,a,b", "*,a,]", "*,a,^"]),
        ("[a", ["[a"], ["a"]),
    ],
)
def test_glob_patterns(spark, glob, names, others):
    df = spark.createDataFrame([(n,) for n in names + others], "name string")
    assert [r.name for r in df.where(F.col("name").rlike(glob_pattern(glob))).collect()] == names


def test_catalog_of_a_tree_is_listed_in_tasks(spark, tmp_path):
    src = tmp_path / "tree é"
    for i in range(300):
        folder = src / f"{i % 3}" / f"f{i}"
        folder.mkdir(parents=True)
        (folder / f"{i}.zip").write_bytes(b"x" * i)
        (folder / "other.txt").touch()
    for name in ("_tmp/a.zip", ".b.zip", "_c.zip", "d.zip._COPYING_"):
        (src / name).parent.mkdir(exist_ok=True)
        (src / name).touch()
    (src / "empty").mkdir()
    (src / "k=_1").mkdir()
    (src / "k=_1" / "300.zip").touch()
    catalog = snapshot_catalog(spark, str(src))
    got = {r.title: r for r in catalog.collect()}
    assert set(got) == {f"{i}.zip" for i in range(301)} and all(got[f"{i}.zip"].length == i for i in range(300))
    assert got["7.zip"].path == f"file:{src}/1/f7/7.zip" and got["7.zip"].parent == f"file:{src}/1/f7"
    by_spark = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True)
    listed = by_spark.load(str(src)).select("path", "modificationTime", "length")
    assert sorted(map(tuple, listed.collect())) == sorted((r.path, r.modificationTime, r.length) for r in got.values() if r.length)  # Spark reads no empty ones
    # what was listed is in staged tables; the files themselves are in no index of the driver
    assert not any(name.endswith(".zip") for name in catalog.inputFiles())


def test_catalog_of_what_a_path_may_be(spark, tmp_path):
    for name in ("2023/a.zip", "2024/b.zip", "2024/c.txt", "other/d.zip"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).touch()
    listed = lambda path: sorted(r.title for r in snapshot_catalog(spark, str(path)).collect())
    assert listed(tmp_path / "202*") == ["a.zip", "b.zip"]
    assert listed(tmp_path / "2024/b.zip") == ["b.zip"] and listed(tmp_path / "2024/c.txt") == []
    with pytest.raises(FileNotFoundError):
        snapshot_catalog(spark, str(tmp_path / "none"))


def test_catalog_of_the_folder_alone(spark, tmp_path):
    src = tmp_path / "a [b] {c}*"
    (src / "below.zip").mkdir(parents=True)
    (src / "sub").mkdir()
    for name in ("1.zip", "2.txt", "sub/3.zip", "below.zip/4.zip"):
        archive(src / name, **{"x.csv": "1\n"})
    catalog = snapshot_catalog(spark, str(src), recursive=False)
    assert {r.title for r in in_folder(catalog, str(src)).collect()} == {"1.zip"}
    assert not any("/sub/" in f for f in catalog.inputFiles())
    assert snapshot_catalog(spark, str(src), "*.lzma", recursive=False).count() == 0


def test_export_does_only_the_missing(spark, tmp_path):
    df = spark.range(1000).select("id", F.format_string("%02d0101", F.col("id") % 7).alias("k"))
    path = str(tmp_path)
    run = lambda part: {r.k: r.n_rows for r in exports.export_missing(part, "k", path, AS_OF).collect()}
    assert set(run(df.where("k < '030000'"))) == {"000101", "010101", "020101"}
    second = run(df)
    assert set(second) == {"030101", "040101", "050101", "060101"}
    assert run(df) == {} and sum(second.values()) == 1000 - 143 * 3
    back = exports.read_export(df, "k", path)
    assert back.schema["k"].dataType.simpleString() == "string"
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_an_interrupted_export_is_repeated(spark, tmp_path):
    df = spark.range(10).select("id", F.lit("k1").alias("k"))
    # rows without a manifest entry, as a run leaves them that was lost half-way
    df.limit(3).write.partitionBy("k").parquet(str(tmp_path / "data" / "run=lost"))
    done = exports.export_missing(df, "k", str(tmp_path), AS_OF).collect()
    assert [(r.k, r.n_rows, r.finished_at) for r in done] == [("k1", 10, AS_OF)]
    assert exports.read_export(df, "k", str(tmp_path)).count() == 10


def both_at_once(*work):
    """Run all of ``work`` in threads, each stopped at the barrier it is given until all have come there."""
    barrier = threading.Barrier(len(work))
    with ThreadPoolExecutor(len(work)) as pool:
        return [f.result() for f in [pool.submit(w, barrier) for w in work]]


def test_of_overlapping_exports_the_first_to_finish_counts(spark, tmp_path, monkeypatch):
    df = spark.range(20).select("id", F.concat(F.lit("k"), F.col("id") % 4).alias("k"))
    export_run = exports._export_run
    barrier = {}

    def after_both_have_looked(*args):
        barrier["at"].wait(60)
        return export_run(*args)

    monkeypatch.setattr(exports, "_export_run", after_both_have_looked)

    def run(rows):
        def work(b):
            barrier["at"] = b
            return exports.export_missing(rows, "k", str(tmp_path), AS_OF).collect()

        return work

    one, two = both_at_once(run(df), run(df.where("k < 'k2'")))
    assert len(list((tmp_path / "data").glob("run=*"))) == 2  # both wrote
    manifest = {r.k: r for r in exports.read_manifest(df, "k", str(tmp_path)).collect()}
    assert {k: r.n_rows for k, r in manifest.items()} == {f"k{i}": 5 for i in range(4)}
    assert sorted(r.id for r in exports.read_export(df, "k", str(tmp_path)).collect()) == list(range(20))
    assert {(r.k, r.run) for r in one} >= {("k2", manifest["k2"].run), ("k3", manifest["k3"].run)}
    assert exports.read_manifest(df, "k", str(tmp_path)).collect() == exports.read_manifest(df, "k", str(tmp_path)).collect()
    monkeypatch.setattr(exports, "_export_run", export_run)
    assert exports.export_missing(df, "k", str(tmp_path), AS_OF).collect() == []


def test_a_later_run_takes_nothing_from_an_earlier_one(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    todo = df.select("k")
    first = exports._export_run(df, todo, "k", str(tmp_path), AS_OF).collect()
    # as_of is what the caller says; the clock decides
    again = exports._export_run(df, todo, "k", str(tmp_path), AS_OF - dt.timedelta(days=9)).collect()
    assert len(first) == 2 and again == []
    assert sorted(map(tuple, exports.read_export(df, "k", str(tmp_path)).collect())) == [(1, "a"), (2, "b")]


def test_of_overlapping_intakes_the_first_to_finish_counts(spark, tmp_path):
    archive(tmp_path / "x.zip", **{"a.csv": "1\n2\n"})
    archive(tmp_path / "y.zip", **{"b.csv": "3\n"})
    (tmp_path / "z.zip").write_bytes(b"PK no archive")
    dst = str(tmp_path / "landed")
    units = lambda *names: spark.createDataFrame([("d", n, f"file:{tmp_path}/{n}") for n in names], "destination string, title string, path string")
    first = exports.land(units("x.zip", "z.zip"), dst, AS_OF).collect()
    second = exports.land(units("x.zip", "y.zip", "z.zip"), dst, AS_OF - dt.timedelta(days=1)).collect()
    assert sorted((r.title, r.n_rows, r.reject_reason is None) for r in first) == [("x.zip", 2, True), ("z.zip", 0, False)]
    assert sorted((r.title, r.n_rows, r.reject_reason is None) for r in second) == [("y.zip", 1, True), ("z.zip", 0, False)]
    rows = exports.landed_rows(spark, dst).collect()
    assert sorted((r.title, r.cells[0]) for r in rows) == [("x.zip", "1"), ("x.zip", "2"), ("y.zip", "3")]
    assert exports.read_landings(spark, dst).count() == 2


def test_counting_reads_the_run_only(spark, tmp_path):
    df = spark.range(20).select("id", F.concat(F.lit("k"), F.col("id") % 4).alias("k"))
    for part in (df.where("k < 'k2'"), df):
        (run,) = {r.run for r in exports.export_missing(part, "k", str(tmp_path), AS_OF).collect()}
    counts = exports.run_counts(df, "k", f"{tmp_path}/data/run={run}")
    files = {f.split("/data/")[1].split("/")[0] for f in counts.inputFiles()}
    assert files == {f"run={run}"} and len(counts.inputFiles()) < len(exports.read_export(df, "k", str(tmp_path)).inputFiles())
    assert {r.k: r.n_rows for r in counts.collect()} == {"k2": 5, "k3": 5}


@pytest.mark.parametrize("key", [None, ""])
def test_rows_without_a_key_are_not_dropped_silently(spark, tmp_path, key):
    df = spark.createDataFrame([(1, "a"), (2, key)], "id int, k string")
    with pytest.raises(Exception, match="no k"):
        exports.export_missing(df, "k", str(tmp_path), AS_OF)


def test_wanted_keys_without_rows_are_done(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    wanted = spark.createDataFrame([("a",), ("z",)], "k string")
    done = exports.export_missing(df, "k", str(tmp_path), AS_OF, wanted)
    assert {r.k: r.n_rows for r in done.collect()} == {"a": 1, "z": 0}
    assert [r.id for r in exports.read_export(df, "k", str(tmp_path)).collect()] == [1]


def test_daily_and_mtime_exports(spark, tmp_path, folder):
    df = spark.range(5)
    path = str(tmp_path / "daily")
    for hour, n in ((1, 1), (9, 0)):
        assert exports.export_daily(df, path, dt.datetime(2002, 1, 1, hour)).count() == n
    assert exports.export_daily(df, path, dt.datetime(2002, 1, 2)).count() == 1
    labels = lambda: sorted(name for run in os.listdir(f"{path}/data") for name in os.listdir(f"{path}/data/{run}") if "snap" in name)
    assert labels() == ["snap=020101", "snap=020102"]
    assert exports.read_export(df.withColumn("snap", F.lit("")), "snap", path).count() == 10

    path = str(tmp_path / "mtime")
    catalog = snapshot_catalog(spark, str(folder), "a.zip")
    for stamp, n in ((1704153600, 1), (1704160000, 0), (1704250000, 1)):
        os.utime(folder / "a.zip", (stamp, stamp))
        assert exports.export_by_mtime(df, snapshot_catalog(spark, str(folder), "a.zip"), path, AS_OF).count() == n
    assert labels() == ["snap=240102", "snap=240103"]
    with pytest.raises(FileNotFoundError):
        exports.export_by_mtime(df, catalog.limit(0), path, AS_OF)


BROKER = "全台卷商交易資料"


def test_intake(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    archive(src / "技術指標_day_240102.zip", **{"old.csv": "old\n"})
    archive(src / "技術指標_day_240103.zip", **{"new.csv": "1\n2\n"})
    archive(src / f"{BROKER}_[1].zip", **{"b.csv": "b1\n"})
    (src / "sub").mkdir()
    archive(src / "sub" / f"{BROKER}_sub.zip", **{"b.csv": "not in the folder itself\n"})
    archive(src / f"{BROKER}_2.zip", **{"empty.csv": ""})
    (src / f"{BROKER}_3.zip").write_bytes(b"PK no archive")
    run = lambda: sorted(
        (r.destination, r.title, r.n_rows, r.reject_reason is None)
        for r in snapshot_intake(spark, str(src), dst, AS_OF).collect()
    )
    assert run() == [
        ("Broker", f"{BROKER}_2.zip", 0, True),
        ("Broker", f"{BROKER}_3.zip", 0, False),
        ("Broker", f"{BROKER}_[1].zip", 1, True),
        ("Tech", "技術指標_day_240103.zip", 2, True),
    ]
    assert run() == [("Broker", f"{BROKER}_3.zip", 0, False)]
    archive(src / f"{BROKER}_3.zip", **{"b.csv": "b3\n"})
    archive(src / "技術指標_day_240104.zip", **{"newer.csv": "3\n"})
    assert run() == [
        ("Broker", f"{BROKER}_3.zip", 1, True),
        ("Tech", "技術指標_day_240104.zip", 1, True),
    ]
    assert run() == []
    landed = exports.landed_rows(spark, dst).orderBy("title", "row_pos").collect()
    assert [(r.destination, r.cells) for r in landed] == [
        ("Broker", ["b3"]), ("Broker", ["b1"]), ("Tech", ["1"]), ("Tech", ["2"]), ("Tech", ["3"]),
    ]


def test_intake_in_small_batches(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    for i in range(7):
        archive(src / f"{BROKER}_{i}.zip", **{"b.csv": f"{i}\n"})
    selected = select_snapshots(snapshot_catalog(spark, str(src)))
    batches = exports.intake(selected, dst, AS_OF, archives_per_batch=3)
    next(batches)  # the run is lost after its first batch
    assert exports.read_landings(spark, dst).count() == 3
    assert [b.count() for b in exports.intake(selected, dst, AS_OF, archives_per_batch=3)] == [3, 1]
    assert sorted(r.cells[0] for r in exports.landed_rows(spark, dst).collect()) == list("0123456")


def test_members_in_another_encoding(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    text = "台;x\r\n" * 3
    archive(src / f"{BROKER}_1.zip", **{"a.csv": text.encode("cp950"), "b.csv": text.encode("cp950") + b"\xff\xff;\r\n"})
    archive(src / f"{BROKER}_2.zip", **{"c.csv": b"2\r\n"})
    (src / f"{BROKER}_3.zip").write_bytes(b"PK no archive")
    outcome = snapshot_intake(spark, str(src), dst, AS_OF, encoding="cp950", delimiter=";").collect()
    assert {r.title[-5]: r.reject_reason is None for r in outcome} == {"1": True, "2": True, "3": False}
    rows = exports.landed_rows(spark, dst).collect()
    assert sorted((r.member, r.cells) for r in rows) == [*[("a.csv", ["台", "x"])] * 3, ("c.csv", ["2"])]
    (bad,) = exports.landed_rejects(spark, dst).collect()
    assert bad.member == "b.csv" and bad.reject_reason.startswith("UnicodeDecodeError")
