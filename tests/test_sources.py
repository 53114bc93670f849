import pytest
from pyspark.sql import functions as F

from dealgauge.session import shared_dir
from dealgauge.sources import files
from dealgauge.fixtures.order_book import mix
from dealgauge.sources.versions import TableSet


def test_csv_folder_reload(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "raw_activities.csv").write_text(
        "activity_id,lead_id,activity_date,activity_type,channel,outcome\n"
        "T2,L1,2020-01-02,call,Phone,Neutral\nT1,,2020-01-03,call,Phone,\n")
    tables = TableSet(spark, str(tmp_path / "out"))
    for _ in range(2):
        outcome = files.load_raw_folder(spark, str(tmp_path / "raw"), tables)
        rows = tables.table("raw_activities").orderBy("ingest_seq").collect()
        assert [(r["activity_id"], r["lead_id"], r["ingest_seq"]) for r in rows] == [("T2", "L1", 0), ("T1", None, 1)]
    assert tables.versions() == [1, 2] and tables.table("raw_leads").count() == 0
    assert outcome == {
        "raw_leads": "skipped", "raw_opportunities": "skipped", "raw_activities": "loaded", "raw_campaign_touches": "skipped"}


def test_summary_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("auc", 0.1 + 0.2, 3, None), ("f1", None, None, True)], "metric string, value double, n long, seen boolean")
    for _ in range(2):
        files.write_summary(rows, str(tmp_path / "s"))
    back = files.read_summary(spark, str(tmp_path / "s"))
    assert back.schema == rows.schema and set(back.collect()) == set(rows.collect())


def test_publish_replaces_in_order(spark, tmp_path):
    first, second = spark.range(3), spark.range(5)
    assert files.publish({"b": first, "a": second}, str(tmp_path)) == ["b", "a"]
    files.publish({"b": second}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 5
    assert len(files.PUBLISHED_TABLES) == 17


def test_stamp(spark):
    row = files.stamp(spark.range(1), model_version="v").first()
    assert row["model_version"] == "v" and row["scored_at"] is not None


def test_mix_is_safe_for_any_key(spark):
    keys = [0, 7, 2**31, 2**40 + 12345, 2**62]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", mix(F.col("k"), 3432918353, 1000).alias("m"))
    for k, m in rows.collect():
        assert m == ((k + 1) * 3432918353 % 2**32) // 65536 % 1000


def test_shared_dir_needs_a_setting_off_local(spark):
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError):
        shared_dir(Cluster)
    assert shared_dir(spark)


def test_csv_columns_by_name_quotes_and_bad_values(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text(
        'lead_id,activity_id,outcome,activity_type,channel,activity_date\n'
        'L1,T1,"say ""hi"", x","a\nb",Phone,2020-01-02\n')
    row = files.read_raw_csv(spark, path, "raw_activities").first()
    assert (row["activity_id"], row["lead_id"], row["outcome"], row["activity_type"]) == ("T1", "L1", 'say "hi", x', "a\nb")
    (tmp_path / "b.csv").write_text("activity_id,lead_id,activity_date,activity_type,channel,outcome\nT1,L1,notadate,a,b,c\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_raw_csv(spark, str(tmp_path / "b.csv"), "raw_activities").collect()


def test_csv_order_over_many_files_and_small_splits(spark, tmp_path):
    path, size = tmp_path / "raw_activities.csv", spark.conf.get("spark.sql.files.maxPartitionBytes")
    path.mkdir()
    expected = []
    for file in ("b.csv", "a.csv", "c.csv"):  # read by name, whatever the order of writing and the sizes
        lines = [f"{file[0]}{i:04d},L{i},2020-01-02,call,Phone,{'x' * (i % 40)}" for i in range(300 if file == "b.csv" else 40)]
        (path / file).write_text("activity_id,lead_id,activity_date,activity_type,channel,outcome\n" + "\n".join(lines) + "\n")
        expected += [line.split(",")[0] for line in lines]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        rows = files.read_raw_csv(spark, str(path), "raw_activities", multi_line=False)
        got = sorted((r["ingest_seq"], r["activity_id"]) for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == list(enumerate(sorted(expected)))
    assert rows.columns == [*spark.createDataFrame([], files.RAW_TABLES["raw_activities"]).columns, "ingest_seq"]


def test_a_failed_reload_leaves_the_old_tables(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    names = ["a", "b", "c", "d"]
    with tables.reload() as batch:
        for n in names:
            batch.write(n, spark.range(3))
    before = tables.table("c")
    with pytest.raises(Exception, match="no such number"):
        with tables.reload() as batch:
            batch.write("a", spark.range(5))
            assert batch.table("a").count() == 5 and tables.table("a").count() == 3  # staged, not yet visible
            batch.write("b", spark.range(5))
            batch.write("c", spark.range(5).select(F.raise_error(F.lit("no such number")).alias("id")))
    assert [tables.table(n).count() for n in names] == [3] * 4 and tables.versions() == [1]
    with tables.reload() as batch:
        for n in names:
            batch.write(n, spark.range(7))
    assert [tables.table(n).count() for n in names] == [7] * 4
    assert before.count() == 3 and tables.table("a", version=1).count() == 3  # a reader of the old version finishes


def test_commits_at_once_and_vacuum(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    tables = TableSet(spark, str(tmp_path))

    def load(i):
        with tables.reload() as batch:
            batch.write(f"t{i}", spark.range(i))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(load, range(8)))
    assert [tables.table(f"t{i}").count() for i in range(8)] == list(range(8)) and tables.versions() == list(range(1, 9))
    load(1)
    gone = tables.vacuum(keep=1)
    assert len(gone) == 1 and tables.versions() == [9] and [tables.table(f"t{i}").count() for i in range(8)] == list(range(8))
    assert tables._add_manifest(9, {}) is False and len(tables.manifest()) == 8
    with pytest.raises(KeyError):
        tables.table("absent")
