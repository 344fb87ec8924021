from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline import session
from ledgerline.plans import ingest_log, jobs, rules
from ledgerline.schemas import CHURN, RULE_LISTS, RULES
from ledgerline.sources import checked, commits, files, jdbc, sinks
from ledgerline.streaming import rule_pipeline
from ledgerline.streaming.incremental import load_new_batches, load_new_rows

LOG = "file_upld_log_id long, file_src_cd string, file_upld_type string, upld_ts timestamp, published_file_path string, published_file_name string, model string"


def log_frame(spark):
    at = dt.datetime
    return spark.createDataFrame(
        [(1, "DS1", "training", at(2020, 1, 2), None, None, "lr"), (3, "DS2", "testing", at(2020, 1, 3), None, None, "Churn"),
         (2, "DS1", "training", at(2020, 1, 3), "old", "old", "Arema")],
        LOG,
    )


def resolve(spark, text, stage=rules.RAW_TO_TRANSFORMED):
    lists = spark.createDataFrame([("DS2", "testing", text, ""), ("DS1", "training", "9", "9")], RULE_LISTS)
    known = spark.createDataFrame([(i, f"r{i}") for i in range(1, 10)], RULES)
    return rules.rule_names(rules.resolve_rules(log_frame(spark), lists, known, stage))


def test_rules_come_in_list_order(spark):
    assert resolve(spark, "3, 1,2") == ["r3", "r1", "r2"]
    assert resolve(spark, "2,77,2 ,x,1") == ["r2", "r1"]
    assert resolve(spark, "") == [] and resolve(spark, "1", rules.TRANSFORMED_TO_PUBLISHED) == []


def test_rules_of_all_stages_ask_the_log_once(spark):
    """The same names as stage by stage; a log without rows or with an upload that no list has gives none."""
    stages = (rules.RAW_TO_TRANSFORMED, rules.TRANSFORMED_TO_PUBLISHED)
    lists = spark.createDataFrame([("DS2", "testing", "3, 1,3", "2"), ("DS1", "training", "9", "9"), (None, "testing", "4", "4")], RULE_LISTS)
    known = spark.createDataFrame([(i, f"r{i}") for i in range(1, 10)], RULES)
    asked = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    log = log_frame(spark).coalesce(1).mapInArrow(seen, LOG)
    assert rules.names_by_stage(log, lists, known, stages) == {stages[0]: ["r3", "r1"], stages[1]: ["r2"]}
    assert asked.value == 3
    newer = log_frame(spark).withColumn("file_src_cd", F.when(F.col("file_src_cd") == "DS1", "DS1"))
    for frame in (log_frame(spark), log_frame(spark).limit(0), newer):
        apart = {s: rules.rule_names(rules.resolve_rules(frame, lists, known, s)) for s in stages}
        assert rules.names_by_stage(frame, lists, known, stages) == apart


def test_deliveries_read_their_own_rows(spark):
    from ledgerline.plans.catalog import loading

    book = loading._three_deliveries(spark, "/root/testdata/sf0.001")
    part = book.where(F.col("delivery") == 1)
    assert 0 < len({r[0] for r in part.select(F.input_file_name()).distinct().collect()}) < len(book.inputFiles())
    assert "PartitionFilters: [isnotnull(delivery" in part._jdf.queryExecution().executedPlan().toString()
    assert part.where("ordernumber % 3 <> 1").isEmpty()


def test_wide_writes_set_back_the_session(spark, tmp_path):
    names = ("spark.sql.codegen.hugeMethodLimit", "spark.sql.maxConcurrentOutputFileWriters")
    before = [spark.conf.get(n) for n in names]
    with pytest.raises(ZeroDivisionError), session.wide_writes(spark):
        assert [spark.conf.get(n) for n in names] == ["4000", "8"]
        1 / 0
    assert [spark.conf.get(n) for n in names] == before
    many = spark.range(60).select("id", (F.col("id") % 20).cast("string").alias("file_type"))  # more folders than open files
    sinks.write_zone(many, str(tmp_path), "DS1", "parquet")
    assert spark.read.parquet(f"{tmp_path}/DS1").distinct().count() == 60


def test_unknown_rules_are_an_error(spark):
    rows = spark.range(1)
    for name in ("__class__", "wri", "writeNowhere", "toString"):
        with pytest.raises(ValueError):
            rules.apply_rules(rows, [name])
    with pytest.raises(ValueError):
        rules.run_stage(rows, rules.RAW_TO_TRANSFORMED, "DS3", rules.Target("x"))


@pytest.fixture
def extra_rules():
    rules.rule("addOne")(lambda df: df.withColumn("n", F.col("n") + 1))
    rules.rule("timesTen")(lambda df: df.withColumn("n", F.col("n") * 10))
    yield
    del rules.TRANSFORMS["addOne"], rules.TRANSFORMS["timesTen"]


def test_writers_run_after_all_transformations(spark, extra_rules, tmp_path):
    rows = spark.createDataFrame([(" a ", 1, "training"), ("b", 2, "testing")], "t string, n int, file_type string")
    names = ["addOne", "writeDataIntoPublishedS3ZoneInParquet", "timesTen", "writeTwice"]
    zone, second = str(tmp_path / "zone"), str(tmp_path / "second")
    rules.writer("writeTwice")(lambda df, target, source: sinks.write_zone(df, second, source, "csv"))
    rules.run_stage(rows, rules.TRANSFORMED_TO_PUBLISHED, "DS1", rules.Target(zone), names)
    del rules.WRITERS["writeTwice"]
    assert files.read_zone(spark, second, "DS1", "csv").agg(F.sum("n")).first()[0] == 50
    got = files.read_zone(spark, zone, "DS1", "parquet").orderBy("n").collect()
    assert [(r.t, r.n, r.file_type) for r in got] == [("a", 20, "training"), ("b", 30, "testing")]


def test_default_writers(spark, tmp_path):
    rows = spark.createDataFrame([("a", "training")], "t string, file_type string")
    for stage, source, fmt in (
        (rules.RAW_TO_TRANSFORMED, "DS1", "csv"), (rules.RAW_TO_TRANSFORMED, "DS2", "parquet"),
        (rules.TRANSFORMED_TO_PUBLISHED, "DS1", "csv"), (rules.TRANSFORMED_TO_PUBLISHED, "DS2", "csv"),
    ):
        zone = str(tmp_path / (stage + source))
        rules.run_stage(rows, stage, source, rules.Target(zone))
        rules.run_stage(rows, stage, source, rules.Target(zone))
        assert files.read_zone(spark, zone, source, fmt).count() == 2  # zones are appended to
    with pytest.raises(ValueError):
        files.read_zone(spark, zone, source, "xml")


def test_single_file(spark, tmp_path):
    rows = spark.range(20).withColumn("file_type", F.lit("training"))
    sinks.write_zone(rows.repartition(4), str(tmp_path / "one"), "DS1", "csv", single_file=True, max_rows_per_file=5)
    assert files.list_files(spark, str(tmp_path / "one")).count() == 1


def test_csv_zone_keeps_texts(spark, tmp_path):
    texts = ["plain", "", None, " padded ", 'a "quoted" word', "two\nlines", 'mixed, "x"\r\n\\end\\', "\\", '"', "é,ü"]
    rows = spark.createDataFrame([(i, t, t, "training") for i, t in enumerate(texts)], "n int, t string, u string, file_type string")
    sinks.write_zone(rows.repartition(3), str(tmp_path), "DS1", "csv")
    back = files.read_zone(spark, str(tmp_path), "DS1", "csv", rows.schema)
    assert sorted((r.n, r.t, r.u) for r in back.collect()) == [(i, t or None, t or None) for i, t in enumerate(texts)]


def test_database_writer_needs_a_database(spark):
    rows = spark.createDataFrame([("a", "training")], "t string, file_type string")
    with pytest.raises(ValueError):
        rules.run_stage(rows, rules.RAW_TO_TRANSFORMED, "DS1", rules.Target("x"), ["writeTransformedDataIntoRDS"])


def test_database_settings():
    with pytest.raises(ValueError):
        jdbc.Database("", "d")
    database = jdbc.Database("jdbc:x:y", "drv", {"user": "u"})
    assert database.options() == {"url": "jdbc:x:y", "driver": "drv", "user": "u"}
    with pytest.raises(ValueError):
        jdbc.read_table(None, database, "t", split_column="id")


def test_newest_file_and_log_stamp(spark, tmp_path):
    zone = str(tmp_path / "zone")
    for kind in ("training", "testing"):
        sinks.write_zone(spark.createDataFrame([(1, kind)], "n int, file_type string"), zone, "DS1", "csv")
    newest = files.latest_file(files.list_files(spark, zone))
    assert newest.first().upload_type == "Testing"
    folder, log = str(tmp_path / "log"), log_frame(spark)
    assert ingest_log.read_log(spark, folder, schema=log.schema).count() == 0
    assert ingest_log.append_log(spark, folder, log, log.schema) == 1
    assert ingest_log.stamp_newest(spark, folder, newest, log.schema) == 2
    now = ingest_log.read_log(spark, folder, schema=log.schema)
    names = {r.file_upld_log_id: r.published_file_name for r in now.collect()}
    assert names[3] == newest.first().file_name and names[1] is None and names[2] == "old"
    assert ingest_log.log_history(spark, folder, schema=log.schema).count() == log.count() + 1  # one row was written
    earlier = ingest_log.read_log(spark, folder, 1, log.schema)
    assert {r.file_upld_log_id: r.published_file_name for r in earlier.collect()}[3] is None
    assert files.latest_file(files.list_files(spark, zone, "nothing-*")).collect() == []


def test_metric_files_and_csv_inference(spark, tmp_path):
    folder = str(tmp_path / "metrics")
    for job, value in (("a", 1.5), ("b", 2.5)):
        sinks.write_result(spark.createDataFrame([(job, value)], "Jobname string, MAPE double"), folder + job, "m", "csv")
    both = files.read_metric_files(spark, [f"{folder}a/m", f"{folder}b/m"])
    assert sorted(tuple(r) for r in both.collect()) == [("a", 1.5), ("b", 2.5)]
    assert dict(files.read_csv(spark, f"{folder}a/m").dtypes)["MAPE"] == "double"
    parquet = sinks.write_result(both, str(tmp_path), "out")
    assert files.read_parquet_zone(spark, parquet).count() == 2


def test_catalog_table_and_guard(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spark.sql(f"CREATE TABLE default.zone_rows (id bigint) USING parquet LOCATION '{tmp_path / 't'}'")
    try:
        rows = files.read_catalog_table(spark, "default", "zone_rows")
        assert files.has_rows(rows) and not files.has_rows(rows.where("id > 5"))
    finally:
        spark.sql("DROP TABLE default.zone_rows")


def test_job_of_newest_upload(spark):
    assert jobs.model_of_newest_upload(log_frame(spark)) == "Churn"
    with pytest.raises(ValueError):
        jobs.model_of_newest_upload(log_frame(spark).withColumn("model", F.lit("Unknown")))
    with pytest.raises(ValueError):
        jobs.model_of_newest_upload(log_frame(spark).limit(0))
    assert set(jobs.JOBS) == {"Arema", "AremaRetrain", "lr", "LinearRetrain", "Customer_Segmentation", "Churn", "ChurnRetrain"}


def test_each_file_is_loaded_once(spark, tmp_path):
    folder, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    rows = spark.createDataFrame([(i, f" {i} ") for i in range(10)], "n int, t string")
    for part in (0, 1):
        rows.where(F.col("n") % 2 == part).write.mode("append").option("header", True).csv(folder)
        load_new_rows(spark, folder, rows.schema, target, progress, lambda d: d.withColumn("t", F.trim("t")))
    load_new_rows(spark, folder, rows.schema, target, progress, lambda d: d)
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(i, str(i)) for i in range(10)]


def test_batches_are_never_lost(spark, tmp_path):
    """A repeated batch replaces itself; batches of another progress folder are added."""
    from pathlib import Path

    folder, target, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    rows = spark.createDataFrame([(i,) for i in range(10)], "n int")
    rows.write.parquet(folder)

    def load(where):
        load_new_batches(spark, folder, rows.schema, target, where, lambda d: d, fmt="parquet")

    load(progress)
    for commit in Path(progress, "commits").glob("[.0-9]*"):
        commit.unlink()  # as if the run had ended before the batch was confirmed
    load(progress)
    assert spark.read.parquet(target).count() == 10
    spark.createDataFrame([(i,) for i in range(5)], "n int").write.mode("append").parquet(folder)
    load(progress)
    assert spark.read.parquet(target).count() == 15
    load(str(tmp_path / "another"))
    assert spark.read.parquet(target).count() == 30


def test_late_files_are_loaded(spark, tmp_path):
    import os
    import time

    folder, target, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    for name, days in (("new", 0), ("late", 30)):
        spark.createDataFrame([(days,)], "n int").coalesce(1).write.mode("append").parquet(str(folder))
        if days:
            newest = max(folder.glob("part-*"), key=os.path.getmtime)
            os.utime(newest, (time.time() - days * 86400,) * 2)
        load_new_rows(spark, str(folder), spark.createDataFrame([], "n int").schema, target, progress, lambda d: d, fmt="parquet")
    assert sorted(r.n for r in spark.read.parquet(target).collect()) == [0, 30]


def test_newest_file_has_any_name(spark, tmp_path):
    import os
    import time

    for name, age in (("part-0.csv", 100), ("upload_2024.csv", 0), ("_hidden", -50)):
        (tmp_path / name).write_text("a\n1\n")
        os.utime(tmp_path / name, (time.time() - age,) * 2)
    assert files.latest_file(files.list_files(spark, str(tmp_path))).first().file_name == "upload_2024.csv"


def test_shared_folder_is_read_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named
    assert session.scratch_path(spark, "x").startswith(named)


class FakeSession:
    """A session of a cluster, or of one machine, without a shared folder."""

    def __init__(self, master, folder=None):
        self.settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.current = None

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, folder):
        self.current = folder


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("yarn"))
    named = FakeSession("yarn", "s3a://bucket/shared")
    assert session.shared_dir(named) == "s3a://bucket/shared" == named.current
    alone = FakeSession("local[2]")
    assert session.shared_dir(alone) == alone.current


def test_churn_layout():
    assert len(CHURN) == 15


# ---------------------------------------------------------------- version files, the log, checked readers, the pipeline


def test_a_version_is_created_once(spark, tmp_path):
    from multiprocessing.pool import ThreadPool

    folder = str(tmp_path / "versions")
    assert commits.versions(spark, folder) == []
    path = commits.version_file(folder, 1)
    with ThreadPool(8) as pool:
        made = pool.map(lambda k: commits.create_once(spark, path, f'{{"k": {k}}}'), range(24))
    assert sum(made) == 1 and commits.read_version(spark, folder, 1)["k"] == made.index(True)
    with ThreadPool(8) as pool:
        numbers = pool.map(lambda k: commits.commit(spark, folder, lambda version: {"k": k, "v": version}), range(20))
    assert sorted(numbers) == list(range(2, 22)) == commits.versions(spark, folder)[1:]
    assert {commits.read_version(spark, folder, v)["k"] for v in numbers} == set(range(20))


def test_two_log_writers_lose_nothing(spark, tmp_path):
    from multiprocessing.pool import ThreadPool

    folder, log = str(tmp_path / "log"), log_frame(spark)
    ingest_log.append_log(spark, folder, log, log.schema)

    def add(number):
        """Each writer adds an upload whose id follows the largest one that it sees."""

        def following(seen):
            last = seen.agg(F.max("file_upld_log_id")).first()[0]
            return log.limit(1).withColumns({"file_upld_log_id": F.lit(last + 1), "model": F.lit(f"writer {number}")})

        return ingest_log.append_log(spark, folder, following, log.schema)

    with ThreadPool(4) as pool:
        versions = pool.map(add, range(6))
    assert sorted(versions) == list(range(2, 8))
    now = {r.file_upld_log_id: r.model for r in ingest_log.read_log(spark, folder, schema=log.schema).collect()}
    assert set(now) == set(range(1, 10)) and {now[k] for k in range(4, 10)} == {f"writer {k}" for k in range(6)}
    parts = [p for p in (tmp_path / "log" / "rows").iterdir() if p.name.startswith("part=")]
    assert len(parts) == 7  # what lost attempts wrote is gone


def test_checked_files(spark, tmp_path):
    good = "currency,rate_date,usd_rate\n"
    (tmp_path / "a.csv").write_text(good + "EUR,2020-01-31,1.1\nCAD,2020-01-31,n/a\nCAD,31.01.2020,0.7\n")
    (tmp_path / "b.csv").write_text(good + "EUR,2020-02-29\nEUR,2020-02-29,1.2,9\nEUR,,1\nEUR,2020-03-31,-1\n,2020-03-31,1\n")
    (tmp_path / "c.csv").write_text(good)
    read = checked.read_rates(spark, str(tmp_path))
    assert [(r.currency, str(r.rate_date), r.usd_rate) for r in read.good.collect()] == [("EUR", "2020-01-31", 1.1)]
    assert read.good.select("currency").count() == 1  # the same rows are good whatever is selected
    reasons = sorted((r.source_file[-5:], r.reason) for r in read.bad.collect())
    assert reasons == sorted(
        [("a.csv", "unreadable")] * 2 + [("b.csv", "unreadable")] * 2
        + [("b.csv", "missing rate_date"), ("b.csv", "usd_rate not above zero"), ("b.csv", "missing currency")]
    )
    folder = str(tmp_path / "aside" / "rows")
    assert read.quarantine(folder) == 7 and read.quarantine(folder) == 7 and spark.read.parquet(folder).count() == 14
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "d.csv").write_text("rate_date,currency,usd_rate\n2020-01-31,EUR,1.1\n")
    with pytest.raises(Exception, match="(?i)header"):
        checked.read_rates(spark, str(tmp_path / "other")).good.collect()
    (tmp_path / "macro.txt").write_text("series,date,value\ncpi,2020-01-01,\n,2020-01-01,2\n")
    macro = checked.read_macro(spark, str(tmp_path / "macro.txt"))
    assert macro.good.count() == 1 and macro.bad.first().reason == "missing series"


def test_registered_zone_reads_only_its_partition(spark, tmp_path):
    rows = spark.createDataFrame([(i, "training" if i % 3 else "testing") for i in range(30)], "n int, file_type string")
    sinks.write_zone(rows, str(tmp_path), "DS1", "parquet")
    try:
        for expected in (30, 33):
            files.register_zone(spark, "zone_db", "ds1", str(tmp_path / "DS1"), rows.schema, ["file_type"])
            assert files.read_catalog_table(spark, "zone_db", "ds1").count() == expected
            new = spark.createDataFrame([(i, "retraining") for i in range(3)], rows.schema)
            sinks.write_zone(new, str(tmp_path), "DS1", "parquet")  # a partition that was not there
        one = files.read_catalog_table(spark, "zone_db", "ds1").where("file_type = 'testing'")
        assert one.count() == 10
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(file_type" in plan
        statistics = spark.sql("DESCRIBE EXTENDED zone_db.ds1").where("col_name = 'Statistics'").first()
        assert "rows" in statistics.data_type
    finally:
        spark.sql("DROP DATABASE IF EXISTS zone_db CASCADE")


def order_rows(spark, first, n):
    from ledgerline.schemas import ORDER_BOOK_RAW

    values = {
        "marketinggroup": F.lit(7), "billtocode": F.lit(1), "ordernumber": F.col("id") + first,
        "orderreceiveddate": F.lit("05/03/2020"), "custacknwldgmntdate": F.lit("07/03/2020"), "ordergrossvalue": F.lit(10.0),
        "ordernetvalue": F.lit(8.0), "billtocountryname": F.lit("U.S.A."), "billtoname": F.lit(' a "b",\n c '),
        "file_type": F.lit("training"),
    }
    columns = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ORDER_BOOK_RAW]
    return spark.range(n).select(*columns)


def test_pipeline_by_increments(spark, tmp_path):
    from ledgerline.schemas import ORDER_BOOK_RAW

    zones = rule_pipeline.Zones(*(str(tmp_path / n) for n in ("in", "transformed", "published", "progress")))
    known = spark.createDataFrame([(1, "dropNull"), (2, "customModel"), (3, "getTrimmedDataframe")], RULES)
    asked = []

    def metadata():
        asked.append(1)
        lists = spark.createDataFrame([("DS2", "testing", "1", "1"), ("DS1", "training", "1", "3,2")], RULE_LISTS)
        return log_frame(spark).where("file_upld_log_id = 1"), lists, known

    def deliver(first, n):
        order_rows(spark, first, n).write.mode("append").options(**sinks.CSV_WRITE).csv(zones.incoming)

    def load():
        rule_pipeline.load_through_rules(spark, "DS1", ORDER_BOOK_RAW, ORDER_BOOK_RAW, zones, metadata)
        rows = spark.read.parquet(f"{zones.published}/DS1").orderBy("`S.No`").collect()
        assert [r["S.No"] for r in rows] == list(range(1, len(rows) + 1))
        return rows

    deliver(1000, 30)
    assert len(load()) == 30 and len(asked) == 1
    deliver(100, 20)
    rows = load()
    assert len(rows) == 50 and {r["OrderNumber"] // 1000 for r in rows[:30]} == {1}  # earlier numbers stay
    assert {r["BillToName"] for r in rows} == {'a "b",\n c'}
    assert len(load()) == 50 and len(asked) == 2  # nothing new
    for commit in (tmp_path / "progress" / "stream" / "commits").glob("*1*"):
        commit.unlink()  # as if the run had ended before the second batch was confirmed
    assert [tuple(r) for r in load()] == [tuple(r) for r in rows] and len(asked) == 3
    deliver(5000, 1)
    assert load()[-1]["OrderNumber"] == 5000


def test_pipeline_stops_at_unknown_rules(spark, tmp_path):
    from ledgerline.schemas import ORDER_BOOK_RAW

    zones = rule_pipeline.Zones(*(str(tmp_path / n) for n in ("in", "transformed", "published", "progress")))
    order_rows(spark, 1, 2).write.options(**sinks.CSV_WRITE).csv(zones.incoming)
    known = spark.createDataFrame([(1, "noSuchRule")], RULES)
    lists = spark.createDataFrame([("DS1", "training", "1", "1")], RULE_LISTS)
    log = log_frame(spark).where("file_upld_log_id = 1")
    with pytest.raises(Exception, match="unknown rules"):
        rule_pipeline.load_through_rules(spark, "DS1", ORDER_BOOK_RAW, ORDER_BOOK_RAW, zones, lambda: (log, lists, known))
    assert not (tmp_path / "published").exists()


def test_incremental_csv_keeps_texts(spark, tmp_path):
    texts = ['a "q", b', "two\nlines", " padded ", 'mixed, "x"\r\n\\end\\', None, "é,ü"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    folder, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows.write.options(**sinks.CSV_WRITE).csv(folder)
    load_new_rows(spark, folder, rows.schema, target, str(tmp_path / "progress"), lambda d: d)
    assert sorted((r.n, r.t) for r in spark.read.parquet(target).collect()) == list(enumerate(texts))


def test_a_version_by_rename(spark, tmp_path, monkeypatch):
    """Stores other than a local folder: a rename that refuses a target, also one that appears after the first look."""
    real, blind = commits._path, []

    class Store:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return getattr(self.files, name)

        def getScheme(self):
            return "store"

        def exists(self, path):
            return False if blind and blind.pop() else self.files.exists(path)

    def path(session, name):
        found, files = real(session, name)
        return found, Store(files)

    monkeypatch.setattr(commits, "_path", path)
    target = commits.version_file(str(tmp_path / "v"), 1)
    assert commits.create_once(spark, target, '{"a": 1}') and not commits.create_once(spark, target, '{"a": 2}')
    blind.append(True)
    assert not commits.create_once(spark, target, '{"a": 3}')
    assert commits.read_version(spark, str(tmp_path / "v"), 1) == {"a": 1}
    assert [p.name for p in (tmp_path / "v").iterdir() if not p.name.startswith(".")] == ["000000000001.json"]
