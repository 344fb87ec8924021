"""Rule lookup, zone loads, incremental loads and the ingest log."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import parse_us_date
from ledgerline.operators.order_model import published_rows
from ledgerline.operators.series import monthly_volume
from ledgerline.operators.shaping import apply_mapping
from ledgerline.plans import adapters, rules
from ledgerline.plans.catalog import Catalog
from ledgerline.plans.catalog.cleaning import PUBLISHED, TRIMMED, typed_order_book
from ledgerline.plans.ingest_log import append_log, read_log, stamp_newest
from ledgerline.plans.jobs import home_volume
from ledgerline.schemas import CHURN, ORDER_BOOK_RAW
from ledgerline.session import remove, scratch_path, table, wide_writes, written
from ledgerline.sources.checked import read_rates
from ledgerline.sources.files import has_rows, latest_file, list_files, read_catalog_table, read_csv, read_parquet_zone
from ledgerline.sources.files import read_zone, register_zone, with_file
from ledgerline.sources.sinks import CSV_WRITE, UPLOAD_COLUMN, write_zone
from ledgerline.streaming.incremental import load_new_batches, load_new_rows
from ledgerline.streaming.rule_pipeline import Zones, load_through_rules

CATALOG = Catalog()

LOG = f"log AS ({adapters.named_tables(adapters.INGEST_LOG_SQL)})"
LISTS = f"lists AS ({adapters.named_tables(adapters.RULE_LISTS_SQL)})"
RULES = f"rules AS ({adapters.named_tables(adapters.RULES_SQL)})"
CHURN_TABLE = f"churn AS ({adapters.named_tables(adapters.CHURN_SQL)})"


def _entries(stage: str) -> str:
    return f"""items AS (SELECT file_src_cd, file_upld_type, unnest(string_split({stage}, ',')) AS item,
      generate_subscripts(string_split({stage}, ','), 1) - 1 AS pos FROM lists),
    entries AS (SELECT file_src_cd, file_upld_type, trim(item) AS entry, min(pos) AS position FROM items
      WHERE trim(item) <> '' GROUP BY 1, 2, 3),
    named AS (SELECT file_src_cd, file_upld_type, CAST(position AS BIGINT) AS position, rule_id, rule_dscrp
      FROM entries JOIN rules ON CAST(rule_id AS VARCHAR) = entry)"""


@CATALOG.query(
    f"WITH {LOG}, {LISTS}, {RULES}, {_entries(rules.RAW_TO_TRANSFORMED)} "
    "SELECT position, rule_id, rule_dscrp FROM named "
    "WHERE file_src_cd = (SELECT file_src_cd FROM log ORDER BY upld_ts DESC, file_upld_log_id DESC LIMIT 1) "
    "AND file_upld_type = (SELECT file_upld_type FROM log ORDER BY upld_ts DESC, file_upld_log_id DESC LIMIT 1)"
)
def rule_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = rules.resolve_rules(
        adapters.ingest_log(spark, sf_dir),
        adapters.rule_lists(spark, sf_dir),
        adapters.rule_catalogue(spark, sf_dir),
        rules.RAW_TO_TRANSFORMED,
    )
    return resolved.withColumn("position", F.col("position").cast("bigint"))


@CATALOG.query(
    f"WITH {LISTS}, {RULES}, {_entries(rules.TRANSFORMED_TO_PUBLISHED)} "
    "SELECT file_src_cd, file_upld_type, position, rule_id, rule_dscrp FROM named"
)
def rule_lists_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = rules.name_entries(
        adapters.rule_lists(spark, sf_dir), adapters.rule_catalogue(spark, sf_dir), rules.TRANSFORMED_TO_PUBLISHED
    )
    return named.withColumn("position", F.col("position").cast("bigint"))


def _order_rules(spark: SparkSession, sf_dir: str) -> list[str]:
    """Rule names for the order book, looked up for the newest upload in the log."""
    names = spark.createDataFrame(
        [(1, "dropNull"), (2, "customModel"), (3, "getTrimmedDataframe")], "rule_id long, rule_dscrp string"
    )
    lists = adapters.rule_lists(spark, sf_dir).withColumn(rules.TRANSFORMED_TO_PUBLISHED, F.lit("3, 1,2"))
    log = adapters.ingest_log(spark, sf_dir)
    return rules.rule_names(rules.resolve_rules(log, lists, names, rules.TRANSFORMED_TO_PUBLISHED))


NUMBERED = (
    f"{PUBLISHED} SELECT UniqueId AS unique_id, Country AS country, Region AS region, SLA AS sla, "
    "OrderNetValue AS net_value, "
    "row_number() OVER (ORDER BY UniqueId NULLS FIRST, MarketingGroup NULLS FIRST, OrderNumber) AS s_no FROM published"
)


def _numbered(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("UniqueId").alias("unique_id"),
        F.col("Country").alias("country"),
        F.col("Region").alias("region"),
        F.col("SLA").cast("bigint").alias("sla"),
        F.col("OrderNetValue").alias("net_value"),
        F.col("`S.No`").cast("bigint").alias("s_no"),
    )


@CATALOG.query(NUMBERED)
def rule_chain_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(rules.apply_rules(typed_order_book(spark, sf_dir), _order_rules(spark, sf_dir)))


@CATALOG.query(NUMBERED)
def order_book_two_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw to transformed to published, each zone written and read back."""
    transformed, out = scratch_path(spark, "transformed"), scratch_path(spark, "published")
    raw = apply_mapping(adapters.raw_order_book(spark, sf_dir), ORDER_BOOK_RAW)
    if has_rows(table(spark, sf_dir, "orders")):  # asks the scan, not the joined book
        rules.run_stage(raw, rules.RAW_TO_TRANSFORMED, "DS1", rules.Target(transformed), ["dropNull"])
    zone = read_zone(spark, transformed, "DS1", "csv", ORDER_BOOK_RAW)
    written = rules.run_stage(
        zone, rules.TRANSFORMED_TO_PUBLISHED, "DS1", rules.Target(out), _order_rules(spark, sf_dir)
    )
    return _numbered(read_zone(spark, out, "DS1", "csv", written.schema))


@CATALOG.query(f"WITH {CHURN_TABLE} SELECT * FROM churn")
def churn_two_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    transformed, out = scratch_path(spark, "transformed"), scratch_path(spark, "published")
    raw = apply_mapping(adapters.churn_table(spark, sf_dir), CHURN)
    rules.run_stage(raw, rules.RAW_TO_TRANSFORMED, "DS2", rules.Target(transformed))
    zone = read_zone(spark, transformed, "DS2", "parquet")
    rules.run_stage(zone, rules.TRANSFORMED_TO_PUBLISHED, "DS2", rules.Target(out))
    return read_zone(spark, out, "DS2", "csv", CHURN)


_ZONE_COLUMNS = ["ordernumber", "deliverymethod", "orderreceiveddate", "ordergrossvalue", "currencycode", "file_type"]


@CATALOG.query(f"{TRIMMED} SELECT {', '.join(_ZONE_COLUMNS)} FROM book")
def zone_roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = scratch_path(spark, "zone")
    book = typed_order_book(spark, sf_dir).select(_ZONE_COLUMNS)
    write_zone(book, zone, "DS1", "csv")
    return read_zone(spark, zone, "DS1", "csv", book.schema)


@CATALOG.query(
    f"{TRIMMED} SELECT ordernumber, currencycode, file_type, "
    "CASE WHEN file_type = 'training' THEN ordergrossvalue END AS ordergrossvalue FROM book"
)
def zone_roundtrip_parquet_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training files hold one column more than the others."""
    zone = scratch_path(spark, "zone")
    book = typed_order_book(spark, sf_dir).select("ordernumber", "currencycode", "file_type", "ordergrossvalue")
    training = F.col("file_type") == "training"
    write_zone(book.where(~training).drop("ordergrossvalue"), zone, "DS1", "parquet")
    write_zone(book.where(training), zone, "DS1", "parquet")
    return read_parquet_zone(spark, f"{zone}/DS1")


@CATALOG.query(NUMBERED)
def published_parquet_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule list that names the Parquet writer of the published zone."""
    out = scratch_path(spark, "published")
    names = ["writeDataIntoPublishedS3ZoneInParquet", "customModel"]  # writers run last, wherever they stand
    rules.run_stage(typed_order_book(spark, sf_dir), rules.TRANSFORMED_TO_PUBLISHED, "DS1", rules.Target(out), names)
    return _numbered(read_zone(spark, out, "DS1", "parquet"))


@CATALOG.query(
    f"{PUBLISHED} SELECT CASE WHEN OrderNumber % 2 = 0 THEN 'even' ELSE 'odd' END AS upload_id, "
    "CAST(CAST(date_trunc('month', strptime(OrderReceivedDate, '%m/%d/%Y')) AS DATE) AS VARCHAR) AS month, "
    "count(UniqueId) AS volume FROM published WHERE file_type = 'training' AND Country = 'Usa' GROUP BY 1, 2"
)
def volumes_per_training_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two uploads of many files each, read in one scan: a monthly series per training upload."""
    zone = scratch_path(spark, "published")
    rows = written(
        published_rows(typed_order_book(spark, sf_dir)).select(
            "UniqueId", "OrderNumber", "OrderReceivedDate", "Country", "file_type"
        ),
        "book",
    )
    for name, rest in (("even", 0), ("odd", 1)):
        write_zone(rows.where(F.col("OrderNumber") % 2 == rest), zone, "DS1", "csv", upload_id=name)
    read = read_zone(spark, zone, "DS1", "csv", rows.withColumn(UPLOAD_COLUMN, F.lit("")).schema)
    volume = home_volume(read.where(F.col("file_type") == "training"), key=[UPLOAD_COLUMN])
    return volume.withColumn("month", F.col("month").cast("string"))


_EVENT_SQL = "SELECT event_id, user_id, upper(event_type) AS event_type, value FROM events"


def _event_drops(spark: SparkSession, sf_dir: str, folder: str):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    for part in (0, 1):
        drop = events.where(F.col("event_id") % 2 == part)
        drop.write.mode("append").option("header", True).csv(folder)
        yield events.schema


@CATALOG.query(_EVENT_SQL)
def incremental_zone_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries into one folder, a load after each and one load without new files."""
    folder, target, progress = (scratch_path(spark, n) for n in ("incoming", "loaded", "progress"))

    def clean(rows: DataFrame) -> DataFrame:
        return rows.withColumn("event_type", F.upper("event_type"))

    for schema in _event_drops(spark, sf_dir, folder):
        load_new_rows(spark, folder, schema, target, progress, clean)
    load_new_rows(spark, folder, schema, target, progress, clean)
    return spark.read.parquet(target)


@CATALOG.query("SELECT user_id, count(*) AS events, round(sum(CAST(value AS DECIMAL(18,2)))::DOUBLE, 2) AS value FROM events GROUP BY 1")
def incremental_batch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each delivery is rolled up as a batch of its own; the batch results add up to the whole."""
    folder, target, progress = (scratch_path(spark, n) for n in ("incoming", "loaded", "progress"))

    def roll_up(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("value")
        )

    for schema in _event_drops(spark, sf_dir, folder):
        load_new_batches(spark, folder, schema, target, progress, roll_up)
    loaded = spark.read.parquet(target).groupBy("user_id")
    return loaded.agg(
        F.sum("events").alias("events"), F.round(F.sum("value").cast("double"), 2).alias("value")
    )


def _three_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book with the number of each row's delivery, a folder per delivery, so that each reads its own rows only."""
    book = adapters.raw_order_book(spark, sf_dir).withColumn("delivery", F.col("ordernumber") % 3)
    place = scratch_path(spark, "deliveries")
    with wide_writes(spark):
        book.write.partitionBy("delivery").parquet(place)
    return spark.read.schema(book.schema).parquet(place)


@CATALOG.query(
    f"{PUBLISHED} SELECT UniqueId AS unique_id, Country AS country, OrderNetValue AS net_value, OrderNumber % 3 AS delivery, "
    "(SELECT count(*) FROM published q WHERE q.OrderNumber % 3 < p.OrderNumber % 3) + row_number() OVER ("
    "PARTITION BY OrderNumber % 3 ORDER BY UniqueId NULLS FIRST, MarketingGroup NULLS FIRST, OrderNumber) AS s_no "
    "FROM published p"
)
def incremental_rule_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries through both stages, one by one, and the last batch run again as after a crash: its commit is
    taken back, so the stream repeats it. The sequence number goes on from delivery to delivery."""
    book = _three_deliveries(spark, sf_dir)
    schema = book.drop("delivery").schema
    incoming, transformed, out, progress = (scratch_path(spark, n) for n in ("incoming", "transformed", "published", "progress"))
    zones = Zones(incoming, transformed, out, progress)
    names = spark.createDataFrame(
        [(1, "dropNull"), (2, "customModel"), (3, "getTrimmedDataframe")], "rule_id long, rule_dscrp string"
    )
    lists, log = adapters.rule_lists(spark, sf_dir), written(adapters.ingest_log(spark, sf_dir), "log")
    lists = written(
        lists.withColumns({rules.RAW_TO_TRANSFORMED: F.lit("1"), rules.TRANSFORMED_TO_PUBLISHED: F.lit("3, 1,2")}), "lists"
    )

    def load() -> None:
        load_through_rules(spark, "DS1", schema, ORDER_BOOK_RAW, zones, lambda: (log, lists, names))

    for number in range(3):
        delivery = book.where(F.col("delivery") == number).drop("delivery")
        with wide_writes(spark):
            delivery.write.mode("append").options(**CSV_WRITE).csv(incoming)
        load()
    remove(spark, f"{progress}/stream/commits/2")
    load()
    rows = spark.read.parquet(f"{out}/DS1")
    return rows.select(
        F.col("UniqueId").alias("unique_id"),
        F.col("Country").alias("country"),
        F.col("OrderNetValue").alias("net_value"),
        F.col("batch_id").cast("bigint").alias("delivery"),
        F.col("`S.No`").cast("bigint").alias("s_no"),
    )


@CATALOG.query(
    f"{TRIMMED} SELECT ordernumber, currencycode, ordergrossvalue FROM book WHERE file_type = 'retraining'"
)
def catalog_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone as a catalog table: its partitions recovered, one of them read."""
    zone = scratch_path(spark, "zone")
    book = typed_order_book(spark, sf_dir).select("ordernumber", "currencycode", "ordergrossvalue", "file_type")
    write_zone(book, zone, "DS1", "parquet")
    name = f"ds1_{uuid.uuid4().hex}"
    register_zone(spark, "zones", name, f"{zone}/DS1", book.schema, ["file_type"])
    rows = read_catalog_table(spark, "zones", name).where(F.col("file_type") == "retraining")
    return rows.select("ordernumber", "currencycode", "ordergrossvalue")


_RATE_TABLE = f"rates AS ({adapters.named_tables(adapters.RATES_SQL)})"


@CATALOG.query(
    f"WITH {_RATE_TABLE}, marked AS (SELECT *, month(rate_date) AS m FROM rates) "
    "SELECT currency, count(*) FILTER (m % 6 NOT IN (1, 2, 3)) AS good, count(*) FILTER (m % 6 = 1) AS unreadable, "
    "count(*) FILTER (m % 6 = 2) AS missing, count(*) FILTER (m % 6 = 3) AS not_positive, "
    "CAST(sum(usd_rate) FILTER (m % 6 NOT IN (1, 2, 3)) AS DOUBLE) AS rate_sum FROM marked GROUP BY currency"
)
def checked_rate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates delivered as text, a half of them spoilt in three ways: read, set aside with the reason, and counted back."""
    rates = written(adapters.rates(spark, sf_dir), "rates")
    kind, folder, aside = F.month("rate_date") % 6, scratch_path(spark, "incoming"), scratch_path(spark, "aside")
    rate = F.when(kind == 3, -F.col("usd_rate")).when(kind != 2, F.col("usd_rate")).cast("string")
    text = F.when(kind == 1, "n/a").otherwise(rate)
    spoilt = rates.select("currency", F.col("rate_date").cast("string").alias("rate_date"), text.alias("usd_rate"))
    spoilt.write.options(**CSV_WRITE).csv(folder)
    read = read_rates(spark, folder)
    read.quarantine(aside)
    good = read.good.groupBy("currency").agg(F.count(F.lit(1)).alias("good"), F.sum("usd_rate").alias("rate_sum"))
    reasons = {"unreadable": "unreadable", "missing": "missing usd_rate", "not_positive": "usd_rate not above zero"}
    bad = spark.read.parquet(aside).groupBy(F.substring_index("record", ",", 1).alias("currency")).agg(
        *[F.count_if(F.col("reason") == reason).alias(name) for name, reason in reasons.items()]
    )
    return good.join(bad, "currency", "full").select(
        "currency", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("good", *reasons)], "rate_sum"
    )


_TEXT = (
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '  a \"' || o_orderstatus || '\", b' || chr(10) || "
    "'c,' || chr(92) || chr(13) || chr(10) || o_orderpriority || ' ' END"
)


@CATALOG.query(
    f"WITH t AS (SELECT o_orderkey AS order_id, {_TEXT} AS remark FROM orders) "
    "SELECT reader, order_id, remark FROM t, (VALUES ('zone'), ('analytic'), ('incremental')) AS r(reader)"
)
def csv_texts_in_all_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas, line breaks, outer blanks and nulls, written as CSV and read by the zone reader, the reader
    of published files and the incremental load."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.expr(_TEXT).alias("remark"))
    rows = rows.withColumn("file_type", F.lit("training"))
    zone, target, progress = (scratch_path(spark, n) for n in ("zone", "loaded", "progress"))
    write_zone(rows, zone, "DS1", "csv")
    load_new_rows(spark, f"{zone}/DS1", rows.drop("file_type").schema, target, progress, lambda new: new)
    found = {
        "zone": read_zone(spark, zone, "DS1", "csv", rows.schema),
        "analytic": with_file(read_csv(spark, f"{zone}/DS1", rows.schema)),
        "incremental": spark.read.parquet(target),
    }
    parts = [df.select(F.lit(name).alias("reader"), "order_id", "remark") for name, df in found.items()]
    return reduce(DataFrame.unionByName, parts)


def _published_zone(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Published rows as CSV; the retraining files are written last. The book is computed once."""
    zone = scratch_path(spark, "published")
    rows = published_rows(typed_order_book(spark, sf_dir)).select("UniqueId", "OrderReceivedDate", "Country", "file_type")
    rows = written(rows, "book")
    retraining = F.col("file_type") == "retraining"
    write_zone(rows.where(~retraining), zone, "DS1", "csv")
    write_zone(rows.where(retraining), zone, "DS1", "csv")
    return zone, rows


@CATALOG.query(
    f"{TRIMMED} SELECT upper(file_type[1]) || substr(file_type, 2) AS upload_type, count(*) AS orders FROM book GROUP BY 1"
)
def published_files_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per upload class, where the class of a row is read from the path of its file."""
    zone, rows = _published_zone(spark, sf_dir)
    files = list_files(spark, zone).select("path", "upload_type")
    per_file = (
        with_file(read_csv(spark, f"{zone}/DS1", rows.schema)).groupBy(F.col("source_file").alias("path"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return per_file.join(files, "path").groupBy("upload_type").agg(F.sum("orders").alias("orders"))


@CATALOG.query(f"{TRIMMED} SELECT 'Retraining' AS upload_type, count(*) AS orders FROM book WHERE file_type = 'retraining'")
def latest_published_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of the newest file, and the orders of its class."""
    zone, rows = _published_zone(spark, sf_dir)
    newest = latest_file(list_files(spark, zone)).select("upload_type")
    classes = read_csv(spark, f"{zone}/DS1", rows.schema).groupBy(F.initcap("file_type").alias("upload_type"))
    return classes.agg(F.count(F.lit(1)).alias("orders")).join(newest, "upload_type").select("upload_type", "orders")


@CATALOG.query(
    f"WITH {LOG} SELECT file_upld_log_id, file_src_cd, "
    "CASE WHEN file_upld_log_id = (SELECT file_upld_log_id FROM log ORDER BY upld_ts DESC, file_upld_log_id DESC LIMIT 1) "
    "THEN 'Retraining' END AS stamped FROM log"
)
def ingest_log_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest log row gets the newest published file: one row more in the log, whose uploads are read at their last
    version."""
    zone, _ = _published_zone(spark, sf_dir)
    folder, uploads = scratch_path(spark, "log"), adapters.ingest_log(spark, sf_dir)
    append_log(spark, folder, uploads)
    stamp_newest(spark, folder, latest_file(list_files(spark, zone)), uploads.schema)
    log = read_log(spark, folder, schema=uploads.schema)
    has_name = F.col("published_file_name").startswith("part-")
    kind = F.when(F.col("published_file_path").contains("file_type=retraining") & has_name, "Retraining")
    return log.select("file_upld_log_id", "file_src_cd", kind.alias("stamped"))


@CATALOG.query(
    f"{PUBLISHED} SELECT CAST(CAST(date_trunc('month', strptime(OrderReceivedDate, '%m/%d/%Y')) AS DATE) AS VARCHAR) "
    "AS month, count(UniqueId) AS volume FROM published WHERE file_type = 'training' AND Country = 'Usa' GROUP BY 1"
)
def files_as_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One monthly series per training file, all from one scan; shown as the sum over the files."""
    zone, rows = _published_zone(spark, sf_dir)
    training = with_file(read_csv(spark, f"{zone}/DS1", rows.schema)).where(
        (F.col("file_type") == "training") & (F.col("Country") == "Usa")
    )
    dated = training.withColumn("received", parse_us_date(F.col("OrderReceivedDate")))
    per_file = monthly_volume(dated, "received", "UniqueId", ["source_file"])
    return per_file.groupBy(F.col("month").cast("string").alias("month")).agg(F.sum("volume").alias("volume"))
