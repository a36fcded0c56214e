"""Topic records, second writers and feed frames derived from an `events` table.

Rules are those of FIXTURES.md; the SQL checks state them again, straight from `events`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.keyed import deletes, upserts
from millrace.schemas import ALLOWED_DOMAINS, COORDINATES, INPUT_TOPIC, PROCESSED_TOPIC, SEQ
from millrace.sources.topics import as_topic

PARTITIONS = 4
LITTLE = 5.0
DOMAIN_OF = {
    "click": "en.wikipedia.org",
    "view": "www.wikidata.org",
    "purchase": "commons.wikimedia.org",
    "signup": "de.wikipedia.org",
    "error": "uk.wikipedia.org",
}


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with the fields every fixture is made of."""
    columns = ("event_id", "ts", "user_id", "event_type", "value", "props")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(*columns)
    k = F.get_json_object("props", "$.k").cast("int")
    domain = F.coalesce(*[F.when(F.col("event_type") == kind, name) for kind, name in DOMAIN_OF.items()])
    at = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        k.alias("k"),
        at.alias("timestamp"),
        F.date_trunc("day", at).alias("day"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.floor(F.col("event_id") / PARTITIONS).cast("bigint").alias("offset"),
        F.col("value").alias("amount"),
        domain.alias("domain"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("user_text"),
        F.when(k % 10 != 0, k % 4 == 0).alias("is_bot"),
        F.concat(F.lit("Page_"), k).alias("title"),
    )


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def raw_json(event_id: Column) -> Column:
    """The event as its producer writes it: absent flags are left out, one text in 97 is cut off."""
    whole = F.to_json(
        F.struct(
            F.struct(event_id.alias("id"), day_text(F.col("day")).alias("dt"), F.col("domain")).alias("meta"),
            F.struct(F.col("user_text"), F.col("is_bot").alias("user_is_bot")).alias("performer"),
            F.col("title").alias("page_title"),
        )
    )
    return F.when(F.col("event_id") % 97 == 0, F.substring(whole, 1, 20)).otherwise(whole)


def _made_once(df: DataFrame) -> DataFrame:
    """Values of a topic are there, not computed: keep filters on `value` from repeating its making."""
    others = [name for name in df.columns if name != "value"]
    return df.select(*others, F.explode(F.array("value")).alias("value"))


def raw_topic(spark: SparkSession, sf_dir: str, event_id: Column | None = None) -> DataFrame:
    """The `input` topic."""
    event_id = F.col("event_id").cast("string") if event_id is None else event_id
    records = source_events(spark, sf_dir).withColumn("value", raw_json(event_id))
    return as_topic(_made_once(_records(records)), INPUT_TOPIC)


def raw_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `input` topic without its values."""
    return source_events(spark, sf_dir).select(F.lit(INPUT_TOPIC).alias("topic"), *COORDINATES)


def _records(events: DataFrame) -> DataFrame:
    return events.select(F.lit(None).cast("binary").alias("key"), "value", *COORDINATES)


def uneven_processed_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A `processed` topic of all events with faults of every kind the table writer knows."""
    n = F.col("event_id")
    created_at = (
        F.when(n % 89 == 1, "12:30:00")
        .when(n % 89 == 2, "not a time")
        .when(n % 89 == 6, "12345-01-01T00:00:00Z")
        .when(n % 89 == 7, "0000-01-01T00:00:00Z")
        .otherwise(day_text(F.col("day")))
    )
    whole = F.to_json(
        F.struct(
            F.col("user_text").alias("user_id"),
            F.when(n % 79 == 3, "").otherwise(F.col("domain")).alias("domain"),
            created_at.alias("created_at"),
            F.when(n % 83 != 4, F.col("title")).alias("page_title"),
        )
    )
    value = F.when(n % 97 == 0, F.substring(whole, 1, 20)).when(n % 101 == 5, "[]").otherwise(whole)
    records = source_events(spark, sf_dir).withColumn("value", value)
    return as_topic(_made_once(_records(records)), PROCESSED_TOPIC)


def _seq(after: str) -> Column:
    return F.struct(
        (F.col("timestamp") + F.expr(f"INTERVAL {after}")).alias("timestamp"), F.col("partition"), F.col("offset")
    ).cast(SEQ)


def flag_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second writer: half a day after every event on an allowed domain it sets the flag where it
    is known, and a title of its own for every other one of them."""
    events = source_events(spark, sf_dir).filter(F.col("domain").isin(*ALLOWED_DOMAINS))
    rows = events.select(
        "domain",
        F.col("day").alias("created_at"),
        F.col("user_text").alias("user_id"),
        F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("Flag_"), F.col("k"))).alias("page_title"),
        F.col("is_bot").alias("user_is_bot"),
        _seq("12 hours").alias("seq"),
    )
    return upserts(rows, F.col("seq"), "flags", 0)


def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes for every event of little value, at the very place of the second writer's write for it."""
    events = source_events(spark, sf_dir).filter(F.col("amount") < LITTLE)
    keys = events.select(
        "domain", F.col("day").alias("created_at"), F.col("user_text").alias("user_id"), _seq("12 hours").alias("seq")
    )
    return deletes(keys, F.col("seq"), "cleaner", 0)


def mixed_uuid(event_id: Column) -> Column:
    """Ids from the MD5 of the event number, in plain, dashed, braced, URN and invalid notation."""
    plain = F.md5(event_id.cast("string"))
    dashed = F.regexp_replace(plain, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return (
        F.when(event_id % 5 == 0, plain)
        .when(event_id % 5 == 1, F.upper(dashed))
        .when(event_id % 5 == 2, F.concat(F.lit("{"), dashed, F.lit("}")))
        .when(event_id % 5 == 3, F.concat(F.lit("urn:uuid:"), dashed))
        .otherwise(F.substring(plain, 1, 31))
    )


def feed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed frames: every 7th event's JSON over two data lines, every 11th frame without data, and
    comment lines in every 5th."""
    n = F.col("event_id")
    whole = raw_json(n.cast("string"))
    two_lines = F.regexp_replace(whole, '^\\{"meta":', '{"meta":\ndata: ')
    data = F.when(n % 7 == 0, two_lines).otherwise(whole)
    comment = F.when(n % 5 == 0, ":keep-alive\n").otherwise("")
    head = F.concat(comment, F.lit("event: message\nid: "), n.cast("string"), F.lit("\ndata:"))
    frame = F.when(n % 11 == 0, head).otherwise(F.concat(head, F.lit(" "), data))
    return source_events(spark, sf_dir).select(frame.alias("value"))


def allow_list_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of an allow-list: on two days of three a domain begins to be allowed at 6 o'clock, on even days
    for 18 hours, on odd ones until its next version."""
    days = source_events(spark, sf_dir).select("domain", "day").distinct()
    begun = days.filter(F.dayofyear("day") % 3 != F.length("domain") % 3)
    since = F.col("day") + F.expr("INTERVAL 6 HOURS")
    until = F.when(F.dayofmonth("day") % 2 == 0, F.col("day") + F.expr("INTERVAL 24 HOURS"))
    return begun.select("domain", since.alias("valid_from"), until.alias("valid_to"))


def wanted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of events by the whole part of their amount, on the first nine days of a month."""
    events = source_events(spark, sf_dir).filter((F.floor("amount") % 7 == 0) & (F.dayofmonth("day") <= 9))
    return events.select("domain", F.col("day").alias("created_at"), F.col("user_text").alias("user_id"))
