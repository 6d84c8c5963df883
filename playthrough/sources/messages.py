"""Event messages: a Kafka topic or a folder of line-delimited JSON, one object per message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playthrough.operators.cleaning import NUMERIC, to_integer
from playthrough.schemas import EVENT_COLUMNS

NOT_JSON, MISSING_KEY, NO_ID, NOT_NUMERIC = "not_json", "missing_key", "null_event_id", "not_numeric"

# Numbers are taken as text first, so that one bad value does not void its whole message.
_WIRE = T.StructType([T.StructField(c, T.StringType()) for c in [*EVENT_COLUMNS, "_corrupt"]])


def tls_options(ca_pem: str, certificate_pem: str, key_pem: str) -> dict[str, str]:
    """TLS with PEM texts, for reading and for writing."""
    return {
        "kafka.security.protocol": "SSL",
        "kafka.ssl.truststore.type": "PEM",
        "kafka.ssl.truststore.certificates": ca_pem,
        "kafka.ssl.keystore.type": "PEM",
        "kafka.ssl.keystore.certificate.chain": certificate_pem,
        "kafka.ssl.keystore.key": key_pem,
    }


def kafka_options(
    servers: str,
    topic: str,
    *,
    tls: dict[str, str] | None = None,
    group: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """New messages only; offsets live in the query's checkpoint.

    ``max_per_trigger`` bounds a micro-batch; by default it takes all there is, so that it cannot fall behind.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        **(tls or {}),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options if group is None else {**options, "kafka.group.id": group}


def kafka_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder).select("value")


def publish(spark: SparkSession, lines: str, sink: str, **options: str) -> None:
    """Send a line-delimited JSON file to a topic (``sink="kafka"``) or to files, a message a line."""
    spark.read.text(lines).select("value").write.format(sink).options(**options).mode("append").save()


def parse_messages(messages: DataFrame) -> DataFrame:
    """The event columns, the message itself and ``problem`` (null for a usable message).

    Keys other than the event's are ignored. A key may hold null, except for the id, but has to
    be there.
    """
    parsed = messages.select(
        "value",
        F.json_object_keys("value").alias("_keys"),
        F.from_json("value", _WIRE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("_e"),
    )
    event = F.col("_e")
    numbers = {c: to_integer(event[c], T.StringType(), NUMERIC[c]) for c in NUMERIC}
    unreadable = F.col("_keys").isNull() | event.isNull() | event["_corrupt"].isNotNull()
    has_all_keys = F.size(F.array_except(F.array(*map(F.lit, EVENT_COLUMNS)), F.col("_keys"))) == 0
    bad_number = F.lit(False)
    for c in NUMERIC:
        bad_number = bad_number | (event[c].isNotNull() & numbers[c].isNull())
    problem = (
        F.when(unreadable, NOT_JSON)
        .when(~has_all_keys, MISSING_KEY)
        .when(event["event_id"].isNull(), NO_ID)
        .when(bad_number, NOT_NUMERIC)
    )
    columns = [numbers.get(c, event[c]).alias(c) for c in EVENT_COLUMNS]
    return parsed.select(*columns, "value", problem.alias("problem"))
