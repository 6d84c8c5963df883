"""Command line of the jobs: spark-submit … -m playthrough JOB, or python -m playthrough JOB."""

from __future__ import annotations

import argparse
import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from playthrough.plans import jobs
from playthrough.sources import messages
from playthrough.streaming import ingest


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="playthrough")
    job = top.add_subparsers(dest="job", required=True)
    job.add_parser("create-inputs", help="create the empty input tables")
    clean = job.add_parser("clean", help="add valid raw events to the cleaned ones")
    clean.add_argument("--keep-rejected", action="store_true", help="store rejected rows with their reason")
    clean.add_argument("--oldest", type=int, help="look at so many of the oldest events that no such run has come to")
    job.add_parser("enrich", help="join the cleaned events with users and content")
    features = job.add_parser("features", help="build the feature table")
    features.add_argument("--as-of", type=datetime.date.fromisoformat, help="day content ages count to; today")
    features.add_argument("--intermediates", action="store_true", help="store the tables behind it too")
    train = job.add_parser("train", help="train, save and evaluate the model")
    train.add_argument("model")
    score = job.add_parser("score", help="store predictions of a saved model")
    score.add_argument("model")
    score.add_argument("out")
    score.add_argument("--query", default=f"SELECT * FROM {jobs.FEATURES}")
    stream = job.add_parser("ingest", help="store messages from a folder of JSON lines or a Kafka topic")
    for name in ["messages", "table", "quarantine", "checkpoint"]:
        stream.add_argument(name)
    stream.add_argument("--servers", help="Kafka servers; messages is then the topic")
    stream.add_argument("--group", help="Kafka consumer group")
    stream.add_argument("--max-per-trigger", type=int, help="Kafka messages in a micro-batch at most")
    add_tls(stream)
    stream.add_argument("--clean", action="store_true", help="quarantine invalid events too")
    stream.add_argument("--remember-days", type=int, help="look for repeated ids in so many days only, see the module")
    stream.add_argument("--stream", default="", help="name of this stream among those that write to the table")
    stream.add_argument("--backlog", action="store_true", help="stop after what is there now")
    publish = job.add_parser("publish", help="send a file of JSON lines to a Kafka topic")
    for name in ["lines", "servers", "topic"]:
        publish.add_argument(name)
    add_tls(publish)
    return top


def add_tls(job: argparse.ArgumentParser) -> None:
    for name in ["ca", "certificate", "key"]:
        job.add_argument(f"--{name}", type=Path, help=f"PEM file of the TLS {name}")


def tls(a: argparse.Namespace) -> dict[str, str]:
    """TLS options from the PEM files, which the driver reads; none if no file is given."""
    if a.ca is None:
        return {}
    return messages.tls_options(a.ca.read_text(), a.certificate.read_text(), a.key.read_text())


def source(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.servers is None:
        return messages.file_messages(spark, a.messages)
    options = messages.kafka_options(
        a.servers, a.messages, tls=tls(a), group=a.group, max_per_trigger=a.max_per_trigger
    )
    return messages.kafka_messages(spark, options)


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"playthrough {a.job}").getOrCreate()
    match a.job:
        case "create-inputs":
            jobs.create_inputs(spark)
        case "clean":
            print(jobs.clean_oldest(spark, a.oldest) if a.oldest else jobs.clean(spark, a.keep_rejected))
        case "enrich":
            jobs.enrich_events(spark)
        case "features":
            jobs.features(spark, a.as_of, a.intermediates)
        case "train":
            evaluation = jobs.train(spark, a.model)
            evaluation.report.show(truncate=False)
            evaluation.roc_auc.show()
            evaluation.average_precision.show()
        case "score":
            jobs.score(spark, a.model, a.out, a.query)
        case "ingest":
            for key, value in ingest.STATE_STORE.items():
                if spark.conf.get(key, None) is None:
                    spark.conf.set(key, value)
            ingest.ingest(
                source(spark, a),
                table=a.table,
                quarantine=a.quarantine,
                checkpoint=a.checkpoint,
                trigger=ingest.BACKLOG if a.backlog else ingest.LIVE,
                clean=a.clean,
                remember_days=a.remember_days,
                stream=a.stream,
            ).awaitTermination()
        case "publish":
            options = {"kafka.bootstrap.servers": a.servers, "topic": a.topic, **tls(a)}
            messages.publish(spark, a.lines, "kafka", **options)


if __name__ == "__main__":
    main()
