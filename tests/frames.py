"""Small enriched frames made by hand or at random."""

import datetime
import random

from playthrough.schemas import ENRICHED

T0 = 1704067200000  # 2024-01-01
SIGNUP = datetime.datetime(2023, 6, 1)


def event(
    i, ts, user="u", content="c", kind="play", position=10, runtime=100, genre="drama", year=2000, signup=SIGNUP
):
    return (
        str(i), ts, user, f"{user}@example.com", "basic", signup,
        content, genre, runtime, year, "PG", kind, position, "tv",
    )


def enriched(spark, events):
    order = [
        "event_id", "event_ts", "user_id", "email", "plan_tier", "signup_date", "content_id", "genre", "runtime",
        "release_year", "maturity_rating", "event_type", "playback_position", "device",
    ]
    assert order == ENRICHED.fieldNames()
    return spark.createDataFrame(events, ENRICHED).repartition(3)


def random_events(seed, n):
    """A third of the rows at one moment, one user and one title with most of the rows, many ties."""
    rng = random.Random(seed)
    genres = {f"c{k}": f"g{k % 3}" for k in range(6)}
    out = []
    for i in range(n):
        user = "u0" if rng.random() < 0.7 else f"u{rng.randrange(1, 5)}"
        content = "c0" if rng.random() < 0.6 else f"c{rng.randrange(1, 6)}"
        day = rng.randrange(0, 70)
        minute = rng.choice([0, 10, 20, 40, 41, 70, 100])
        ts = T0 + 86400000 * 20 if rng.random() < 0.33 else T0 + 86400000 * day + 60000 * minute
        out.append(
            event(
                f"e{i:05d}", ts, user, content,
                kind=rng.choice(["play", "pause", "stop", "complete", "seek"]),
                position=rng.randrange(0, 130), runtime=rng.choice([0, 60, 100, 120]), genre=genres[content],
            )
        )
    return out


def by_id(df, column):
    return {r["event_id"]: r[column] for r in df.select("event_id", column).collect()}
