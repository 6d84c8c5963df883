"""Exact duplicates, mixing, sharding, url filter."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from playthrough.llm import exact_dedup, mixing, sharding, url_reputation

ODD = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (4, "x " * 30_000), (5, "a b"), (6, " a b"), (None, None)]


def test_duplicate_report_of_odd_rows(docs_of):
    rows = exact_dedup.duplicate_report(docs_of(ODD), keep="largest").collect()
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows)
    assert found == {
        (1, 2, 3, False): 1, (2, 2, 3, True): 1, (None, 2, 3, False): 1, (3, 5, 4, False): 2, (None, 5, 4, False): 1,
        (5, 5, 4, True): 1, (4, 4, 1, True): 1, (6, 6, 1, True): 1,
    }
    assert exact_dedup.duplicate_report(docs_of(ODD)).filter("kept").count() == 5


def test_colliding_digests_are_told_apart_by_bytes(docs_of):
    docs = docs_of([(i, f"text {i % 7}") for i in range(40)])
    rows = exact_dedup.duplicate_report(docs, digest=lambda text: F.lit(1)).collect()
    assert {(r.doc_id, r.keep_id) for r in rows} == {(i, i % 7) for i in range(40)}


def test_drop_duplicates_keeps_one_row_per_text(docs_of):
    kept = exact_dedup.drop_duplicates(docs_of(ODD), keep="largest")
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]
    assert kept.columns == docs_of(ODD).columns


def test_mixing_fills_sources_up_to_their_caps(docs_of):
    rows = [(i, "w " * (i % 5), ["a", "b", "c", None][min(i % 9, 3)]) for i in range(400)]
    got = mixing.mix_report(docs_of(rows)).collect()
    assert len(got) == 400
    source_of = {r[0]: r[2] for r in rows}
    targets = {source_of[r.doc_id]: (r.source_size, r.target) for r in got}
    total = sum(i % 5 for i in range(400))
    assert sum(t for _, t in targets.values()) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s for s, t in targets.values())
    assert all(r.taken in {0, r.size, 2 * r.size} for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[source_of[r.doc_id]] += r.taken
    assert all(abs(taken[s] - t) < 0.35 * t for s, (_, t) in targets.items())
    emitted = mixing.mix(docs_of(rows)).groupBy("doc_id").count().collect()
    for_one = {r.doc_id: r["count"] for r in emitted}
    assert all(r.taken == r.size * for_one.get(r.doc_id, 0) for r in got if r.size)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, " \t", "a"), (2, "", None)]])
def test_mixing_without_words(docs_of, rows):
    assert all(r.target == 0 and r.taken == 0 for r in mixing.mix_report(docs_of(rows)).collect())


@pytest.mark.parametrize("hot", [0, 100, 290])
def test_shards_are_even_and_keep_copies_together(docs_of, hot):
    rng = random.Random(hot)
    rows = [(i, "hot" if i < hot else f"t{rng.randrange(60) if i % 3 == 0 else 100 + i}") for i in range(290)]
    got = sharding.balanced_shards(docs_of(rows + [(None, None), (7, "hot")]), n_shards=8, cells=4).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if not hot:
        shards = defaultdict(set)
        for r in got:
            shards[r.text_crc32].add(r.shard)
        split = sum(len(s) > 1 for s in shards.values())
        assert split <= 0.05 * len(shards)


def test_sharding_of_nothing(docs_of):
    assert sharding.balanced_shards(docs_of([])).count() == 0


URLS = {
    "http://Example.ORG/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
    "https://a.b.example.org/en/1x?q#f": ("a.b.example.org", "/en/1x", "example.org/en/1", "block"),
    "https://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
    "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
    "x://y.com/fr/a://b": ("y.com", "/fr/a://b", "com/fr/", "allow"),
    "http://x.org": ("x.org", "", None, None),
    "no address": ("", "", None, None),
    None: ("", "", None, None),
}


def test_rules_and_addresses(spark):
    pages = spark.createDataFrame([(i, u, 5) for i, u in enumerate(URLS)], "page_id long, url string, host int")
    labels = spark.createDataFrame([], "page_id long, good int")
    for r, (host, path, rule, verdict) in zip(
        sorted(url_reputation.judge(pages, labels).collect(), key=lambda r: r.page_id), URLS.values()
    ):
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict in (None, r.verdict)


def test_bad_hosts_are_blocked_and_unknown_ones_follow_their_domain(spark):
    rows, labels = [], []
    for i in range(400):
        host = ["bad.one.net", "good.one.net", "a.two.net", "b.two.net"][i % 4]
        rows.append((i, f"http://{host}/{i}"))
        labels.append((i, 0 if host.startswith("bad") else 1))
    rows += [(900, "http://new.two.net/"), (901, "http://[::1]:80/x")]
    judged = url_reputation.judge(
        spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, good int")
    )
    verdicts = {r.host: r.verdict for r in judged.collect()}
    assert verdicts["bad.one.net"] == "block"
    assert verdicts["good.one.net"] == verdicts["a.two.net"] == verdicts["new.two.net"] == "allow"


def test_url_filter_of_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_reputation.judge(pages, spark.createDataFrame([], "page_id long, good int")).count() == 0
