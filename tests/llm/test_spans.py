"""Secrets and personal data against plain loops over the same patterns."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from playthrough.llm import pii, secrets, spans

SECRETS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def _luhn(match):
    digits = [int(c) for c in match[0] if c.isdigit()][::-1]
    doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)]
    return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0


PERSONAL = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", _luhn),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m[0]) <= 15),
]


def plain(text, kinds):
    found = []
    for rank, (kind, pattern, valid) in enumerate(kinds):
        for m in re.finditer(pattern, text or ""):
            if valid(m):
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def random_texts(alphabet, n):
    rng = random.Random(n)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


SECRET_TEXTS = [
    None, "", "password=abcdef", "PASSWORD : 'abcde'", "secret=token:abcdefgh", "apikey=token=abcdefgh", "api_key  =  \"a+/_.=-b",
    "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 30, "é😀 token=ſecret1 " + "0f" * 12, "a" * 23 + "g" + "b" * 24,
    "token" + " " * 5000, "f" * 100_000, "token=" * 2000,
]
PERSONAL_TEXTS = [
    None, "", "a@b.c", "a@b.c.@d.e", "@b.c a@b", "x@y..z", "😀 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8", "0001.2.3.255", "1.2.3.0256",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (234) 555-6789", "+12345678", "+1" + "2" * 20,
    "1 " * 30_000, "9" * 50_000, "a" * 50_000, "a." * 20_000 + "@b.c" + ".d" * 20_000,
]


@pytest.mark.parametrize(
    "find, digest, kinds, texts, alphabet",
    [
        (secrets.find_secrets, secrets.digest, SECRETS, SECRET_TEXTS, ["token", "=", ":", " ", '"', "AKIA", "Z9Z9Z9", "0af9", "q"]),
        (pii.find_personal_data, pii.digest, PERSONAL, PERSONAL_TEXTS, ["1", "25", "300", ".", "@", "a", " ", "-", "+", "(", "é"]),
    ],
    ids=["secrets", "personal"],
)
def test_base_spans_equal_a_plain_search(docs_of, find, digest, kinds, texts, alphabet):
    texts = texts + random_texts(alphabet, 300)
    got = {r.doc_id: r for r in digest(find(docs_of(list(enumerate(texts))))).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = plain(text, kinds)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (text, want, got[i].spans)
        assert set(want) <= set(got[i].spans.split(","))
        for kind, _, _ in kinds:
            assert got[i][f"n_{kind}"] == sum(w.startswith(kind + ":") for w in want)


def test_random_tokens_are_found_and_words_are_not(docs_of):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(40)) + "7x" for _ in range(30)]
    words = ["internationalisation2024internationalisation" * 2, "zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz11111111"]
    rows = [(i, f"see {k} there") for i, k in enumerate(keys)] + [(100 + i, w) for i, w in enumerate(words)]
    got = {r.doc_id: r.spans for r in secrets.digest(secrets.find_secrets(docs_of(rows))).collect()}
    assert sum("random:4:46" in got[i] for i in range(30)) >= 27
    assert got[100] == got[101] == ""


def test_contexts_of_seeds_find_unseen_identifiers(docs_of):
    rows = [(i, f"reach me under mailbox p{i}@mail.example or so") for i in range(20)]
    rows += [(50, "reach me under mailbox 99881-77665 or so"), (51, "the number 99881-77666 is no address")]
    got = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(docs_of(rows))).collect()}
    assert "likely:23:34" in got[50]
    assert got[51] == ""


UNSEEN = ["alice@intranet", "bob.smith@host7", "fe80::1:2ab", "00:1b:44:11:3a:b7", "(030) 555-019", "4711", "josé@büro"]


def test_unseen_identifiers_of_any_shape_are_found(docs_of):
    word = "w" * 60
    rows = [(i, f"reach me under {word} p{i}@mail.example or so") for i in range(40)]
    rows += [(100 + i, f"reach me under {word} {u} or so") for i, u in enumerate(UNSEEN)]
    rows += [(200, f"under {word} nothing or so"), (201, "he took 00:1b:44:11:3a:b7 there")]
    got = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(docs_of(rows))).collect()}
    assert [got[100 + i] for i in range(len(UNSEEN))] == [f"likely:76:{76 + len(u)}" for u in UNSEEN]
    assert got[200] == got[201] == ""


def test_ordinary_words_count_in_a_context(docs_of):
    rows = [(i, f"they met p{i}@mail.example") for i in range(20)] + [(50, "they met 99881-77665")]
    words = [a + b for a in "bcdfghjk" for b in ["ar", "el", "in", "ot"]]
    for others, want in ((words[:2], "likely:9:20"), (words, "")):
        docs = docs_of(rows + [(100 + i, f"they met {w}.") for i, w in enumerate(others)])
        got = {r.doc_id: r.spans for r in pii.digest(pii.find_personal_data(docs)).collect()}
        assert got[50] == want


def test_spans_apart_from_others(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        ends = sorted(rng.sample(range(60), 2 * rng.randrange(8)))
        own = list(zip(ends[::2], ends[1::2]))
        others = [(a, a + rng.randrange(0, 9)) for a in (rng.randrange(60) for _ in range(rng.randrange(6)))]
        rows.append((i, own, others))
    kind = "array<struct<start:bigint,end:bigint>>"
    df = spark.createDataFrame(rows, f"i int, own {kind}, others {kind}")
    got = {r.i: [tuple(s) for s in r.own] for r in spans.apart(df, "own", F.col("others")).collect()}
    for i, own, others in rows:
        assert got[i] == [s for s in own if not any(a < s[1] and s[0] < b for a, b in others)]


@pytest.mark.parametrize("find, part", [(secrets.find_secrets, "a 0123456789abcdef01234567 b "), (pii.find_personal_data, "a 1.2.3.4 b ")])
def test_time_follows_the_length_of_a_text(docs_of, find, part):
    """Two megabytes of matches in one text."""
    seconds, n = [], 2_000_000 // len(part)
    for times in (100, n // 2, n):
        began = time.perf_counter()
        (row,) = find(docs_of([(1, part * times)])).select(F.size("base").alias("n"), F.element_at("base", -1)["end"].alias("end")).collect()
        seconds.append(time.perf_counter() - began)
        assert (row.n, row.end) == (times, len(part) * times - 3)
    assert seconds[2] < 20 + seconds[0] and seconds[2] - seconds[0] < 4 * max(seconds[1] - seconds[0], 1)


def test_spans_of_nothing(docs_of):
    assert secrets.digest(secrets.find_secrets(docs_of([]))).count() == 0
    assert pii.digest(pii.find_personal_data(docs_of([]))).count() == 0
