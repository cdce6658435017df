"""Secrets in candidates of a megabyte, and the allow-list's paths, against plain Python."""

import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import secrets

MEGA = 1 << 20
B64 = string.ascii_letters + string.digits + "+/"


def texts():
    rng = random.Random(4)
    return {
        "path segments": "a/" * (MEGA // 2) + "b1",
        "url": "https://host/" + "abcd/" * (MEGA // 5),
        "words": "word_" * (MEGA // 5) + "1234",
        "base 64": "".join(rng.choices(B64, k=MEGA)) + "a1",
        "hex": "".join(rng.choices("0123456789abcdef", k=MEGA)),
        "digits": "1" * MEGA + "a",
        "assigned": "password = " + "Ab1" * (MEGA // 3),
        "access": "AKIA" + "Q" * MEGA,
        "keys": "password" * (MEGA // 8),
        "blanks": "token" + " " * MEGA,
    }


@pytest.fixture(scope="module")
def found(spark):
    rows = list(texts().items())
    df = spark.createDataFrame(rows, "name string, text string").repartition(len(rows))
    spans = df.select("name", secrets.secret_spans(F.col("text")).alias("s")).collect()
    return {r["name"]: [(s["kind"], s["start"], s["end"]) for s in r["s"]] for r in spans}


def test_paths_and_words_are_no_secrets(found):
    assert found["url"] == found["words"] == found["keys"] == found["blanks"] == []
    assert found["path segments"] == []


def test_long_secrets_are_whole(found):
    n = MEGA
    assert found["assigned"] == [("assign", 0, len("password = ") + n // 3 * 3)]
    assert ("hex", 0, n) in found["hex"]
    assert found["access"] == [("access", 0, 4 + n)]
    assert found["digits"][0] == ("hex", 0, n + 1)
    (kind, start, end), = found["base 64"]
    assert kind == "entropy_base64" and start < 100 and end > n - 100


def test_the_pipeline_stage_redacts_them(spark):
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts().values())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(10)
    clean = {r["doc_id"]: r for r in secrets.redact_secrets(df, length="n_chars").collect()}
    assert clean[1]["text"] == rows[1][1] and "[SECRET]" in clean[3]["text"] and clean[6]["text"] == "[SECRET]"
    assert all(r["n_chars"] == len(r["text"]) for r in clean.values())


WORDY = re.compile(r"/?[a-z]+(?:[_/=-]+[a-z]+)*(?:[_/=-]+[0-9]{1,4})*/?")


def test_words_and_paths_by_the_plain_pattern(spark):
    rng = random.Random(7)
    parts = ["a", "word", "B", "7", "1234", "12345", "/", "-", "_", "=", "//", "x9", "+"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(6000)]
    df = spark.createDataFrame([(r,) for r in set(rows)], "c string")
    got = df.select("c", secrets.in_words(F.col("c")).alias("is")).collect()
    assert {r["c"]: r["is"] for r in got} == {r["c"]: bool(WORDY.fullmatch(r["c"])) for r in got}
    assert sum(r["is"] for r in got) > 30


def windows(candidate, width, bits):
    """Starts of the first and last window of enough entropy, each counted anew."""
    hot = []
    for i in range(len(candidate) - width + 1):
        part = candidate[i : i + width]
        h = -sum(part.count(c) / width * math.log2(part.count(c) / width) for c in set(part))
        if h >= bits - 1e-12:
            hot.append(i)
    return (hot[0], hot[-1]) if hot else (-1, -1)


@pytest.mark.parametrize("width, bits, alphabet", [(20, 3.7, secrets.ALPHABET), (20, 2.9, "0123456789abcdef"), (5, 2.0, "ab1-"), (63, 4.5, B64)])
def test_windows_by_running_counts(spark, width, bits, alphabet):
    rng = random.Random(width)
    rows = ["".join(rng.choices(alphabet[: rng.randint(2, len(alphabet))], k=rng.randint(1, 200))) for _ in range(400)]
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    got = df.select("c", secrets.hot_windows(F.col("c"), width, bits).alias("w")).collect()
    assert {r["c"]: (r["w"]["first"], r["w"]["last"]) for r in got} == {r: windows(r, width, bits) for r in rows}
