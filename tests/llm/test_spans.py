"""Places of matches and masked texts against plain Python, long texts included."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import privacy, secrets, spans

TEXTS = ["", "no digits", "1", "12", "é12😀3 4", "7 " * 700, "x" * 5000 + "9" + "y" * 3000, "😀1" * 1500]


def test_matches_are_where_python_finds_them(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "i int, text string")
    rows = df.orderBy("i").select(spans.matches(F.col("text"), "[0-9]+").alias("m")).collect()
    for text, row in zip(TEXTS, rows, strict=False):
        assert [tuple(x) for x in row.m] == [(m.start(), m.end(), m.group()) for m in re.finditer("[0-9]+", text)]
    assert not rows[-1].m


def masked(text, found):
    out, at = [], 0
    for start, end in found:
        if start >= at:
            out += [text[at:start], "#"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_masked_texts(spark):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        text = "".join(rng.choice("aé😀 \n") for _ in range(rng.choice([0, 5, 1023, 1024, 1025, 3000])))
        found = sorted(
            (s, min(s + rng.choice([1, 2, 40, 1200]), len(text))) for s in (rng.randrange(len(text)) for _ in range(rng.choice([0, 1, 7, 90])))
        ) if text else []
        rows.append((i, text, [{"start": s, "end": e} for s, e in found]))
    df = spark.createDataFrame(rows, "i int, text string, found array<struct<start:int,end:int>>")
    got = df.orderBy("i").select(spans.replaced(F.col("text"), F.col("found"), lambda x: F.lit("#"))).collect()
    for (_, text, found), r in zip(rows, got, strict=True):
        assert r[0] == masked(text, [(x["start"], x["end"]) for x in found])


@pytest.mark.parametrize("report", [privacy.reported, secrets.reported])
def test_a_text_with_very_many_matches(spark, report):
    """Thousands of addresses and hex runs in one text."""
    text = "a@b.cc deadbeefdeadbeef 1.2.3.4 " * 5_000
    df = spark.createDataFrame([(1, text), (2, "x@y.zz token=abcdefghijklmnop")], "doc_id long, text string")
    started = time.time()
    found = {r.doc_id: r for r in report(df).collect()}
    assert time.time() - started < 120
    first = found[1]
    if report is privacy.reported:
        assert (first.n_email, first.n_ip) == (5_000, 5_000)
    else:
        assert first.n_hex == 5_000
