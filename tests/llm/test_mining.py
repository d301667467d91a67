"""Shared lines, phrases and periodic runs against brute force on small tables with odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import lines, periodic, phrases, queries, words

SCHEMA = "doc_id long, text string, lang string, line int, key string, shard long, runs int, first boolean, kept string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in found.orderBy("doc_id").limit(120).collect()]
    odd = [
        None, "", "  \n\t ", "one", "\n\n", "Same Line \n same line\nSAME LINE\x0b", "ÄRGER ärger, a b; a b a b",
        "a a a a a a", "a a a a a", "x y " * 5000, "a b c d e " * 300 + "end", "\t lone \x0c line\r\n",
        "long " * 20_000, "1 2 3 1 2 3 1 2 3 1 2 3 1 2 4 " + "p q " * 4 + "p", "z\x85z z\x85z",
    ]
    rows += [(1000 + i, t, None if i % 3 else "en") for i, t in enumerate(odd)]
    rows += [(2000 + i, f"Shared line\nown {i}\n shared LINE ", "de") for i in range(12)]
    rows += [(None, "Shared line\nwithout id", "de"), (None, "another\nshared line", "de")]
    rows += [(3000, "twice the same\nshared line", "fr")] * 2 + [(3001, "same id", "fr"), (3001, "shared line\nsame id", "fr")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(d, t, g, 0, "k", 1, 2, False, "x") for d, t, g in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lines_left(rows, least_docs, least_chars):
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    seen = Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")})
    out = Counter()
    for d, t, _ in rows:
        parts = (t or "").split("\n")
        stay = [x for x in parts if not key(x) or len(key(x)) < least_chars or seen[key(x)] < least_docs]
        out[d, len(parts), len(parts) - len(stay), "\n".join(stay)] += 1
    return out


@pytest.mark.parametrize(("least_docs", "least_chars"), [(10, 1), (2, 1), (2, 12), (1, 1)])
def test_shared_lines_go_everywhere(docs, rows, least_docs, least_chars):
    found = lines.deduplicated(docs, least_docs, least_chars).collect()
    assert Counter(tuple(r) for r in found) == lines_left(rows, least_docs, least_chars)


def test_a_line_that_fills_many_partitions(spark):
    """Range partitions cut the hot key; its edges are summed."""
    table = [(i, f"hot\nrare {i // 3}\n{'hot' if i % 2 else 'cool'}") for i in range(400)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    found = {r.doc_id: r.kept for r in lines.deduplicated(df, least_docs=4).collect()}
    assert found == {i: f"rare {i // 3}" for i in range(400)}
    entries = lines.entries(lines.identified(df), 1).repartitionByRange(40, *lines.KEY, *lines.PLACE)
    held = entries.withColumn("p", F.spark_partition_id()).groupBy("high", "low").agg(F.countDistinct("p").alias("n"))
    assert held.agg(F.max("n")).first()[0] > 5


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_first_occurrences_can_stay(spark, partitions):
    rng = random.Random(partitions)
    table = [(i, "\n".join(rng.choice(["a", "A ", "b", "c", f"u{i}"]) for _ in range(6))) for i in range(60)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    found = lines.identified(df)
    dealt = lines.entries(found, 1).repartitionByRange(partitions, *lines.KEY, *lines.PLACE)
    dealt = dealt.sortWithinPartitions(*lines.KEY, *lines.PLACE)
    assert lines.judged(dealt, 3, True).where("kind = 2").count() <= 2 * partitions
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r.kept for r in lines.deduplicated(df, 3, spare_first=True).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    seen = Counter(k for _, t in table for k in {x.strip().lower() for x in t.split("\n")})
    met, want = set(), {}
    for d, t in table:
        stay = []
        for x in t.split("\n"):
            k = x.strip().lower()
            if seen[k] < 3 or k not in met:
                stay.append(x)
            met.add(k)
        want[d] = "\n".join(stay)
    assert got == want


def test_lines_of_an_empty_table(empty):
    assert lines.deduplicated(empty).collect() == []


def mined(rows, least, longest, percent, top):
    counts, n = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for d in range(1, longest + 1):
                for i in range(len(w) - d + 1):
                    counts[lang or "und"][tuple(w[i : i + d])] += 1
    out = []
    for lang, f in counts.items():
        kept = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            longer = [
                q for q, b in f.items()
                if len(q) > len(p) and b >= least and 100 * b >= percent * a
                and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if not longer:
                cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], start=1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(
    ("least", "longest", "top", "shard"), [(10, 3, 2000, 1 << 20), (3, 3, 40, 700), (6, 4, 2000, 2500), (10, 2, None, 1 << 20)]
)
def test_phrases(docs, rows, least, longest, top, shard):
    few = [r for r in rows if r[0] is None or r[0] % 4 == 0 or r[0] >= 1000] if least < 10 else rows
    df = docs if least >= 10 else docs.where("doc_id IS NULL OR doc_id % 4 = 0 OR doc_id >= 1000")
    found = phrases.collocations(df, least, longest, 50, top, shard)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.collect()) == mined(few, least, longest, 50, top)


def test_phrases_of_an_empty_table(empty, spark):
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")).collect() == []


def test_scores_past_64_bits(spark):
    """The cut's products are decimals: 1000000 a a passes 64 bits from a = 4,000,000 on."""
    df = spark.createDataFrame([(5_000_000_000, 5_000_000_001, 5_000_000_003)], "a long, l1 long, r1 long")
    score = df.select(F.expr("(1000000 * CAST(a AS DECIMAL(19,0)) * a) div (CAST(l1 AS DECIMAL(19,0)) * r1)"))
    a, left, right = 5_000_000_000, 5_000_000_001, 5_000_000_003
    assert score.first()[0] == 1_000_000 * a * a // (left * right)


def runs_by_hand(w, least=6, times=4):
    out = []
    for q in range(1, len(w) // times + 1):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            begin = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            stretch = w[begin - q : i]
            smaller = any(
                all(stretch[j] == stretch[j - p] for j in range(p, len(stretch))) for p in range(1, q)
            )
            if len(stretch) >= max(least, times * q) and not smaller:
                out.append((begin - q, len(stretch), q))
    return sorted(out)


def test_runs_of_random_words():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(3):
            w = []
            while len(w) < rng.choice([5, 30, 90]):
                unit = [rng.randrange(3) for _ in range(rng.choice([1, 2, 3, 5, 8, 13]))]
                w += unit * rng.randrange(1, 7) + unit[: rng.randrange(len(unit))]
            texts.append(w)
        flat = np.array([x for w in texts for x in w], dtype=np.uint64)
        rows = np.cumsum([0] + [len(w) for w in texts])
        start, length, period = periodic.runs_of(words.mix(flat + np.uint64(1)), rows)
        got = list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
        assert got == [(s + rows[i], n, q) for i, w in enumerate(texts) for s, n, q in runs_by_hand(w)]


def test_a_long_text_of_one_word_is_cheap():
    size = 1_000_000
    start, length, period = periodic.runs_of(np.ones(size, np.uint64), np.array([0, size]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [size], [1])


def test_runs_and_collapsed_texts(docs, rows, empty):
    found = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.detected(docs).collect())
    want = Counter()
    for d, t, _ in rows:
        w = (t or "").encode().split()
        if len(w) > 3000:
            continue
        runs = runs_by_hand(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want[d, len(w), tuple(runs), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()] += 1
    assert not want - found and sum(found.values()) == len(rows)
    long = {k[0]: k[2:] for k in found if k[1] > 3000}
    assert long[1009] == (((0, 10000, 2),), "x y") and long[1012] == (((0, 20000, 1),), "long")
    assert periodic.detected(empty).collect() == []


def test_runs_query_over_the_whole_table(spark, sf_dir):
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = {r.doc_id: r for r in queries.op13_sparse_diagonal_runs(spark, sf_dir).collect()}
    assert found.keys() == table.keys()
    made = 0
    for d, text in table.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        place = queries.periodic_tail(d, len(w))
        if place is not None:
            w, made = [w[i] for i in place], made + 1
        if len(w) > 400:
            continue
        runs = runs_by_hand(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        r = found[d]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *(best or (None, None, None)))
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert made > 5


def test_registered_sql_agrees(spark, sf_dir):
    import compare

    con = compare.connect(sf_dir)
    for name, sql in queries.oracle_sql().items():
        assert compare.differences(queries.queries()[name](spark, sf_dir), con, sql) == []
