from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import text as X


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x")).alias("r")).collect()]


def test_clean_text_keeps_hangul_and_latin_letters(spark):
    texts = ["한국 경제 3.5% 성장!", "  a1b c　d\n", "é", "", None]
    assert column(spark, texts, X.clean_text) == ["한국 경제 성장", "a b c d", "", "", None]


def test_strip_space_knows_unicode_space(spark):
    assert column(spark, [" 　 a b\t\n", "", None], X.strip_space) == ["a b", "", None]


def test_tokens_drop_single_letters_and_keep_repeats(spark):
    got = column(spark, ["The cat, a the CAT's x"], lambda c: X.letter_tokens(c, stopwords=["cat"]))
    assert got == [["the", "the"]]
    assert column(spark, ["Ab ab"], lambda c: X.letter_tokens(c, lowercase=False)) == [["Ab", "ab"]]


def test_keywords_break_ties_by_first_occurrence(spark):
    texts = ["bb aa cc aa bb dd", "", None]
    want = [["bb", "aa", "cc"], [], None]
    assert column(spark, texts, lambda c: X.keywords_of(c, 3)) == want
    assert column(spark, texts, lambda c: X.keywords_of(c, 3, tokenizer=X.letter_tokens)) == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab가나 .é", max_size=60), min_size=1, max_size=8))
def test_both_keyword_forms_equal_a_plain_count(spark, texts):
    def plain(text):
        words = [w for w in "".join(c if c in "ab가나" else " " for c in text.lower()).split() if len(w) > 1]
        return [w for w, _ in Counter(words).most_common(4)]

    want = [plain(t) for t in texts]
    assert column(spark, texts, lambda c: X.keywords_of(c, 4)) == want
    assert column(spark, texts, lambda c: X.keywords_of(c, 4, tokenizer=X.letter_tokens)) == want


def test_term_counts_give_count_and_first_position(spark):
    got = column(spark, ["bb aa bb"], lambda c: X.term_counts(X.letter_tokens(c)))[0]
    assert [(r.token, -r.neg_count, r.first_pos) for r in got] == [("aa", 1, 1), ("bb", 2, 0)]


def test_sentence_count(spark):
    texts = ["One. Two!", "No end", "  ", None, "A... B?! C", "3.5 is one. "]
    assert column(spark, texts, X.sentence_count) == [2, 1, 0, 0, 3, 1]


def test_chunks_cover_every_word_once(spark):
    words = [f"word{i}" for i in range(1100)]
    long_text, short = " ".join(words), "one two"
    one_chunk = " ".join(["x" * 50] * 100)
    got = column(spark, [long_text, short, one_chunk], X.chunks_of)
    assert [len(c.split()) for c in got[0]] == [512, 512, 76]
    assert " ".join(got[0]) == long_text
    assert got[1] == [short] and got[2] == [one_chunk]


def test_greedy_chunks_with_token_costs(spark):
    split = X.greedy_chunks(lambda words: [len(w) for w in words], budget=10)
    text = "aaaa bbbb cccc " + "d" * 25 + " eeee"
    assert column(spark, [text, "short"], split) == [["aaaa bbbb", "cccc", "d" * 25, "eeee"], ["short"]]


def test_compute_once_keeps_filters_above(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "x string, n int")
    once = X.compute_once(df, "k", F.md5(F.col("x"))).where("k <> 'z' and n = 1")
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    below = plan[plan.index("Generate") :]
    assert "(n#" in below and "k <> z" not in below
    assert [r.x for r in once.collect()] == ["a"]


def test_stopwords_come_from_a_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("그리고\n또는 \n\n그리고\n", encoding="utf-8")
    assert X.load_stopwords(spark, str(path)) == sorted(["그리고", "또는"])


@pytest.mark.parametrize("minimum, maximum", [(0, 4), (3, 4), (30, 150)])
def test_summary_takes_best_sentences_in_order(spark, minimum, maximum):
    from broadsheet.operators.enrich import extractive_summary

    sentences = ["aa bb cc dd", "kk kk", "kk xx yy", "zz zz"]
    df = spark.createDataFrame([(". ".join(sentences) + ".", ["kk"])], "t string, k array<string>")
    got = df.select(extractive_summary(F.col("t"), F.col("k"), min_words=minimum, max_words=maximum)).first()[0]

    def share(s):
        return s.split().count("kk") / len(s.split())

    used, taken = 0, []
    for i in sorted(range(4), key=lambda i: (-share(sentences[i]), i)):
        if used + len(sentences[i].split()) > maximum and used >= minimum:
            break
        used += len(sentences[i].split())
        taken.append(i)
    assert got == ". ".join(sentences[i] for i in sorted(taken))


def test_keywords_hold_few_texts_at_a_time(spark):
    """Arrow batches hold 10,000 texts; a worker must not keep that many."""
    df = spark.createDataFrame([("a b",)], "t string").select(X.keywords_of(F.col("t")).alias("k"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "Arrow" not in plan
