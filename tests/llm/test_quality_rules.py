from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ridgeline.llm import quality_rules as Q

COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def plain(text):
    w = [x.decode() for x in (text or "").encode().split()]
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(win)
    covered = {j for i, g in enumerate(win) if n[g] > 1 for j in range(i, i + 5)}
    counts = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    return counts + (len(w) < 10 or 100 * len(covered) > 20 * len(w),)


def check(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in Q.apply_rules(d).collect()}
    for i, t in enumerate(texts):
        assert tuple(out[i][c] for c in COLUMNS) == plain(t), t
        assert out[i].kept == (not out[i].base_failed and not out[i].failed)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "b", "The", "é!", "#*", "|", "\n", " ", "\t", "\x0b", "x y", "\u00a0", "A\nA\n"]),
                         max_size=40), min_size=1, max_size=12))
def test_counts_against_plain_version(spark, pieces):
    check(spark, ["".join(p) for p in pieces] + [" ".join(p) for p in pieces])


def test_edge_rows(spark):
    long = " ".join(f"w{i % 700}" for i in range(20000))
    out = check(spark, [None, "", " \n ", "a " * 9, "a b c d e " * 2, "aa bb cc dd ee ff gg hh ii jj", long, "\n" * 5000, "x" * 100000])
    assert not out[0].kept and not out[1].kept and out[5].kept
    d = spark.createDataFrame([], "doc_id long, text string")
    assert Q.apply_rules(d).collect() == []
    d = spark.createDataFrame([(None, "a b", 1, 2), (3, "a", 1, 2), (3, "a", 1, 2)], "doc_id long, text string, n_words long, kept long")
    assert len(Q.apply_rules(d).collect()) == 3


def test_every_rule_can_fail(spark):
    prose = "the cat sat on a mat and the dog ran to it with some care "
    texts = {"symbols_per_word": "word* " * 0 + " ".join(f"tok{i}*" for i in range(60)) + " the of and to", "upper_share": " ".join(f"LOUD{i}X" for i in range(40)),
             "exclaimed_share": " ".join(f"wow{i}! the" for i in range(40)), "dup_line_share": "the one of a\n" * 0 + "\n".join(["the one"] * 9 + [prose]),
             "stop_word_share": " ".join(f"zebra{i}" for i in range(60)), "mean_word_chars": " ".join(f"{'long' * 6}{i}" for i in range(40)) + " the"}
    d = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    failed = {r.doc_id: r.failed for r in Q.apply_rules(d).collect()}
    for name in texts:
        assert name in failed[name], (name, failed[name])
    clean = spark.createDataFrame([("c", prose * 1 + "while another line of plain text follows here")], "doc_id string, text string")
    assert Q.apply_rules(clean).first().failed == []


def test_no_python_in_the_plan(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = Q.apply_rules(d)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
