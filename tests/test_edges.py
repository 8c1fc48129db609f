"""Nulls, single classes, ragged files and values off a given list."""

import math

import numpy as np
import pytest

from ridgeline.operators import evaluate, moments, profile
from ridgeline.sources import io


def write(tmp_path, text):
    f = tmp_path / "t.csv"
    f.write_text(text)
    return str(f)


@pytest.mark.parametrize("text, sep, want", [
    ("c,b,a\n3,2,1\n", ",", [(1.0, 2.0, 3.0)]),                                   # names, not places
    ("# note\n\n\ta , b,c # names\n1,2\n\t\n\t# x\n4,5,6,7\n", ",", [(1.0, 2.0, None), (4.0, 5.0, 6.0)]),
    ("a|b|c\n12|34|5\n", "|", [(12.0, 34.0, 5.0)]),                              # a literal separator
    ('a,b,c\n"1","2, x",3\n', ",", [(1.0, None, 3.0)]),                          # quotes
    ("a,b,c\na , b,c\n1,2,n/a\n", ",", [(1.0, 2.0, None)]),                      # a repeated header
    ("", ",", []),
])
def test_comment_csv(spark, tmp_path, text, sep, want):
    got = io.scan_comment_csv(spark, write(tmp_path, text), ["a", "b", "c"], sep=sep)
    assert [tuple(r) for r in got.collect()] == want


def test_comment_csv_without_a_wanted_column(spark, tmp_path):
    with pytest.raises(ValueError):
        io.scan_comment_csv(spark, write(tmp_path, "a,b\n1,2\n"), ["a", "z"])


def test_matrix_keeps_values_off_the_list(spark):
    cells = spark.createDataFrame([("r", "x", 2), ("r", "new", 3), ("r", None, 4)], "r string, c string, n long")
    wide = io.matrix_wide(cells, "r", "c", "n", ["x", "y"])
    assert wide.first().asDict() == {"r": "r", "x": 2, "y": 0, io.OTHER: 7}


def test_confusion_counts_every_row(spark):
    df = spark.createDataFrame([(0, 0), (1, 7), (9, 1), (None, 1), (1, None)], "y int, p int")
    cm = evaluate.confusion(df, "y", "p", classes=[0, 1])
    got = {(r.label, r.prediction): r.n for r in cm.collect()}
    assert sum(got.values()) == 5 and got[1, 7] == 1 and got[9, 1] == 1 and got[None, 1] == 1 and got[0, 1] == 0
    assert len(got) == 16 + 2
    report = {r["class"]: r.support for r in evaluate.class_report(cm.where("label is not null and prediction is not null")).collect()}
    assert report["accuracy"] == 3


def test_box_stats_leave_nulls_out(spark):
    rows = [("a", float(x)) for x in (1, 2, 3, 4, 100)] + [("a", None), ("a", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    r = profile.box_stats(df, "g", "x").first()
    assert (r.n, r.n_outliers, r.median) == (5, 1, 3.0)
    assert [x.x for x in profile.box_outliers(df, "g", "x").collect()] == [100.0]


def test_qq_points_leave_nulls_out(spark):
    df = spark.createDataFrame([(0, None), (1, 3.0), (2, None), (3, 1.0), (4, 2.0)], "id long, r double")
    got = sorted((r.i, r.osr) for r in evaluate.qq_points(df, "r", ["id"]).collect())
    assert got == [(1, 1.0), (2, 2.0), (3, 3.0)]


@pytest.mark.parametrize("label", [0, 1])
def test_roc_and_auc_of_one_class(spark, label):
    df = spark.createDataFrame([(label, .1), (label, .7), (None, .3), (label, None)], "y int, s double")
    pts = evaluate.roc_points(df, "y", "s").collect()
    assert all((r.tpr if label == 0 else r.fpr) is None for r in pts if r.point > 0)
    assert evaluate.auc(df, "y", "s").first().auc is None


def test_moments_use_complete_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2))
    y = x @ [2.0, -1.0] + rng.normal(size=200)
    rows = [(float(a), float(b) if i % 7 else None, float(c)) for i, ((a, b), c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    m = moments.moments(df, ["a", "b", "y"])
    whole = np.array([r for r in rows if r[1] is not None])
    assert m.n == len(whole)
    assert np.allclose(m.mean, whole.mean(axis=0)) and np.allclose(m.cov, np.cov(whole.T, bias=True))


def direct_density(x, at):
    h = x.std(ddof=1) * len(x) ** -0.2
    return np.exp(-0.5 * ((at[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))


def test_density_against_the_direct_formula(spark):
    x = np.random.default_rng(1).standard_t(2, size=3000)        # heavy tails
    df = spark.createDataFrame([(float(v), "a") for v in x] + [(5.0, "constant")] * 3 + [(None, "a")], "x double, c string")
    rows = sorted(profile.kde_by_class(df, "x", "c").collect(), key=lambda r: r.g)
    assert {r.label for r in rows} == {"a"} and len(rows) == 200
    h = x.std(ddof=1) * len(x) ** -0.2
    assert rows[0].x == pytest.approx(x.min() - 3 * h) and rows[-1].x == pytest.approx(x.max() + 3 * h)
    want = direct_density(x, np.array([r.x for r in rows])) * 3000 / 3003
    assert np.abs(np.array([r.density for r in rows]) - want).max() < 1e-3 * want.max()


def test_automatic_bins(spark):
    x = np.random.default_rng(2).normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert profile.auto_bins(df, "x") == len(np.histogram_bin_edges(x, "auto")) - 1
    assert profile.auto_bins(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x") == 1


def test_null_rows_do_not_change_ridge(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 1))
    rows = [(float(a), float(2 * a + e)) for (a,), e in zip(x, rng.normal(size=120))]
    full = spark.createDataFrame(rows, "a double, y double")
    holes = full.unionByName(spark.createDataFrame([(None, 50.0), (9.0, None)], "a double, y double"))
    a, b = (moments.moments(d, ["a", "y"]) for d in (full, holes))
    assert np.allclose(a.cov, b.cov) and a.n == b.n


def test_wide_moments_match_the_expression_path(spark):
    x = np.random.default_rng(4).normal(size=(300, 6)) * [1, 10, 0, 3, 1e3, 1] + 5
    df = spark.createDataFrame([([float(v) for v in r],) for r in x] + [(None,), ([None] * 6,)], "v array<double>")
    wide = moments.vector_moments(df, "v")
    cols = df.where("v is not null").select(*[df.v[i].alias(f"c{i}") for i in range(6)])
    plain = moments.moments(cols, [f"c{i}" for i in range(6)])
    assert wide.n == plain.n == 300 and np.allclose(wide.mean, plain.mean) and np.allclose(wide.cov, plain.cov)
    r = {(c.a, c.b): c.r for c in profile.vector_correlation(df, "v").collect()}
    assert r[2, 3] is None and r[2, 2] == 1.0 and abs(r[0, 1] - np.corrcoef(x[:, 0], x[:, 1])[0, 1]) < 1e-9


def test_only_the_first_file_is_opened_for_the_header(spark, tmp_path, monkeypatch):
    (tmp_path / "many").mkdir()
    for k in range(30):
        head = {0: " # nothing here\n\n", 1: "# c\n b, a # names\n"}.get(k, "")
        (tmp_path / "many" / f"part-{k:05d}.txt").write_text(head + (f"{k}, {k * 2}\n" if k else ""))
    opened, real = [], io._head_of
    monkeypatch.setattr(io, "_head_of", lambda s, f: opened.append(f) or real(s, f))
    got = io.scan_comment_csv(spark, str(tmp_path / "many"), ["a", "b"])
    assert sorted((r.a, r.b) for r in got.collect()) == [(2.0 * k, float(k)) for k in range(1, 30)]
    assert [f.rsplit("/", 1)[1] for f in opened] == ["part-00000.txt", "part-00001.txt"]     # the first has no line
