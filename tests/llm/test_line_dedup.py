import hashlib
import random
from collections import defaultdict

from ridgeline.llm import line_dedup as D

SPACE = " \t\n\x0b\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACE).translate(LOWER)


def expected(rows):
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= 20:
                    holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        out.append((i if i is not None else -1, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def got(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_lines, r.n_dropped, r.kept_sha256) for r in D.digest(d).collect())


def made(seed):
    rnd = random.Random(seed)
    pool = [f"shared line number {k} of the pool {'é' * (k % 3)}" for k in range(12)] + ["short", "", "exactly twenty chars"]
    rows = []
    for i in rnd.sample(range(-500, 5000), 150):
        lines = [rnd.choice(pool) if rnd.random() < .4 else f"own line {i} {k} with enough characters" for k in range(rnd.randint(0, 9))]
        lines = [rnd.choice(["{}", "  {}\t", "\x0b{} "]).format(x.upper() if rnd.random() < .2 else x) for x in lines]
        rows.append((i, "\n".join(lines)))
    return rows


def test_matches_plain_version(spark):
    for seed in (1, 2):
        rows = made(seed)
        assert got(spark, rows) == expected(rows)


def test_edge_rows(spark):
    line = "the same line stands in many documents"
    long = "\n".join([line] + [f"another line, number {k}, of a long text" for k in range(3000)])
    rows = [(1, None), (2, ""), (3, line), (3, line), (4, f"{line}\n{line.upper()}"), (5, f" {line}\r\nx"), (6, long), (7, "\n\n"),
            (None, line), (None, line), (8, "Ünïcode line Ä with twenty"), (9, "ünïcode line ä with twenty")]
    assert got(spark, rows) == expected(rows)
    assert got(spark, []) == []
    same_id = [(1, line), (1, line), (1, "z" * 30 + "\n" + line), (2, line)]       # two documents only
    assert got(spark, same_id) == expected(same_id)


def test_rewrite_keeps_columns_and_empty_texts(spark):
    line = "the same line stands in many documents"
    d = spark.createDataFrame([(k, f"{line}\nown {k}", "x", 7, 1, 2) for k in range(4)] + [(9, None, "y", 0, 1, 2)],
                              "doc_id long, text string, pos string, n_chars long, h1 int, batch int")
    out = {r.doc_id: r for r in D.rewrite(d).collect()}
    assert D.rewrite(d).columns == d.columns and len(out) == 5
    assert out[3].text == f"{line}\nown 3" and out[0].text == "own 0" and out[0].n_chars == 5 and out[0].pos == "x"
    assert out[9].text is None


def test_runs_are_compacted(spark):
    runs = D.LineRuns(spark)
    for b in range(5):
        rows = [(100 - 10 * b - k, h, 0) for k in range(3) for h in (1, 2 + b)]
        runs.add(spark.createDataFrame(rows, "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    out = {r.h1: (r.n_docs, r.keeper) for r in runs.merged().collect()}
    assert out[1] == (15, 100) and out[2] == (3, 100) and out[6] == (3, 60)


def test_rewrite_keeps_columns_of_any_name(spark):
    line = "a line that is long enough to count"
    names = ["_id", "_hash", "_lines", "_kept", "_dropped", "doc", "lines", "kept", "dropped", "text_hash"]
    rows = [(i, f"{line}\nown {i}", *range(10)) for i in range(4)]
    d = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    out = D.rewrite(d)
    assert out.columns == d.columns
    got = {r.doc_id: tuple(r) for r in out.collect()}
    assert got[3][1] == f"{line}\nown 3" and got[0][1] == "own 0" and all(r[2:] == tuple(range(10)) for r in got.values())
