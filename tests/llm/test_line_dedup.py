import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from cohortflow.llm.line_dedup import LineRuns, drop_repeated_lines, hashed_lines, line_digests

ENDS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(ENDS).translate(LOWER)


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def plain(rows, least=10):
    """(doc_id, n_lines, n_dropped, sha256) of every row, line by line."""
    first = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            k = key(line)
            if len(k) >= least and (k not in first or order(doc_id) < order(first[k])):
                first[k] = doc_id
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or order(first[key(x)]) == order(doc_id)]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def got(docs, **more):
    return Counter(map(tuple, line_digests(drop_repeated_lines(docs, **more)).collect()))


def test_awkward_rows(awkward, awkward_rows):
    assert got(awkward) == plain(awkward_rows)


def test_lines_of_every_kind(spark):
    common = "A line that  everybody has"
    rows = [
        (5, f"{common}\nonly here, in five\n{common}"), (7, f"  {common.upper()} \t\nshort\nshort\n\n"),
        (9, f"short\n{common}\r\nÄRGER über Straßen\nlast"), (2, "ärger über Straßen\nÄrger über Straßen"),
        (8, "Ärger ÜBER Straßen"), (None, f"{common}\nnobody else has this one"), (None, "nobody else has this one\n"),
        (3, "123456789"), (4, "123456789"), (6, "1234567890"), (10, " 1234567890 "), (11, "tail\n"), (11, "other\n1234567890"),
        (12, None), (13, ""), (14, "\n\n"), (-1, "nobody else has this one, but -1"),
    ] + [(20 + k % 3, f"{common}\nrow {k} of the hot ids") for k in range(30)] + [(40, common)] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for batches, fanout in ((1, 2), (4, 2), (7, 3)):
        assert got(docs, batches=batches, fanout=fanout) == plain(rows)
    assert got(docs, least_chars=1) == plain(rows, least=1)


def test_the_sample_and_its_text(sample, sample_rows):
    kept = drop_repeated_lines(sample, batches=3).collect()
    texts = {r.doc_id: r.text for r in sample_rows}
    assert sum(r.n_dropped for r in kept) > 0
    for r in kept:
        lines, left = (texts[r.doc_id] or "").split("\n"), r.kept_text.split("\n")
        assert r.n_lines == len(lines) and r.n_dropped in (len(lines) - len(left), len(lines))
        rest = iter(lines)
        assert not r.kept_text or all(any(x == y for y in rest) for x in left)


def test_batches_in_any_order_and_levels(spark):
    """The earlier batch keeps a line; runs are compacted by level and share no hash."""
    texts = {k: "\n".join(f"line number {i} of all" for i in range(k, k + 4)) for k in range(9)}
    runs, seen, dropped = LineRuns(spark, fanout=2), set(), defaultdict(int)
    for k in (4, 0, 8, 2, 6, 1):
        batch = spark.createDataFrame([(k, texts[k])], "doc_id long, text string")
        dropped[k] = runs.add(hashed_lines(batch)).count()
        lines = set(texts[k].split("\n"))
        assert dropped[k] == len(lines & seen)
        seen |= lines
    assert [len(level) for level in runs.levels] == [2, 0, 1]
    stored = [tuple(r) for level in runs.levels for run in level for r in spark.table(run).select("h1", "h2").collect()]
    assert len(stored) == len(set(stored)) == len(seen)
    plan = spark.table(runs.levels[2][0]).join(spark.table(runs.levels[0][0]).hint("merge"), ["h1", "h2"], "left_anti")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    runs.close()


def test_empty_tables_and_clashing_columns(nothing, spark):
    assert drop_repeated_lines(nothing).columns == ["doc_id", "n_lines", "n_dropped", "kept_text"]
    assert drop_repeated_lines(nothing).count() == 0
    names = ["place", "h1", "h2", "text_hash", "batch", "lines", "places", "first", "stored"]
    rows = [(1, "the same line"), (2, "the same line")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(0).alias(n) for n in names])
    assert got(docs) == plain(rows)


def test_built_in_only(sample):
    plan = line_digests(drop_repeated_lines(sample))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
