import random
import re

from llm.cases import SF_DIR
from pyspark.sql import functions as F

from cohortflow.llm.decontamination import MASKS, overlaps

ITEMS = "item_id long, text string"


def words(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def brute(docs, items, least=10):
    """Best stretch around any hit of a mask, by definition; without `least`, short items need half their words."""
    span, found = len(MASKS[0]), {}
    for doc_id, text in docs:
        w = words(text)
        for item_id, item in items:
            t = words(item)
            for mask in MASKS:
                for q in range(len(t) - span + 1):
                    for p in range(len(w) - span + 1):
                        if any(m == "1" and w[p + k] != t[q + k] for k, m in enumerate(mask)):
                            continue
                        score = best = 0
                        left = min(p, q)
                        right = min(len(w) - p, len(t) - q)
                        for k in range(-left, right):
                            score = max(0, score + (1 if w[p + k] == t[q + k] else -1))
                            best = max(best, score)
                        if best >= (min(10, len(t) // 2) if least is None else least):
                            found[doc_id, item_id] = max(best, found.get((doc_id, item_id), 0))
    return found


def result(docs, items, **more):
    return {(r.doc_id, r.item_id): r.score for r in overlaps(docs, items, **more).collect()}


def passage_docs():
    rnd = random.Random(8)
    item = [f"q{i}" for i in range(30)]
    text = lambda n: [f"w{rnd.randrange(3000)}" for _ in range(n)]
    swapped = [w if i not in (3, 14, 22) else "other" for i, w in enumerate(item)]
    docs = [
        (1, [*text(50), *item, *text(50)]), (2, [*text(20), *swapped, *text(5)]), (3, text(200)),
        (4, item[:9]), (5, item[:10]), (6, [*text(5), *item[10:22], *text(400)]), (7, item * 3),
        (8, [w if i % 4 else "gap" for i, w in enumerate(item)]), (9, [*text(30), *item[::-1]]),
    ]
    docs = [(i, " ".join(w)) for i, w in docs] + [(10, None), (11, ""), (12, " ".join(item).upper().replace(" ", ", "))]
    items = [(1, " ".join(item)), (2, None), (3, "too short"), (4, "x " * 40), (5, " ".join(item[5:25])), (None, " ".join(item))]
    return docs, items


def test_passages_with_substitutions(spark):
    docs, items = passage_docs()
    got = result(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, ITEMS))
    assert got == brute(docs, items)
    assert {d for d, _ in got} == {1, 2, 5, 6, 7, 8, 12}


def test_a_full_bit_table_changes_nothing(spark):
    docs, items = passage_docs()
    df, of = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    assert result(df, of, filter_bits=64) == result(df, of)


def test_awkward_rows(spark, awkward, awkward_rows):
    items = spark.createDataFrame([(1, awkward_rows[0][1]), (2, None)], ITEMS).withColumn("seed", F.lit(1))
    got = result(awkward, items)
    assert {d for d, _ in got} == {1, 2, 3, 15, -3, None}
    assert got == brute([(r[0], r[1]) for r in awkward_rows if r[0] != 9], [(1, awkward_rows[0][1])])


def test_nothing(spark, nothing):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l")], ITEMS)
    assert result(nothing, items) == {}
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "doc_id long, text string")
    assert result(docs, spark.createDataFrame([], ITEMS)) == {}


def test_the_sample_and_a_native_plan(spark, sample, sample_rows):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    few = [r for r in sample_rows if len(r.text) < 3000]
    got = result(sample, items)
    texts = {r.item_id: " ".join(words(r.text)) for r in items.collect()}
    whole = {(r.doc_id, i) for r in few for i, t in texts.items() if t in " ".join(words(r.text))}
    assert whole <= set(got) and whole
    plan = overlaps(sample, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_short_items(spark):
    sizes = [1, 2, 5, 8, 9, 10, 12, 14, 17, 19]
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in sizes}
    fill = [f"f{k}" for k in range(30)]
    docs = [(n, [*fill, *words_, *fill]) for n, words_ in items.items()]
    docs += [(100 + n, words_) for n, words_ in items.items()]
    # Every fourth word changed, at each phase.
    docs += [(1000 * (phase + 1) + n, [*fill, *["gap" if k % 4 == phase else w for k, w in enumerate(items[n])], *fill])
             for n in sizes if n >= 12 for phase in range(4)]
    # A word short of a short item, or with one in between, is none.
    docs += [(201, items[8][:7]), (202, [*items[5][:3], "gap", *items[5][3:]])]
    benchmark = [(n, " ".join(w)) for n, w in items.items()] + [(999, "..."), (998, "")]
    docs = [(i, " ".join(w)) for i, w in docs] + [(0, ""), (-1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id): r for r in overlaps(df, spark.createDataFrame(benchmark, ITEMS)).collect()}
    want = {(i, i % 100 if i < 1000 else i % 1000) for i, _ in docs if i > 0 and i not in (201, 202)}
    assert set(got) == want
    assert all(got[n, n].position == 30 and got[n, n].score == got[n, n].equal_words == n for n in sizes)


def planted():
    """Items of 1 to 400 words, copied whole, with every sixth word changed, and side by side."""
    rnd = random.Random(400)
    sizes = [1, 2, 5, 8, 9, 10, 12, 16, 17, 20, 40, 64, 73, 130, 300, 400]
    items = {n: [f"i{n}x{rnd.randrange(n)}" for _ in range(n)] for n in sizes}
    fill = lambda n: [f"f{rnd.randrange(50)}" for _ in range(n)]
    docs = [(n, [*fill(90), *w, *fill(90)]) for n, w in items.items()]
    docs += [(1000 + n, ["gap" if k % 6 == 2 else x for k, x in enumerate(w)]) for n, w in items.items()]
    docs += [(2000, [x for w in items.values() for x in w]), (2001, [*items[300][150:], *items[300][:150]]), (2002, fill(500))]
    return [(i, " ".join(w)) for i, w in docs] + [(0, ""), (-1, None)], [(n, " ".join(w)) for n, w in items.items()] + [(999, "...")]


def test_long_and_short_items_in_both_engines(spark):
    import duckdb
    import pandas as pd

    from cohortflow.llm.sql import SQL

    docs, items = planted()
    frames = pd.DataFrame(docs, columns=["doc_id", "text"]), pd.DataFrame(items, columns=["item_id", "text"])
    con = duckdb.connect()
    con.register("documents", frames[0])
    con.register("benchmark", frames[1])
    names = ["doc_id", "item_id", "score", "equal_words", "words", "position"]
    theirs = con.execute(f"select {', '.join(names)} from ({SQL['op8_decontamination']})").fetchall()
    mine = overlaps(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, ITEMS))
    mine = [tuple(r) for r in mine.select(*names).collect()]
    assert sorted(mine) == sorted(theirs)
    scores = {r[:2]: r[2] for r in mine}
    assert all(scores[n, n] == n and scores[2000, n] >= n for n, _ in items if n != 999)
    assert {(d, i): s for (d, i), s in scores.items() if i >= 9} == brute(docs, items, None)


def test_least_words(spark):
    docs, items = planted()
    df, of = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    every, some = result(df, of), result(df, of, least_words=5)
    assert some == {k: v for k, v in every.items() if k[1] >= 5} and len(some) < len(every)
