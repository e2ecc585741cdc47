import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortflow.llm import language_id, words
from cohortflow.llm.language_id import build_trees, identify

TRAIN = [("aa", "abracadabra abra"), ("aa", "banana band"), ("bb", "xyzzy zyx xyz"), ("bb", "abc xyz")]


def trees_of(pairs, **more):
    counts = Counter()
    for batch in language_id._count([pa.RecordBatch.from_pydict({"lang": [p[0] for p in pairs], "text": [p[1] for p in pairs]})]):
        for lang, gram, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            counts[lang, gram] += n
    return build_trees([(lang, gram, n) for (lang, gram), n in counts.items()], **more)


def brute_bits(pairs, lang, text):
    """Code length by the definition: dictionaries of contexts, escapes and exclusion."""
    known = defaultdict(Counter)
    for label, t in pairs:
        if label == lang:
            data = b"\0\0\0" + t.encode().lower()
            for i in range(3, len(data)):
                for order in range(4):
                    known[data[i - order : i]][data[i]] += 1

    def chance(context, byte):
        if context is None:
            return 1 / 256
        seen = known.get(context)
        shorter = context[1:] if context else None
        if not seen:
            return chance(shorter, byte)
        n, d = sum(seen.values()), len(seen)
        if byte in seen:
            return seen[byte] / (n + d)
        return d / (n + d) * chance(shorter, byte) / (1 - sum(chance(shorter, b) for b in seen))

    data = b"\0\0\0" + text.encode().lower()
    return sum(-math.log2(chance(data[i - 3 : i], data[i])) for i in range(3, len(data)))


def test_code_lengths_are_exact():
    trees = trees_of(TRAIN)
    texts = ["abracadabra", "xyz banana", "Zebra", "", "q\x01é\x00", "abc"]
    data, offsets = words.text_bytes(pa.array(texts))
    got = trees.code_lengths(data, offsets)
    want = [[brute_bits(TRAIN, lang, t) for lang in ("aa", "bb")] for t in texts]
    assert trees.langs == ["aa", "bb"]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-3)


def test_windows_and_fewer_contexts(monkeypatch):
    trees = trees_of(TRAIN)
    data, offsets = words.text_bytes(pa.array(["abc " * 50, "", "xyz" * 30, None, "a"]))
    whole = trees.code_lengths(data, offsets)
    monkeypatch.setattr(language_id, "STEP", 7)
    assert np.allclose(trees.code_lengths(data, offsets), whole)
    small = trees_of(TRAIN, cells=200).code_lengths(data, offsets)
    assert np.isfinite(small).all() and len(trees_of(TRAIN, cells=200).bits) < len(trees.bits)


def test_building_holds_little_more_than_the_tables():
    rng = np.random.default_rng(1)
    grams = np.unique(rng.integers(97, 137, (40_000, 4), dtype=np.int64) @ (1 << np.array([24, 16, 8, 0])))
    counts = [(lang, int(gram), 1 + int(gram) % 3) for lang in ("aa", "bb", "cc") for gram in grams]
    tracemalloc.start()
    trees = build_trees(counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert trees.bits.nbytes > 10e6 and peak < 3 * trees.bits.nbytes
    table = pa.table(dict(zip(("lang", "gram", "n"), map(list, zip(*counts)))))
    assert (build_trees(table).bits == trees.bits).all()


def test_held_out_accuracy(sample, sample_rows):
    got = {r.doc_id: r for r in identify(sample).collect()}
    right = []
    for r in sample_rows:
        held = zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert got[r.doc_id].held_out == held and 0 <= got[r.doc_id].score <= 1
        if held:
            right.append(got[r.doc_id].lang_pred == r.lang)
    assert sum(right) >= 0.95 * len(right)


def test_labels_of_held_out_rows_are_not_used(spark, sample):
    from pyspark.sql import functions as F

    held = language_id.bucket(F.col("doc_id"), 4) == 2
    blind = sample.withColumn("lang", F.when(~held, F.col("lang")).otherwise("zz")).withColumn("source", F.lit("x"))
    want = {r.doc_id: (r.lang_pred, r.score) for r in identify(sample).collect()}
    assert {r.doc_id: (r.lang_pred, r.score) for r in identify(blind).collect()} == want


@pytest.mark.parametrize("carry", [False, True])
def test_awkward_rows(awkward, awkward_rows, carry):
    got = identify(awkward, carry=carry).collect()
    assert len(got) == len(awkward_rows)
    lettered = lambda t: any(ch.isalpha() for ch in t or "")
    assert sum(r.lang_pred == "und" for r in got) == sum(not lettered(r[1]) for r in awkward_rows)
    assert all((r.score == 0) == (r.lang_pred == "und") for r in got)
    if carry:
        assert sorted(got[0].row.asDict()) == sorted(awkward.columns)
        assert sorted(str(r.row.text) for r in got) == sorted(str(r[1]) for r in awkward_rows)


def test_nothing_learned(nothing, spark):
    assert identify(nothing).collect() == []
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in identify(unlabelled).collect()] == [("und", 0.0)]
