import re
from collections import Counter, defaultdict

import pytest
from llm.cases import DOCS
from pyspark.sql import functions as F

from cohortflow.llm.columns import permuted
from cohortflow.llm.source_mixing import mix_sources, words_taken

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(rows):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(2 * size[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * size[s]}
        if not over:
            break
        capped |= over
    return size, {s: 2.0 * size[s] if s in capped else weight[s] * level for s in order}


def check(docs, rows, slack, **more):
    mix, blocks = mix_sources(docs, **more)
    got = words_taken(mix, blocks).collect()
    size, target = targets(rows)
    own = Counter((r[0], len(WORD.findall(r[1] or "")), size[r[3]]) for r in rows)
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == own
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r.source_size, round(r.target, 6)] += r.taken
    wanted = defaultdict(float)
    for s in size:
        wanted[size[s], round(target[s], 6)] += target[s]
    assert taken.keys() == wanted.keys()
    assert all(abs(taken[k] - wanted[k]) <= slack for k in wanted)
    return mix, blocks, got


def test_awkward_rows(awkward, awkward_rows):
    check(awkward, awkward_rows, slack=128)


def test_the_sample_comes_near_its_targets_and_reruns_agree(sample, sample_rows):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in sample_rows]
    _, _, got = check(sample, rows, slack=32, block_words=32, rows_per_bucket=16)
    again = words_taken(*mix_sources(sample.repartition(7), block_words=32, rows_per_bucket=16)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_slots_shards_and_blocks(sample):
    mix, blocks = mix_sources(sample, block_words=32, shard_slots=100)
    slots = mix.collect()
    assert sorted((r.shard, r.slot) for r in slots) == [(i // 100, i % 100) for i in range(len(slots))]
    times = Counter((r.number, r.block) for r in slots)
    last = {}
    for r in blocks.where("block is not null").collect():
        last[r.number] = max(last.get(r.number, 0), r.block)
    for number, most in last.items():
        per_block = [times[number, b] for b in range(most + 1)]
        assert max(per_block) - min(per_block) <= 1 and max(per_block) <= 2
    assert all(b <= last[n] for n, b in times)
    # Sources are spread over the shards.
    shards = defaultdict(set)
    for r in slots:
        shards[r.number].add(r.shard)
    heavy = max(times, key=lambda k: sum(v for q, v in times.items() if q[0] == k[0]))[0]
    assert len(shards[heavy]) > len(slots) // 100 * 0.6


def test_nothing_and_no_words(spark, nothing):
    assert words_taken(*mix_sources(nothing)).collect() == []
    empty = spark.createDataFrame([(1, None, "en", "a", None), (2, " ", "en", None, 1)], DOCS)
    got = sorted(map(tuple, words_taken(*mix_sources(empty)).select("doc_id", "size", "target", "taken").collect()))
    assert got == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000])
def test_permutations(spark, n):
    df = spark.range(n).select(F.col("id").alias("i"), F.lit(n).cast("bigint").alias("n"))
    got = [r[0] for r in df.select(permuted("i", "n", "3")).collect()]
    assert sorted(got) == list(range(n))
    if n == 1000:
        other = [r[0] for r in df.select(permuted("i", "n", "4")).collect()]
        assert got != other and sum(a + 1 == b for a, b in zip(got, got[1:])) < 20


def test_the_plan_is_native(sample):
    plan = words_taken(*mix_sources(sample))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)
