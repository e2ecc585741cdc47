import os
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cohortflow.llm import token_ids
from cohortflow.llm.pretokens import PretokenEncoder
from cohortflow.llm.queries import tokenizer_path
from cohortflow.llm.token_counts import count_tokens
from cohortflow.llm.token_ids import find, read_token_ids, write_token_ids

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BYTES, WORDS = (tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_chunks_encode_as_the_library_does(library, path):
    rnd = random.Random(3)
    alphabet = "ab Z9'sté  \n\t\r\x0b.,!#²½ªµßÀÿ×÷-_İ́日本\x00\x1c\x85\xa0'llreTdvm"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    texts += [" ", "  ", " a", "a ", "a  b", "\n a", "a\n b", "a \nb", "don't 's 't!!'s", "<|endoftext|> x", "a<|startoftext|>"]
    with open(path, encoding="utf-8") as file:
        encoder = PretokenEncoder(file.read(), 50, list, lambda parts: [i for p in parts for i in p])
    assert encoder.values(texts) == [ids_of(library[path], t) for t in texts]
    assert len(encoder._ready()[3]) <= 50


def brute_counts(tokenizer, rows, limit=512):
    out = []
    for r in rows:
        n = len(ids_of(tokenizer, r[1]))
        out.append((r[0], len((r[1] or "").encode()), n, n > limit))
    return sorted(out, key=str)


def test_counts_of_awkward_rows(awkward, awkward_rows, library):
    got = sorted((tuple(r) for r in count_tokens(awkward, BYTES, cache_entries=300).collect()), key=str)
    assert got == brute_counts(library[BYTES], awkward_rows)


def test_counts_of_the_sample_and_of_nothing(sample, sample_rows, nothing, library):
    got = sorted((tuple(r) for r in count_tokens(sample, BYTES, sample_rows=20, table_entries=50).collect()), key=str)
    assert got == brute_counts(library[BYTES], [(r.doc_id, r.text) for r in sample_rows])
    assert count_tokens(nothing, BYTES).collect() == []


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("shards", [None, 4])
def test_shards_of_the_sample(sample, sample_rows, library, shards):
    got = {r.doc_id: r for r in read_token_ids(write_token_ids(sample, WORDS, shards=shards)).collect()}
    start = 0
    for r in sorted(sample_rows, key=lambda r: r.doc_id):
        ids = [*ids_of(library[WORDS], r.text), 1]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(got) == len(sample_rows)


def test_shards_of_awkward_rows(awkward, awkward_rows, library):
    manifest = write_token_ids(awkward, WORDS, shards=3)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in read_token_ids(manifest).collect()), key=str)
    encoded = [(r[0], [*ids_of(library[WORDS], r[1]), 1]) for r in awkward_rows]
    assert got == sorted(((i, len(ids), crc(ids)) for i, ids in encoded), key=str)
    spans = sorted((r.start, r.n_tokens) for r in read_token_ids(manifest).collect())
    assert [s for s, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
    # Keyed access, repeated and missing keys included.
    rows = manifest.collect()
    for doc_id in {i for i, _ in encoded}:
        wanted = sorted(ids for i, ids in encoded if i == doc_id)
        assert sorted(find(rows, doc_id, copy).tolist() for copy in range(len(wanted))) == wanted
        assert find(rows, doc_id, len(wanted)) is None
    assert find(rows, 10**9) is None and find(rows, -(10**9)) is None


def test_no_documents_no_shards(nothing):
    manifest = write_token_ids(nothing, WORDS)
    assert manifest.count() == 0 and read_token_ids(manifest).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 7, 3000])
def test_the_index_is_minimal_and_perfect(n):
    documents = np.zeros(n, dtype=token_ids.DOCUMENT)
    documents["doc_id"] = np.arange(n) * 11 - 5
    keys = token_ids.key_hashes(documents)
    seeds, slots = token_ids.build_index(keys)
    assert sorted(slots.tolist()) == list(range(n))
    if n:
        assert (token_ids.slots_of(keys, seeds, n) == slots).all()


def test_a_wide_vocabulary_gets_wide_ids():
    with open(WORDS, encoding="utf-8") as file:
        spec = file.read()
    assert token_ids.id_width(spec, 1) == 2 and token_ids.id_width(spec, 70_000) == 4


def test_equal_ids_have_one_order_on_every_run(spark):
    rows = [(5, f"text number {k} of five") for k in range(40)] + [(4, "four"), (None, "b"), (None, "a"), (6, "six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = tokenizer_path("word_bpe_49k.json")
    runs = [sorted(map(tuple, read_token_ids(write_token_ids(docs.repartition(n), path)).drop("shard").collect()), key=str) for n in (2, 7)]
    assert runs[0] == runs[1]


def test_small_shards_hold_the_same_and_are_found_across_files(spark, library):
    rows = [(None, f"none {k}") for k in range(30)] + [(5, f"text number {k} of five") for k in range(40)]
    rows += [(k, f"document {k}") for k in range(6, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        manifest = write_token_ids(docs, WORDS, shards=2, shard_documents=10, shard_bytes=200)
        got = read_token_ids(manifest).collect()
        whole = read_token_ids(write_token_ids(docs, WORDS, shards=2)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = manifest.collect()
    assert len(files) > 8 and all(r.documents <= 16 for r in files)
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((tuple(r)[:5] for r in whole), key=str)
    for doc_id, copies in ((None, 30), (5, 40), (33, 1)):
        wanted = sorted([*ids_of(library[WORDS], t), 1] for i, t in rows if i == doc_id)
        assert sorted(find(files, doc_id, copy).tolist() for copy in range(copies)) == wanted
        assert find(files, doc_id, copies) is None


def test_reading_needs_no_join(spark, sample):
    plan = read_token_ids(write_token_ids(sample, WORDS))._jdf.queryExecution().toString()
    assert "Join" not in plan
