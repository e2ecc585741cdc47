import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortflow.llm import token_alignment as ta
from cohortflow.llm.pretokens import byte_characters

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    """text -> ([(id, bytes)] of A, the same of B), by the libraries alone."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte_of = {c: n for n, c in byte_characters().items()}

    def spelled(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def both(text):
        if not text:
            return [], []
        left = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, spelled(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        if any(b"".join(x for _, x in side) != whole for side in (left, right)):
            return [], []
        return left, right

    return both


def ends(side):
    out, at = [], 0
    for i, piece in side:
        at += len(piece)
        out.append((i, at))
    return out


def plain(rows, tokens):
    docs, counts = [], Counter()
    for doc_id, text, *_ in rows:
        a, b = (ends(side) for side in tokens(text))
        b_at = {at: i for i, at in b}
        links = [(i, b_at[at]) for i, at in a if at in b_at]
        cuts = sorted({at for _, at in a} & set(b_at))
        group = [defaultdict(list), defaultdict(list)]
        for inside, side in zip(group, (a, b)):
            for i, at in side:
                inside[bisect_left(cuts, at)].append(str(i))
        groups = ["|".join(",".join(inside[k]) for inside in group) for k in range(len(cuts))]
        counts.update(links)
        docs.append((doc_id, len(a), len(b), len(cuts), links, ";".join(groups)))
    highest = defaultdict(int)
    for (_, i), n in counts.items():
        highest[i] = max(highest[i], n)
    return Counter(
        (doc_id, n_a, n_b, n_groups, len(links), sum(counts[x] == highest[x[1]] for x in links),
         sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if text else "")
        for doc_id, n_a, n_b, n_groups, links, text in docs
    )


def got(docs):
    return Counter(map(tuple, ta.align_and_score(docs, A_PATH, B_PATH).collect()))


ODD = [
    "don't  stop\n\n\there  ", " leading", "trailing ", "▁ low line", "<s> </s> <unk> <0x41> <|endoftext|>", "\x00 nul", "\x7f\x85\xa0x",
    "Zürich 日本語 テキスト 🙂👩‍👩‍👧 ½ ﬁ Å é", "!!!!????....", "a" * 300, "\n" * 50, "﻿mark", "\u0009tab", "ß" * 40, "İı",
]


def test_awkward_rows(awkward, awkward_rows, tokens):
    assert got(awkward) == plain([r for r in awkward_rows], tokens)


def test_odd_texts(spark, tokens):
    rows = [(k, text) for k, text in enumerate(ODD)] + [(None, None), (1, ODD[0])]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain(rows, tokens)


def test_the_sample(sample, sample_rows, tokens):
    rows = [(r.doc_id, r.text) for r in sample_rows if r.text is None or len(r.text) < 20_000]
    assert got(sample.where("text is null or length(text) < 20000")) == plain(rows, tokens)


def test_rare_pairs_are_joined(sample):
    aligned = ta.align_documents(sample, A_PATH, B_PATH)
    scores = [sorted(map(tuple, ta.link_scores(aligned, 32_000, most).collect())) for most in (0, 50, 1 << 17)]
    assert scores[0] == scores[1] == scores[2]


@pytest.mark.parametrize("stretch", [1, 3, 64, 10_000])
def test_lockstep_finds_every_common_end(stretch):
    rnd = np.random.default_rng(3)
    for _ in range(30):
        total = int(rnd.integers(1, 400))
        a, b = (np.sort(rnd.choice(total, rnd.integers(1, total + 1), replace=False)) + 1 for _ in range(2))
        i, j = ta.common_ends(a, b, total, stretch)
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    assert [len(x) for x in ta.common_ends(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, stretch)] == [0, 0]


def test_empty_tables_and_clashing_columns(nothing, spark, tokens):
    assert ta.align_and_score(nothing, A_PATH, B_PATH).count() == 0
    names = ["n_a", "n_b", "pairs", "times", "row_number", "pair", "count", "best", "x", "n_links"]
    rows = [(1, "one text here"), (2, "one text there")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit(0).alias(n) for n in names])
    assert got(docs) == plain(rows, tokens)


def test_words_are_encoded_once_and_bounded(awkward_rows, tokens):
    with open(A_PATH, encoding="utf-8") as spec, open(B_PATH, "rb") as model:
        pair = ta.Pair(spec.read(), model.read(), 8)
    texts = [*ODD, "", "one two, one three. two", "one  two one", *[r[1] or "" for r in awkward_rows if len(r[1] or "") < 5_000]]
    pair._ready()
    library, seen = pair._live[1], []

    class Counted:
        def encode(self, some, **more):
            seen.extend(some)
            return library.encode(some, **more)

    pair._live = (pair._live[0], Counted(), *pair._live[2:])
    for some in (texts, texts[::-1], *[[text] for text in texts]):
        for text, *ids in zip(some, *[np.split(side.ids, side.before[1:-1]) for side in pair.encoded(some)]):
            assert [x.tolist() for x in ids] == [[i for i, _ in side] for side in tokens(text)]
        assert len(pair.words) <= 8 and all(len(known.before) == len(pair.words) + 1 for known in pair.lists)
    pair.cache_entries, seen[:] = 1000, []
    for _ in range(3):
        pair.encoded(["nine ten eleven ten", "ten nine eleven"])
    assert sorted(seen) == ["eleven", "nine", "ten"]
