import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cohortflow.llm import substring_dedup as sd
from cohortflow.llm import words
from cohortflow.llm.substring_dedup import repeated_spans

DOCS = "doc_id long, text string"


def chunks_of(text):
    data, offsets = words.text_bytes(pa.array([text]))
    starts = sd.chunk_starts(data, offsets).tolist()
    return [(a, b) for a, b in zip(starts, [*starts[1:], len(data)])]


def brute(rows, least=100):
    """Spans by definition, from the same chunks."""
    places = defaultdict(set)
    for doc_id, text in rows:
        if text and doc_id is not None:
            data = text.encode()
            for a, b in chunks_of(text):
                places[data[a:b]].add((doc_id, a))
    out = []
    shared = defaultdict(set)
    for body, found in places.items():
        if len({d for d, _ in found}) > 1:
            for doc_id, a in found:
                shared[doc_id].add((a, a + len(body), min(found), doc_id != min(found)[0]))
    for doc_id, found in shared.items():
        run = []
        for chunk in [*sorted(found), None]:
            if run and (chunk is None or chunk[0] > max(c[1] for c in run)):
                start, end = run[0][0], max(c[1] for c in run)
                if end - start >= least:
                    removed = sum(c[1] - c[0] for c in run if c[3])
                    out.append((doc_id, start, end, len(run), removed, min(c[2][0] for c in run)))
                run = []
            if chunk:
                run.append(chunk)
    return sorted(out)


def result(docs):
    columns = ["doc_id", "start", "end", "chunks", "removed_bytes", "first_doc_id"]
    return sorted(tuple(r) for r in repeated_spans(docs).select(*columns).collect())


def test_chunks_tile_a_text_and_split_no_character():
    rnd = random.Random(1)
    for text in ("é" * 300, "日本語" * 100, "a", "ab" * 500, "".join(rnd.choice("abcé日 \n") for _ in range(5000))):
        spans = chunks_of(text)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        data = text.encode()
        assert "".join(data[a:b].decode() for a, b in spans) == text
        assert all(b - a <= sd.MOST + 4 for a, b in spans)


def test_chunks_resist_shifts_and_neighbours():
    rnd = random.Random(2)
    text = " ".join(f"w{rnd.randrange(5000)}" for _ in range(600))
    pieces = {text.encode()[a:b] for a, b in chunks_of(text)}
    moved = {("inserted " + text).encode()[a:b] for a, b in chunks_of("inserted " + text)}
    assert len(pieces - moved) <= 3
    data, offsets = words.text_bytes(pa.array([text, "", None, "x", text]))
    starts = sd.chunk_starts(data, offsets)
    first, second = offsets[0], offsets[4]
    assert (starts[starts >= second] - second).tolist() == starts[starts < offsets[1]].tolist()
    assert np.mean(np.diff(starts)) < 40 and first == 0


def test_shared_passages_are_found_and_others_left_alone(spark):
    rnd = random.Random(3)
    prose = lambda n: " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(10**5)}" for _ in range(n))
    passages = [prose(55) for _ in range(40)]
    rows, planted = [], set()
    for i in range(300):
        text = prose(rnd.randrange(100, 400))
        if i < 80:
            text = f"{prose(rnd.randrange(30))} {passages[i % 40]} {text}"
            planted.add(i)
        rows.append((i, text))
    got = result(spark.createDataFrame(rows, DOCS).repartition(4))
    assert {r[0] for r in got} == planted
    assert got == brute(rows)


def test_awkward_rows(awkward, awkward_rows):
    assert result(awkward) == brute([(r[0], r[1]) for r in awkward_rows])


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "")], [(1, "x" * 3000)], [(1, "line of text\n" * 200)], [(None, "a " * 200), (None, "a " * 200)]])
def test_nothing_shared(spark, rows):
    assert result(spark.createDataFrame(rows, DOCS)) == []


def words_of(rnd, n):
    return " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(10**5)}" for _ in range(n))


def test_pieces_of_several_documents_side_by_side_are_no_span(spark):
    rnd = random.Random(5)
    others = [words_of(rnd, 60) for _ in range(80)]
    pieces = []
    for text in others:
        data, spans = text.encode(), chunks_of(text)
        short = [(a, b) for a, b in spans[2:-2] if 20 <= b - a <= 60]
        pieces.append(data[short[0][0] - sd.WINDOW : short[0][1]].decode())
    rows = [*enumerate(others), (1000, "".join(pieces)), (1001, others[0])]
    assert any(r[0] == 1000 for r in brute(rows, 20))
    got = result(spark.createDataFrame(rows, DOCS))
    assert {r[0] for r in got} == {0, 1001}
    bodies = {r[0]: r[1].encode() for r in rows}
    for doc_id, start, end, *_ in got:
        assert any(bodies[doc_id][start:end] in body for other, body in bodies.items() if other != doc_id)
    # Chunks that are shared one by one, each with a document of its own.
    borrowed = []
    for text in others:
        borrowed += [text.encode()[a:b] for a, b in chunks_of(text)[2:4]]
    mosaic = b"".join(borrowed).decode()
    assert {r[0] for r in result(spark.createDataFrame([*enumerate(others), (1000, mosaic)], DOCS))} == set()


def test_repeats_inside_one_document(spark):
    rnd = random.Random(6)
    passage = words_of(rnd, 60)
    text = " ".join([words_of(rnd, 40), passage, words_of(rnd, 40), passage, words_of(rnd, 40), passage, words_of(rnd, 9)])
    rows = [(1, text), (2, words_of(rnd, 300)), (3, passage), (3, passage)]
    got = [r for r in repeated_spans(spark.createDataFrame(rows, DOCS), within=True).orderBy("doc_id", "start").collect()]
    assert [r.doc_id for r in got] == [1, 1, 1, 3]
    first, second, third, other = got
    assert first.removed_bytes == 0 and second.removed_bytes == second.end - second.start
    assert third.removed_bytes == third.end - third.start and other.removed_bytes == other.end - other.start
    body = text.encode()
    assert body[first.start : first.end] == body[second.start : second.end] and first.end - first.start > 250
