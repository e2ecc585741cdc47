import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortflow.llm.merkle_manifest import manifest, merkle_paths, verified


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return h(*[framed(x) for x in (doc_id, source, lang, n_chars, text)])


def climb(nodes):
    """Root of a list of digests, and per node its siblings: (digests before, digests after) on each level."""
    paths, at, members = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(members) > 1:
        runs = [members[i : i + 2] for i in range(0, len(members), 2)]
        for path, k in zip(paths, at):
            run, slot = runs[k // 2], k % 2
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        at, members = [k // 2 for k in at], [h(*run) for run in runs]
    return members[0], paths


def plain(rows):
    langs = defaultdict(list)
    for row in rows:
        langs[row[2]].append(row)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = climb([leaf(r) for r in langs[lang]])
    root, upper = climb([trees[x][0] for x in order]) if order else (None, [])
    out = []
    for k, lang in enumerate(order):
        for row, path in zip(langs[lang], trees[lang][1]):
            whole = path + upper[k]
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, 1) if tampered else leaf(row)
            for a, b in whole:
                node = h(a, node, b)
            out.append((row[0], leaf(row), trees[lang][0], root, h(*[a + b for a, b in whole]), node, node == root))
    return sorted(out, key=str)


def got(docs, **more):
    return sorted(map(tuple, verified(manifest(docs, **more)).collect()), key=str)


def test_awkward_rows(awkward, awkward_rows):
    assert got(awkward) == plain(awkward_rows)


def test_the_sample_in_blocks_of_several_sizes(sample, sample_rows):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in sample_rows]
    wanted = plain(rows)
    assert 0 < sum(not r[-1] for r in wanted) < len(wanted) / 3
    for levels in (1, 3, 8):
        assert got(sample.repartition(5), levels=levels) == wanted


def test_many_languages_and_ties(spark):
    rows = [(k % 40, f"text {k % 50}", None if k % 7 == 0 else "x" * (k % 11), None, k % 3 or None) for k in range(300)]
    rows += [(1, "again", "", "s", 5)] * 9 + [(None, "again", "é", "s", 5), (7, None, "z", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(docs.repartition(6), levels=2) == plain(rows)


@pytest.mark.parametrize("levels", [1, 2, 4])
def test_every_size_of_group(spark, levels):
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33]
    nodes = spark.createDataFrame(
        [(str(n), k, n, h(f"{n}/{k}")) for n in sizes for k in range(n)], "grp string, pos long, n long, hash string"
    )
    paths, roots = merkle_paths(nodes, levels)
    root = {r.grp: r.root for r in roots.collect()}
    path = {(r.grp, r.pos): r.path for r in paths.collect()}
    for n in sizes:
        whole, siblings = climb([h(f"{n}/{k}") for k in range(n)])
        assert root[str(n)] == whole
        for k in range(n):
            assert path[str(n), k] == [f"l{a}" if a else f"r{b}" if b else "" for a, b in siblings[k]]


def test_empty_tables_and_clashing_columns(nothing, spark):
    assert verified(manifest(nothing)).count() == 0
    rows = [(1, "a", "en", "s", 1), (2, "b", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["grp", "pos", "n", "hash", "path", "root", "block", "h0", "s0", "part", "start", "row_number", "leaf", "tampered"]
    assert got(docs.select("*", *[F.lit("x").alias(n) for n in names])) == plain(rows)


def test_windows_span_blocks_never_a_language(sample):
    rows = manifest(sample, levels=3)
    assert rows.count() == sample.count()
    sizes = [len(p) for (p,) in rows.select("path").collect()]
    assert max(sizes) > 3  # more than one round was needed
