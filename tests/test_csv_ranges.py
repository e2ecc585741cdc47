"""Records with line breaks, read from ranges, against Spark's reader of whole files."""

import random
import re

import pytest
from conftest import rows

from cohortflow.sources import csv_files
from cohortflow.sources.csv_files import read_csv
from cohortflow.sources.csv_ranges import OPENS, STAYS_OPEN, UnclosedQuote


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def planted(seed, n):
    """Records of three fields: breaks, quotes, commas, empty and stray ones."""
    rnd = random.Random(seed)
    plain = ["", "x", "a b", '5" pipe', "it's", "ö日"]
    quoted = ['"two\nlines"', '"say ""hi"",\n\n ""there"""', '""', '"a,b"', '"\n"', '"' + "long " * 60 + '\nend"', '"""\n"""']
    return [",".join([str(i), *(rnd.choice(quoted if rnd.random() < 0.4 else plain) for _ in range(2))]) for i in range(n)]


def is_open(line, inside):
    """Whether quotes are open after a line, character by character."""
    at, start = 0, not inside
    while at < len(line):
        c = line[at]
        if inside:
            if c == '"':
                if line[at + 1 : at + 2] == '"':
                    at += 1
                else:
                    inside = start = False
        elif c == ",":
            start = True
        elif c == '"' and start:
            inside = True
        else:
            start = False
        at += 1
    return inside


def test_a_line_read_both_ways():
    rnd, opens, stays = random.Random(5), re.compile(OPENS.replace(r"\z", r"\Z")), re.compile(STAYS_OPEN.replace(r"\z", r"\Z"))
    for _ in range(20_000):
        line = "".join(rnd.choice('",,x"') for _ in range(rnd.randrange(12)))
        assert bool(opens.match(line)) == is_open(line, False), line
        assert bool(stays.match(line)) == is_open(line, True), line


@pytest.mark.parametrize("seed", range(3))
def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, small_ranges, seed):
    path = tmp_path / "big.csv"
    path.write_text("A,B,C\n" + "\n".join(planted(seed, 2_000)) + ("\n" if seed else ""), newline="")
    mine = read_csv(spark, str(path))
    assert path.stat().st_size > 20 * 4096
    assert rows(mine) == rows(read_csv(spark, str(path), multiline=True))
    assert mine.rdd.getNumPartitions() > 10


def test_many_files_and_a_record_over_several_ranges(spark, tmp_path, small_ranges):
    for k in range(5):
        body = [*planted(k, 40), f'{k},"' + "\n".join(f"line {i} of {k}" for i in range(2_000)) + '",z', *planted(9 + k, 40)]
        (tmp_path / f"{k}.csv").write_text("A,B,C\n" + "\n".join(body) + "\n", newline="")
    assert rows(read_csv(spark, str(tmp_path))) == rows(read_csv(spark, str(tmp_path), multiline=True))


def test_carriage_returns_blank_lines_and_headers(spark, tmp_path, small_ranges):
    more = "".join(f'{k},"x{k}\r\ny"\r\n' for k in range(500))
    (tmp_path / "a.csv").write_bytes(f'"A\r\nx", b \r\n1,"p\r\nq"\r\n\r\n   \r\n"",2\r\n{more}'.encode())
    got = read_csv(spark, str(tmp_path / "a.csv"))
    assert got.columns == ["a\nx", "b"]
    assert rows(got) == rows(read_csv(spark, str(tmp_path / "a.csv"), multiline=True))
    assert {("1", "p\nq"), (None, "2"), ("   ", None), ("7", "x7\ny")} < set(rows(got))
    (tmp_path / "b.csv").write_text('b,"A\nx"\n1,2\n')
    with pytest.raises(ValueError, match="header"):
        read_csv(spark, str(tmp_path))


def test_lines_without_quotes_are_not_copied_to_count_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,2\n"x, ""y""",3\n')
    (tmp_path / "b.csv").write_text('A,B\n1,"2\n3"\n')
    assert not csv_files.records_span_lines(spark, str(tmp_path / "a.csv"))
    assert csv_files.records_span_lines(spark, str(tmp_path))
    assert "contains(value" in csv_files.odd_lines(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_only_the_edges_of_ranges_are_moved(spark, tmp_path, small_ranges, monkeypatch):
    from cohortflow.sources import csv_ranges

    path, moved = tmp_path / "big.csv", []
    path.write_text("A,B,C\n" + "\n".join(planted(7, 4_000)) + "\n", newline="")
    real = csv_ranges.kept
    monkeypatch.setattr(csv_ranges, "kept", lambda df, label: moved.append(real(df, label)) or moved[-1])
    mine = read_csv(spark, str(path))
    ranges = path.stat().st_size // 4096 + 1
    assert ranges > 30 and 0 < sum(df.count() for df in moved) <= 3 * ranges
    plan = mine._jdf.queryExecution().executedPlan().toString()
    inner = plan[: plan.index("csv-edges")]  # the records inside ranges come first
    assert "MapInArrow" in inner and "Exchange" not in inner[: inner.index("FileScan text")]
    assert rows(mine) == rows(read_csv(spark, str(path), multiline=True))


def test_a_quote_that_never_closes_is_an_error(spark, tmp_path, small_ranges):
    path = tmp_path / "u.csv"
    path.write_text('A,B\n1,"x\n' + "2,y\n" * 5_000)
    with pytest.raises(UnclosedQuote):
        read_csv(spark, str(path))


def test_very_long_fields_in_short_and_long_records(spark, tmp_path):
    long = "x" * 1_000_000
    for name, line, fits in (("s", f'"{long}",2', True), ("q", '"' + '""' * 500_000 + '"', True), ("l", f'"{long}",2,3,4', False)):
        for end, cut in (("", ""), ("\n7,\"a\nb\",9", "a\nb")):
            path = tmp_path / f"{name}{bool(cut)}.csv"
            path.write_text(f"A,B,C\n{line}{end}\n")
            df = read_csv(spark, str(path))
            if fits:
                assert df.count() == 1 + bool(cut)
                assert max(len(r.a) for r in df.collect()) in (1_000_000, 500_000)
            else:
                with pytest.raises(Exception, match="more fields"):
                    df.collect()
