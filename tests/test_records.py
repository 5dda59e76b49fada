"""Records with line breaks in quotes, whatever the splits they are read in."""

from __future__ import annotations

import csv
import io

import numpy as np
import pytest

from clienttrail.sources import read_raw_csv
from clienttrail.sources.records import Splits, ends_inside, quoted_records


def made(rng, count):
    pieces = ["a", "b c", '"', "\n", ",", "é", "'", '""', "5"]
    return [
        ["".join(rng.choice(pieces, rng.integers(1, 9))) + "x" for _ in range(3)] for _ in range(count)
    ]


def written(path, rows, names=("p", "q", "r")):
    with path.open("w", newline="") as file:
        out = csv.writer(file, lineterminator="\n")
        out.writerow(names)
        out.writerows(rows)
    return str(path)


@pytest.fixture
def split_size(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(k) for k in keys]

    def set_to(size):
        for key in keys:
            spark.conf.set(key, str(size))

    yield set_to
    for key, value in zip(keys, old):
        spark.conf.set(key, value)


@pytest.mark.parametrize("size", [40, 150, 1 << 20])
def test_like_a_plain_reader(spark, tmp_path, split_size, size):
    rng = np.random.default_rng(size)
    tables = [made(rng, n) for n in (24, 1, 9)]
    for number, rows in enumerate(tables):
        written(tmp_path / f"{number}.csv", rows)
    split_size(size)
    df = read_raw_csv(spark, str(tmp_path / "*.csv"), null_tokens=(), multiline=True)
    if size < 1000:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    assert sorted(map(tuple, df.collect())) == sorted(tuple(r) for rows in tables for r in rows)


def test_a_record_over_many_splits(spark, tmp_path, split_size):
    long = "\n".join(f"line {i}" for i in range(60))
    quotes = "\n".join(['""', '"', "x,", ',"'] * 10)
    rows = [["1", long, "z"], ["2", "b", quotes], ["3", quotes + "\n" + long, long], ["4", "x", "y"]]
    split_size(64)
    df = read_raw_csv(spark, written(tmp_path / "a.csv", rows), multiline=True)
    assert sorted(map(tuple, df.collect())) == [tuple(r) for r in rows]


def test_torn_blank_and_odd_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('p,q,r\n\n1,5" pipe,x\n   \n2,"a\r\nb",y\n3,only two\n4,"c"d,z\n5,,"n/a"\n')
    torn = read_raw_csv(spark, str(path), null_tokens=("n/a",), multiline=True, keep_torn=True).collect()
    assert sorted((r.p, r.q, r.r) for r in torn if r.p not in "35") == [
        ("1", '5" pipe', "x"), ("2", "a\nb", "y"), ("4", '"c"d', "z"),
    ]
    by_id = {r.p: r for r in torn}
    assert by_id["3"][-1] == "3,only two" and [r[-1] for r in torn if r.p != "3"] == [None] * 4
    assert by_id["5"].q is None and by_id["5"].r is None
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw_csv(spark, str(path), multiline=True).collect()


def test_without_breaks_both_readers_agree(spark, raw_path):
    assert sorted(map(str, read_raw_csv(spark, raw_path, multiline=True).collect())) == sorted(
        map(str, read_raw_csv(spark, raw_path).collect())
    )


def test_errors(spark, tmp_path):
    written(tmp_path / "a.csv", [["1", "2", "3"]])
    written(tmp_path / "b.csv", [["1", "2", "3"]], ("p", "r", "q"))
    with pytest.raises(Exception, match="has the header"):
        read_raw_csv(spark, str(tmp_path), multiline=True).collect()
    path = tmp_path / "open.csv"
    path.write_text('p,q\n1,"never closed\n2,x\n')
    with pytest.raises(ValueError, match="not closed in .*open.csv"):
        read_raw_csv(spark, str(path), multiline=True)
    path.write_text('p,q\n1,"x"\n')
    with pytest.raises(ValueError, match="maxPartitionBytes"):
        quoted_records(spark, str(path), ["p", "q"], max_splits=0)


def test_header_alone_and_odd_names(spark, tmp_path):
    names = ("a b", "c`d", "e:f")
    odd = read_raw_csv(spark, written(tmp_path / "b.csv", [["1", "2\n", "3"]], names), null_tokens=(), multiline=True)
    assert odd.columns == list(names) and [tuple(r) for r in odd.collect()] == [("1", "2\n", "3")]
    assert read_raw_csv(spark, written(tmp_path / "a.csv", []), multiline=True).count() == 0


def test_states_of_lines():
    rng = np.random.default_rng(3)
    for row in made(rng, 400):
        text = io.StringIO()
        csv.writer(text, lineterminator="").writerow(row)
        inside = False
        for line in text.getvalue().split("\n"):
            inside = ends_inside(line, inside)
        assert not inside
    assert ends_inside('a,"b', False) and not ends_inside('b",c', True) and ends_inside('b""', True)


def test_splits_that_changed():
    row = {"path": "f", "file": 1, "start": 0, "length": 10, "out_end": True, "in_end": False, "in_closed": True}
    last = row | {"start": 20, "out_end": True, "in_end": False}
    splits = Splits([last, row])
    assert splits.entered(1, 0, 10) == (-1, True) and splits.entered(1, 10, 10) == (0, False)
    assert splits.entered(1, 20, 10) == (0, True) and splits.entered(1, 20, 5)[1] is False
    assert splits.entered(1, 30, 10) == (-1, False) and splits.cut() == [(1, 0)]
