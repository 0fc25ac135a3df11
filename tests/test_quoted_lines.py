"""Records with line breaks inside quotes, from files that are cut anywhere, as Python's csv module reads them."""

import csv as plain_csv
import io
import random

import pyarrow as pa
import pytest

from counterfoil.sources import csv
from counterfoil.sources.quoted_lines import BEGIN, END, INSIDE, WHOLE, Splits, records
from tests.conftest import rows

COLUMNS = ("a", "b", "c")


@pytest.fixture()
def small_splits(spark):
    """Files are cut every few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def field(rng):
    text = "".join(rng.choice(["x", "y z", ",", "\n", "\n\n", '"', '""', "\r\n", "ü", "é"]) for _ in range(rng.randrange(6)))
    return text if rng.random() < 0.7 else "".join(rng.choice(["l", "\n"]) for _ in range(rng.randrange(900)))


def written(data, end, quoting):
    out = io.StringIO()
    writer = plain_csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerows([COLUMNS, *data])
    return out.getvalue()


@pytest.mark.parametrize("seed, end, quoting", [(1, "\n", plain_csv.QUOTE_MINIMAL), (2, "\r\n", plain_csv.QUOTE_ALL), (3, "\n", plain_csv.QUOTE_ALL)])
def test_any_cut_gives_the_same_records(spark, small_splits, tmp_path, seed, end, quoting):
    rng = random.Random(seed)
    files = []
    for n in range(3):
        data = [[f"{n}-{i}", "v" + field(rng), "w" + field(rng)] for i in range(40)]
        (tmp_path / f"f{n}.csv").write_bytes(written(data, end, quoting).encode())
        files += data
    read = csv.read_text_csv(spark, str(tmp_path), COLUMNS)
    assert rows(read) == sorted(map(tuple, files), key=repr)
    found = records(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() > 8


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    """All records have breaks inside quotes; the file is cut as any text is."""
    path = tmp_path / "big.csv"
    with open(path, "w") as out:
        out.write("a,b,c\n")
        for i in range(60_000):
            out.write(f'{i},"line one of {i}\nline two, ""quoted""\n","{i % 7}"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        read = csv.read_text_csv(spark, str(path), COLUMNS)
        assert records(spark, str(path)).rdd.getNumPartitions() >= 8
        total = read.selectExpr("count(*) n", "sum(int(a)) s", "count(distinct c) k", "sum(length(b)) l").first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lengths = sum(len(f'line one of {i}\nline two, "quoted"\n') for i in range(60_000))
    assert tuple(total) == (60_000, sum(range(60_000)), 7, lengths)


def test_quote_that_is_never_closed(spark, small_splits, tmp_path):
    text = "a,b,c\n1,2,3\n" + '4,"open,6\n' + "7,8,9\n" * 200
    (tmp_path / "f.csv").write_text(text)
    found = sorted((r["split"], r["at"], r["record"]) for r in records(spark, str(tmp_path)).collect())
    assert [r[2] for r in found[:2]] == ["a,b,c", "1,2,3"] and len(found) == 3
    assert found[2][2] == text[len("a,b,c\n1,2,3\n") :].removesuffix("\n")


def test_blank_lines_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n\n1,,\"\"\n  \n\n2,x\n")
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text("a,b,c")
    assert rows(csv.read_text_csv(spark, str(tmp_path), COLUMNS)) == [("1", None, ""), ("2", "x", None)]


def test_pieces_of_a_split():
    """Lines may come in batches of any size."""
    lines = ['a"', "b", 'c"d"', "e", 'f"', "g"]
    for cut in range(1, len(lines)):
        state = Splits({(1, 5)})
        out = [b for part in (lines[:cut], lines[cut:]) for b in state.add(1, 5, pa.array(part))]
        out += list(state.add(1, 9, pa.array(["x"]))) + list(state.finish())
        pieces = [tuple(r.values()) for b in out for r in b.to_pylist()]
        assert pieces == [
            (1, 5, 0, END, 'a"'), (1, 5, 1, WHOLE, "b"), (1, 5, 2, WHOLE, 'c"d"'), (1, 5, 3, WHOLE, "e"),
            (1, 5, 4, BEGIN, 'f"\ng'), (1, 9, 0, WHOLE, "x"),
        ]
    state = Splits({(1, 5)})
    assert not list(state.add(1, 5, pa.array(["a", "b"])))
    [batch] = state.finish()
    assert batch.to_pylist() == [{"file": 1, "split": 5, "at": 0, "kind": INSIDE, "record": "a\nb"}]
