"""Readers and sinks on small CSV files (escaped quotes, multi-line fields,
required columns, keep-first in file order)."""

import os
import tempfile

import pytest

from catalink.sources import readers as R
from catalink.sources import sinks as K


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_escaped_and_multiline(spark):
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    path = write(folder, "reviews.csv",
                 'app_id,reviews\n1,"A \\"quote\\""\n2,"two\nlines"\n3,\\N\n')
    rows = R.read_csv_text(spark, path, ["app_id", "reviews"]).collect()
    assert [r.app_id for r in rows] == ["1", "2", "3"]
    assert rows[0].reviews == 'A "quote"' and rows[1].reviews == "two\nlines"


def test_required_keep_first_in_file_order(spark):
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    path = write(folder, "sales.csv", "Name,Platform\nB,x\nA,first\n,y\nA,second\nB,z\n")
    out = {r.Name: r.Platform for r in R.read_required(spark, path, ["Name", "Platform"], ["Name"]).collect()}
    assert out == {"A": "first", "B": "x"}


def test_long_reader(spark):
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    path = write(folder, "genres.csv", "app_id,genre\n10, Action \n11,\n,RPG\n12,Indie\n")
    rows = sorted(tuple(r) for r in R.read_long_csv(spark, path, "app_id", "genre").collect())
    assert rows == [(10, "Action"), (12, "Indie")]


def test_land_and_shapes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    path = K.scratch_path(spark, "test-land")
    R.land_parquet(df, path)
    back = R.read_parquet(spark, path)
    shapes = K.table_shapes({"t": back}).collect()[0]
    assert (shapes.rows, shapes.columns) == (2, 2)


def test_columns_are_bound_by_header(spark):
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    path = write(folder, "sales.csv", "Rank,Name,Platform\n1,Zelda,NES\n2,,SNES\n")
    for escape in (R.DOUBLED, R.BACKSLASH, R.EITHER):
        out = [tuple(r) for r in R.read_required(spark, path, ["Platform", "Name"], ["Name"], escape=escape).collect()]
        assert out == [("NES", "Zelda")]
        with pytest.raises(ValueError, match="Genre"):
            R.read_csv_text(spark, path, ["Genre"], escape=escape)


def test_doubled_and_escaped_quotes(spark):
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    path = write(folder, "wide.csv", 'name,n\n"a ""b"", c",2\n"x ""y""",3\n"A \\"quote\\", d",4\n"two\nlines ""q""",5\n')
    rows = [tuple(r) for r in R.read_csv_text(spark, path, order=True).orderBy("_seq").drop("_seq").collect()]
    assert rows == [('a "b", c', "2"), ('x "y"', "3"), ('A "quote", d', "4"), ('two\nlines "q"', "5")]
    path = write(folder, "long.csv", 'x,genre,app_id\n1,"a ""b"", c",2\n2,NA,3\n3,null,4\n4," y ",5\n')
    assert sorted(tuple(r) for r in R.read_long_csv(spark, path, "app_id", "genre").collect()) == [(2, 'a "b", c'), (5, "y")]


def test_either_streams_files_of_any_size(spark):
    """Files above the limit of a whole-file value, in many splits, with records across them."""
    import csv
    import random
    rnd = random.Random(5)
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    want = []
    for name in ("a.csv", "b.csv"):
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            out = csv.writer(f, lineterminator=rnd.choice(["\n", "\r\n"]))
            out.writerow(["x", "n"])
            for i in range(800):
                text = "".join(rnd.choice(['"', ",", "\n", "\r\n", "\n\n", "é", "word ", "b"]) for _ in range(rnd.randint(1, 40)))
                out.writerow([text, f"{name}{i}"])
                want.append((text, f"{name}{i}"))
            f.write('"A \\"quote\\", d",last')  # no line feed at the end
            want.append(('A "quote", d', "last"))
    limits = {"spark.sql.sources.binaryFile.maxLength": "1000", "spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        assert spark.read.text(folder).rdd.getNumPartitions() > 4
        got = [tuple(r) for r in R.read_csv_text(spark, folder, order=True).orderBy("_seq").drop("_seq").collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want
    path = os.path.join(folder, "wide16")
    with open(path, "w", encoding="utf-16", newline="") as f:
        f.write('x,n\n"é\n""q""",1\nż,2\n')
    parsed = R._parse_either(spark, path, ["x", "n"], "utf-16").orderBy("_seq").drop("_seq")
    assert [tuple(r) for r in parsed.collect()] == [('é\n"q"', "1"), ("ż", "2")]


def test_line_states_agree_with_csv():
    """Where the csv module ends a record, line by line, on random odd lines."""
    import csv
    import io
    import random

    from catalink.sources import splits
    rnd = random.Random(3)

    class Lines:
        def __init__(self, lines):
            self.lines, self.n = lines, 0

        def __iter__(self):
            return self

        def __next__(self):
            if self.n == len(self.lines):
                raise StopIteration
            self.n += 1
            return self.lines[self.n - 1]

    for _ in range(3000):
        text = "".join(rnd.choice(['"', '"', ",", "\n", "\\", "a", "\r\n", '"",', 'x"']) for _ in range(rnd.randint(2, 14))) + "\n"
        state, mine = splits.RECORD, []
        for line in text[:-1].split("\n"):
            state = splits.after_line(line.encode(), state)
            mine.append(state == splits.RECORD)
        source, ended = Lines(list(io.StringIO(text, newline=""))), set()
        for _ in csv.reader(source, doublequote=True, escapechar="\\"):
            ended.add(source.n)
        want = [i + 1 in ended for i, x in enumerate(source.lines) if x.endswith("\n")]
        assert mine[:-1] == want[:-1], text  # the last one ends the input in any case


def test_splits_parse_on_their_own(spark):
    """One file, many splits, records and the header across them, both kinds of escapes; the
    begin states by broadcast and by join."""
    import random

    from catalink.sources import splits
    rnd = random.Random(8)
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    path, want = os.path.join(folder, "one.csv"), []
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write('"x\n' + "long header " * 60 + '",n\n')
        for i in range(1500):
            text = "".join(rnd.choice(['"', ",", "\n", "\n", "é", "word "]) for _ in range(rnd.choice([3, 30, 900 if i % 200 == 0 else 5])))
            f.write('"' + text.replace('"', rnd.choice(['""', '\\"'])) + f'",{i}\n')
            want.append((text, str(i)))
    limits = {"spark.sql.files.maxPartitionBytes": "400", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in limits}
    limit = splits.BROADCAST_SPLITS
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        for few in (limit, 0):
            splits.BROADCAST_SPLITS = few
            got = [tuple(r) for r in splits.parse(spark, path, ["x", "n"]).orderBy("_seq").drop("_seq").collect()]
            assert got == want
    finally:
        splits.BROADCAST_SPLITS = limit
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_of_other_lengths(spark):
    folder = tempfile.mkdtemp(prefix="catalink-src-")
    path = write(folder, "odd.csv", "a,b\n1\n2,3,4\n\n5,6\n")
    rows = R.read_csv_text(spark, path, order=True).orderBy("_seq").drop("_seq").collect()
    assert [tuple(r) for r in rows] == [("1", None), ("2", "3"), ("5", "6")]
    with pytest.raises(Exception, match="fields"):
        R.read_csv_text(spark, path, rows="fail").collect()
