import os
import tempfile

from strata.sources.csv import read_csv_lenient


def test_long_lines_skipped_short_kept_junk_dropped(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("A,B,C,,\n")
        f.write("1,2,3,,\n")            # good
        f.write("4,5\n")                # short -> padded
        f.write("6,7,8,,,9\n")          # long -> skipped
        f.write("6,7,8,,,,\n")          # long -> skipped
        f.write('10,"a,""b""",11,,\n')  # quoted comma and doubled quotes
        f.write('12,"x,y"\n')           # short with quoted comma
    df = read_csv_lenient(spark, d)
    assert df.columns == ["A", "B", "C"]
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", "2", "3"), ("10", 'a,"b"', "11"), ("12", "x,y", None), ("4", "5", None)]


def test_usecols_tolerates_absent(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("PATIENTID,TYPE,AMOUNT,OTHER\np1,a,NA,z\n")
    df = read_csv_lenient(spark, d, usecols=lambda c: c in ["PATIENTID", "TYPE", "AMOUNT", "MISSING"])
    assert df.columns == ["PATIENTID", "TYPE", "AMOUNT"]
    assert [tuple(r) for r in df.collect()] == [("p1", "a", None)]


def test_explicit_columns_keep_first_line(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write("1,a\n2,b\n1,a\n")
    df = read_csv_lenient(spark, d, columns=["k", "v"])
    assert df.count() == 3


def test_quoted_fields_that_span_lines(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    with open(os.path.join(d, "a b.csv"), "w") as f:
        f.write('A,B,C\n1,"first\nsecond, ""third""\n",x\n2,5" pipe,y\n3,"p\nq",z,long\n4,"r\n\ns"\n')
    with open(os.path.join(d, "plain.csv"), "w") as f:
        f.write('A,B,C\n5,6" pipe,7" pipe\n')
    df = read_csv_lenient(spark, d)
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", 'first\nsecond, "third"\n', "x"), ("2", '5" pipe', "y"), ("4", "r\n\ns", None),
        ("5", '6" pipe', '7" pipe')]
    assert df.count() == 4


def test_header_of_each_file_by_position(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    for name, text in (("1.csv", "A,B\n1,2\nA,B\n"), ("2.csv", "B,A,C\n4,3,5\n"), ("3.csv", '"A","B\nB"\n6,7\n')):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    df = read_csv_lenient(spark, d)
    assert sorted(df.columns) == ["A", "B", "B\nB", "C"]
    got = sorted(((r["A"], r["B"], r["C"], r["B\nB"]) for r in df.collect()), key=str)
    assert got == [("1", "2", None, None), ("3", "4", "5", None), ("6", None, None, "7"), ("A", "B", None, None)]
    df = read_csv_lenient(spark, d, columns=["x", "y"], header=True)
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2"), ("6", "7"), ("A", "B")]


def test_states_follow_lines():
    import itertools

    import numpy as np

    from strata.sources.csv import follow
    kinds = [(False, False), (True, True), (False, True), (True, False)]          # after outside, after inside
    for n in range(5):
        for lines in itertools.product(kinds, repeat=n):
            for start in (False, True):
                want = [start]
                for out, inside in lines:
                    want.append(inside if want[-1] else out)
                a, b = (np.array([x[k] for x in lines], bool) for k in (0, 1))
                assert follow(a, b, start).tolist() == want


def test_one_file_with_multi_line_fields_is_split(spark):
    """A large file with fields that span lines and blocks: many tasks, and the
    rows of Python's own reader."""
    import csv
    import random
    rng = random.Random(4)
    d = tempfile.mkdtemp(prefix="strata-csv-")
    pieces = ["a", "b,c", 'say ""no""', "x\ny", "\n\n", "long " * 30, "", "p\n\"\"q\"\"\n,r"]
    lines, n = ["id,text,more"], 3000
    for i in range(n):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 5)))
        lines.append(f'{i},"{text}",{rng.choice(["m", "5\" pipe", "", chr(34) + "z" + chr(10) + "w" + chr(34)])}')
    body = "\n".join(lines) + "\n"
    with open(os.path.join(d, "t.csv"), "w", newline="") as f:
        f.write(body)
    want = sorted(tuple(r) for r in list(csv.reader(body.splitlines(True)))[1:])
    assert len(want) == n
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 20
        df = read_csv_lenient(spark, d, na_tokens=False)
        got = sorted((r["id"], r["text"] or "", r["more"] or "") for r in df.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want


def test_no_text_at_all(spark):
    d = tempfile.mkdtemp(prefix="strata-csv-")
    open(os.path.join(d, "t.csv"), "w").close()
    assert read_csv_lenient(spark, d, columns=["a", "b"]).collect() == []
    assert read_csv_lenient(spark, d).collect() == []
