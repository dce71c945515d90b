"""Quoted CSV in ranges, and tables published whole."""

import os
import random
import subprocess
import sys
import textwrap
import threading
import time
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.sources import commits, io, quoted_csv

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("t", T.StringType()), T.StructField("x", T.DoubleType())])


@contextmanager
def ranges_of(spark, size):
    """Files are split every ``size`` bytes meanwhile."""
    names = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 1}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def in_one_piece(spark, path, schema=SCHEMA):
    """The same files by Spark's own reader, which does not split them."""
    df = spark.read.schema(schema).options(**io.TEXT, multiLine=True, emptyValue=io.EMPTY).csv(path)
    return sorted(map(tuple, df.select("id", F.when(F.col("t") == io.EMPTY, "").otherwise(F.col("t")), "x").collect()), key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def texts(n, seed):
    rnd = random.Random(seed)
    parts = ['"', '""', ",", "\n", "\n\n", "a", "bc", " ", "\\", 'x"y', "é", "long words without anything special "]
    return [(i, rnd.choice([None, "", "".join(rnd.choices(parts, k=rnd.randint(1, 12)))]), rnd.choice([None, float(i)])) for i in range(n)]


@pytest.mark.parametrize("size", [7, 64, 1000, 10**6])
def test_ranges_give_the_rows_of_the_whole_file(spark, tmp_path, size):
    df = spark.createDataFrame(texts(300, size), SCHEMA).coalesce(2)
    path = str(tmp_path / "t")
    io.write_csv(df, path)
    with ranges_of(spark, size):
        got = io.read_csv(spark, path, SCHEMA)
        assert got.rdd.getNumPartitions() > 1
        assert rows(got) == in_one_piece(spark, path) == rows(df)


@pytest.mark.parametrize("size", [5, 40, 10**6])
def test_irregular_files(spark, tmp_path, size):
    path = tmp_path / "t.csv"
    path.write_bytes(('id,"t\r\nt",x\r\n1,"two\r\nlines",2.0\r\n\r\n2,mid"quote,1.0\r\n3,"junk"after,1.0\r\n4,""" at the ends """,\r\n'
                      '5,"",0.5\r\n6,,\r\n').encode())
    (tmp_path / "one_line_only.csv").write_text("id,t,x")
    (tmp_path / "empty.csv").write_text("")
    with ranges_of(spark, size):
        for p in (path, tmp_path):
            assert rows(io.read_csv(spark, str(p), SCHEMA)) == in_one_piece(spark, str(p)) == [
                (1, "two\nlines", 2.0), (2, 'mid"quote', 1.0), (3, '"junk"after', 1.0), (4, '" at the ends "', None), (5, "", 0.5), (6, None, None)]


def test_one_record_over_many_ranges(spark, tmp_path):
    long = "no quotes here\n" * 400
    path = tmp_path / "t.csv"
    path.write_text('id,t,x\n1,"' + long + '",1.0\n2,"' + long.replace("n", '""n') + '",2.0\n3,c,3.0\n')
    with ranges_of(spark, 100):
        got = io.read_csv(spark, str(path), SCHEMA)
        assert got.rdd.getNumPartitions() > 8
        assert rows(got) == [(1, long, 1.0), (2, long.replace("n", '"n'), 2.0), (3, "c", 3.0)]


def test_other_splits_than_those_of_the_quotes_are_refused(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,t,x\n" + "".join(f'{i},"a\nb",1.0\n' for i in range(200)))
    with ranges_of(spark, 100):
        df = io.read_csv(spark, str(path), SCHEMA)
    with ranges_of(spark, 170), pytest.raises(Exception, match="call read_csv again"):
        df.collect()


def test_ends_inside():
    cases = [("", False, False), ("", True, True), ('a,"b', False, True), ('a,"b"', False, False), ('b",c', True, False), ('b"",c', True, True),
             ('"""', False, True), ('""""', False, False), ('a"b', False, False), ('a"b', True, False), ('x",y"z,"w', True, True), ('"a"b,"c', False, True)]
    assert [quoted_csv.ends_inside(line, inside) for line, inside, _ in cases] == [want for *_, want in cases]


# ---------------------------------------------------------------- published tables

def numbers(spark, n):
    return spark.range(n).selectExpr("id AS a", "id * 2 AS b")


def test_versions_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5, 7, 4):
        io.write_parquet(numbers(spark, n), path)
        assert io.read_parquet(spark, path, ["b"]).count() == n
    assert len(os.listdir(f"{path}/_versions")) == 2 and commits.versions(commits.Folder(spark, path)) == [2, 3]
    io.write_parquet(io.read_parquet(spark, path).filter("a > 0"), path)  # over the table that it reads
    assert io.read_parquet(spark, path).count() == 3
    assert spark.read.parquet(commits.current(spark, path, 3)).count() == 4
    with pytest.raises(Exception):
        spark.read.parquet(path).count()  # no mix of versions for a plain reader


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_parquet(numbers(spark, 10), path)
    with pytest.raises(Exception):
        io.write_parquet(numbers(spark, 10).selectExpr("a", "IF(a = 9, raise_error('no'), 'x') AS b"), path)
    assert io.read_parquet(spark, path).count() == 10 and len(os.listdir(f"{path}/_versions")) == 1


def test_killed_write_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    io.write_parquet(numbers(spark, 10), path)
    script = textwrap.dedent(f"""
        import time
        from affinity import get_spark
        from affinity.sources import io
        spark = get_spark("local[2]", extra={{"spark.driver.memory": "1g"}})

        def slow(batches):
            for b in batches:
                yield b
            time.sleep(600)

        io.write_parquet(spark.range(0, 100, 1, 2).mapInPandas(slow, "id long"), {path!r})
    """)
    root = str(Path(__file__).resolve().parents[1])
    job = subprocess.Popen([sys.executable, "-c", script], cwd=root, env=os.environ | {"PYTHONPATH": root},
                           stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, start_new_session=True)
    try:
        until = time.time() + 90
        while len(os.listdir(f"{path}/_versions")) < 2 and time.time() < until:
            time.sleep(0.2)
    finally:
        os.killpg(job.pid, 9)
        job.wait()
    assert len(os.listdir(f"{path}/_versions")) == 2  # what the killed writer staged
    assert io.read_parquet(spark, path).count() == 10
    commits.clean(spark, path, stale_hours=-1)
    assert len(os.listdir(f"{path}/_versions")) == 1 and io.read_parquet(spark, path).count() == 10


RATINGS = "userId,movieId,rating,timestamp\n" + "".join(f"{i},{i * 10},4.0,100\n" for i in range(50))


def test_what_a_killed_conversion_left_is_not_loaded(spark, tmp_path):
    csv, target = tmp_path / "r.csv", tmp_path / "p"
    csv.write_text(RATINGS)
    (target / "_temporary").mkdir(parents=True)
    assert io.load_or_convert(spark, str(target), str(csv)).count() == 50
    partly = tmp_path / "q"
    numbers(spark, 1).write.parquet(str(partly))
    (partly / "_SUCCESS").unlink()  # part files of a job that was not finished
    assert io.load_or_convert(spark, str(partly), str(csv)).count() == 50
    done = tmp_path / "d"
    spark.createDataFrame([(1, 2)], "userId int, movieId int").write.parquet(str(done))  # a finished table of another writer
    assert io.load_or_convert(spark, str(done), "nothing.csv").count() == 1


def test_concurrent_first_loads_agree(spark, tmp_path):
    csv, target = tmp_path / "r.csv", str(tmp_path / "p")
    csv.write_text(RATINGS)
    got = []
    threads = [threading.Thread(target=lambda: got.append(io.load_or_convert(spark, target, str(csv)).inputFiles())) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(got) == 4 and len({tuple(sorted(f)) for f in got}) == 1
    assert len(os.listdir(f"{target}/_versions")) == 1 and commits.versions(commits.Folder(spark, target)) == [0]


def test_one_of_many_publishes_a_version(spark, tmp_path):
    folder = commits.Folder(spark, str(tmp_path / "t"))
    won, lost = [], []

    def attempt(i):
        try:
            folder.create_once("_manifests/0", f"_versions/{i}")
            won.append(i)
        except commits.Conflict:
            lost.append(i)

    threads = [threading.Thread(target=attempt, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and len(lost) == 7 and folder.read("_manifests/0") == f"_versions/{won[0]}"


def test_publishing_by_rename(spark, tmp_path, monkeypatch):
    """The way of file systems other than local ones."""
    folder = commits.Folder(spark, str(tmp_path / "t"))
    monkeypatch.setattr(commits, "_is_local", lambda folder: False)
    folder.create_once("_manifests/0", "first")
    with pytest.raises(commits.Conflict):
        folder.create_once("_manifests/0", "second")
    assert folder.read("_manifests/0") == "first" and folder.names("_manifests") == ["0"]
