"""Written tables go when the last frame that reads them is gone."""

import threading
import time
import uuid
from pathlib import Path

from affinity.plans import profiling, recsys
from affinity.session import ensure_checkpoint_dir, sweep_tables, track_table
from tables import SF


def written(spark, n):
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    spark.range(n).write.parquet(path)
    return track_table(spark.read.parquet(path), path), path


def there(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def test_a_derived_frame_keeps_its_table(spark):
    df, path = written(spark, 10)
    derived = df.filter("id > 3").groupBy((df.id % 2).alias("k")).count().join(df.selectExpr("id AS k"), "k")
    del df
    sweep_tables(spark, collect=True)
    assert there(spark, path) and derived.count() == 2
    del derived
    for _ in range(5):
        if not sweep_tables(spark, collect=True) and not there(spark, path):
            break
    assert not there(spark, path)


def test_nothing_is_left_after_many_queries(spark):
    sweep_tables(spark, collect=True)
    for _ in range(7):
        assert profiling.texts_csv_roundtrip(spark, SF).count() > 0
        assert recsys.split_files(spark, SF).count() > 0
        assert written(spark, 5)[0].count() == 5
    until = time.monotonic() + 30  # plans are let go of a moment after their query, by threads of the JVM
    while sweep_tables(spark, collect=True) and time.monotonic() < until:
        time.sleep(0.5)
    assert sweep_tables(spark, collect=True) == 0
    root = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark)).toUri().getPath()
    assert not [f for f in Path(root).iterdir() if f.name.startswith(("roundtrip-", "splits-", "table-"))]


def test_concurrent_queries_do_not_take_each_others_tables(spark):
    failed = []

    def work(n):
        try:
            for i in range(6):
                df, _ = written(spark, n + i)
                sweep_tables(spark, collect=True)
                assert df.count() == n + i
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=work, args=(10 * t,)) for t in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
