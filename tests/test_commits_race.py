from affinity.sources import commits


def test_a_staged_folder_that_another_writer_removes_is_left_alone(spark, tmp_path, monkeypatch):
    path, listed = str(tmp_path / "t"), commits.Folder.names
    monkeypatch.setattr(commits.Folder, "names", lambda self, folder: listed(self, folder) + ["gone"] * (folder == "_versions"))
    where = commits.publish(spark, path, lambda folder: spark.range(3).write.parquet(folder))
    assert spark.read.parquet(where).count() == 3 and commits.current(spark, path) == where
