"""Tables that are whole or not there: staged writes, published by a manifest.

    table/_versions/<unique name>/part-*.parquet   what a writer staged
    table/_manifests/<version>                     names the folder of a version

A writer stages its files under a name of its own and then publishes the next
version by moving a finished manifest to the version's name, which succeeds
for one writer only (a rename that does not replace on HDFS and the like; a
hard link on a local folder). Readers take the newest manifest and read its
folder, so a write that was killed is never seen, and an overwrite never takes
away what readers use: the version before stays until ``keep`` newer ones are
published. Spark skips names with an underscore, so a plain reader of the
table's folder fails instead of mixing versions.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

STALE_HOURS = 24  # a staged folder without a manifest is taken for abandoned after that


class Conflict(Exception):
    """Another writer published the version first."""


def _is_local(folder: Folder) -> bool:
    return folder.fs.getScheme() == "file"


class Folder:
    """A table's folder on any of Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf, self.root = spark._jvm, spark._jsc.hadoopConfiguration(), path.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        try:
            return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder)))
        except Py4JJavaError as err:
            if "FileNotFoundException" in str(err.java_exception.getClass()):
                return []
            raise

    def age_hours(self, name: str) -> float:
        """0 if it is gone: another writer removes what it staged while we look."""
        try:
            return (self.jvm.System.currentTimeMillis() - self.fs.getFileStatus(self.path(name)).getModificationTime()) / 3.6e6
        except Py4JJavaError as err:
            if "FileNotFoundException" in str(err.java_exception.getClass()):
                return 0.0
            raise

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def create_once(self, name: str, text: str) -> None:
        """Make file ``name`` with its text at once; Conflict if it is there."""
        staged = f"{os.path.dirname(name)}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(staged))
        stream.write(bytearray(text.encode()))
        stream.close()
        if _is_local(self):
            local = lambda n: self.path(n).toUri().getPath()
            try:
                os.link(local(staged), local(name))  # a local rename would replace
            except FileExistsError:
                raise Conflict(name) from None
            finally:
                self.delete(staged)
            return
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        try:
            context.rename(self.path(staged), self.path(name), options)
        except Py4JJavaError as err:
            self.delete(staged)
            if "FileAlreadyExists" in str(err.java_exception.getClass()):
                raise Conflict(name) from None
            raise


def _manifest(version: int) -> str:
    return f"_manifests/{version:020d}"


def versions(folder: Folder) -> list[int]:
    return [int(n) for n in folder.names("_manifests") if n.isdigit()]


def current(spark: SparkSession, path: str, version: int | None = None) -> str | None:
    """The folder of the newest version of the table (or of ``version``); None if nothing is published."""
    folder = Folder(spark, path)
    known = versions(folder)
    if not known or version is not None and version not in known:
        return None
    return f"{folder.root}/{folder.read(_manifest(known[-1] if version is None else version))}"


def publish(spark: SparkSession, path: str, write: Callable[[str], None], first_only: bool = False, keep: int = 2) -> str:
    """Stage by ``write(folder)`` and publish; the folder that is current afterwards.

    ``first_only``: if a version is there when this one is ready, that one
    stays and this one goes, so concurrent first loads agree. Otherwise the
    last to publish is the newest. Nothing is visible before it is published;
    what fails is deleted. ``keep`` versions stay.
    """
    folder = Folder(spark, path)
    own = f"_versions/{uuid.uuid4().hex}"
    try:
        write(f"{folder.root}/{own}")
        while True:
            known = versions(folder)
            if known and first_only:
                folder.delete(own)
                return current(spark, path)
            try:
                folder.create_once(_manifest(known[-1] + 1 if known else 0), own)
                break
            except Conflict:
                continue
    except BaseException:
        folder.delete(own)
        raise
    clean(spark, path, keep)
    return f"{folder.root}/{own}"


def clean(spark: SparkSession, path: str, keep: int = 2, stale_hours: float = STALE_HOURS) -> None:
    """Delete all but the ``keep`` newest versions, and staged folders older
    than ``stale_hours`` that no manifest names."""
    folder = Folder(spark, path)
    known = versions(folder)
    for v in known[:-keep]:
        named = folder.read(_manifest(v))
        folder.delete(_manifest(v))
        folder.delete(named)
    named = {folder.read(_manifest(v)) for v in known[-keep:]}
    for name in folder.names("_versions"):
        staged = f"_versions/{name}"
        if staged not in named and folder.age_hours(staged) > stale_hours:
            folder.delete(staged)
