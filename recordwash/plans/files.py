"""Small files of any file system that Spark can reach, through Hadoop's clients."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def _path(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(self.conf)
        return files, files.makeQualified(path)

    def names(self, folder: str) -> list[str]:
        """What the folder holds; nothing if it is absent."""
        files, path = self._path(folder)
        if not files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(path))

    def exists(self, name: str) -> bool:
        files, path = self._path(name)
        return files.exists(path)

    def read(self, name: str) -> str:
        files, path = self._path(name)
        stream = files.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, ascii_text: str) -> bool:
        """Make the file whole, in one step; False if it is there already."""
        files, path = self._path(name)
        written = self.jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}")
        stream = files.create(written, False)
        stream.writeBytes(ascii_text)
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.conf)
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(written, path, self.gateway.new_array(rename, 0))
        except Py4JJavaError as e:
            files.delete(written, False)
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            return False
        return True

    def size(self, name: str) -> int:
        """Bytes of all files under a folder."""
        files, path = self._path(name)
        return files.getContentSummary(path).getLength()

    def delete(self, name: str) -> None:
        files, path = self._path(name)
        files.delete(path, True)
