"""File moves through the Hadoop file system of a path (local, HDFS, object store alike)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Storage:
    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._open(path)
        return fs.exists(p)

    def make_dirs(self, path: str) -> None:
        fs, p = self._open(path)
        fs.mkdirs(p)

    def delete(self, path: str) -> None:
        fs, p = self._open(path)
        fs.delete(p, True)

    def move(self, source: str, target: str) -> None:
        fs, p = self._open(source)
        t = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(t.getParent())
        if not fs.rename(p, t):
            raise OSError(f"could not move {source} to {target}")

    def size(self, path: str) -> int:
        """Bytes under a path, 0 when it does not exist."""
        fs, p = self._open(path)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def children(self, path: str) -> list[str]:
        """Names directly under a path, empty when it does not exist."""
        fs, p = self._open(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def below(self, path: str, suffix: str) -> list[str]:
        """Paths, relative to a folder, of all files below it whose names end so."""
        fs, p = self._open(path)
        root, out, found = fs.makeQualified(p).toString().rstrip("/"), [], fs.listFiles(p, True)
        while found.hasNext():
            name = found.next().getPath().toString()
            if name.endswith(suffix):
                out.append(name.removeprefix(root).strip("/"))
        return sorted(out)

    def modified(self, path: str) -> int | None:
        """Milliseconds at which a file was last written, by the file system's clock; None when it does not exist."""
        fs, p = self._open(path)
        return fs.getFileStatus(p).getModificationTime() if fs.exists(p) else None

    def first_line(self, path: str, most: int = 1 << 20) -> str:
        """The first line of a text file, without its end; at most ``most`` bytes are read."""
        fs, p = self._open(path)
        factory = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self._conf)
        codec, stream = factory.getCodec(p), fs.open(p)
        try:
            inner = codec.createInputStream(stream) if codec is not None else stream
            line = self._jvm.org.apache.hadoop.io.Text()
            self._jvm.org.apache.hadoop.util.LineReader(inner).readLine(line, most, most)
            return line.toString()
        finally:
            stream.close()

    def read_text(self, path: str) -> str | None:
        """A small file whole, None when it does not exist."""
        fs, p = self._open(path)
        try:
            stream = fs.open(p)
        except Exception as error:  # noqa: BLE001
            if "FileNotFoundException" in str(error):
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small file; one that exists is replaced as a whole."""
        fs, p = self._open(path)
        side = self._side(fs, path, text)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(side, fs.makeQualified(p), self._options("OVERWRITE"))

    def put_new(self, path: str, text: str) -> bool:
        """Create a small file with its content unless it exists; false when it does. Only one caller ever succeeds."""
        fs, p = self._open(path)
        if fs.exists(p):
            return False
        side = self._side(fs, path, text)
        target = fs.makeQualified(p)
        try:
            if target.toUri().getScheme() == "file":  # a rename would replace the file of another writer
                java = self._jvm.java
                java.nio.file.Files.createLink(java.io.File(target.toUri()).toPath(), java.io.File(fs.makeQualified(side).toUri()).toPath())
                return True
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
            context.rename(fs.makeQualified(side), target, self._options("NONE"))
            return True
        except Exception as error:  # noqa: BLE001
            if "AlreadyExists" in str(error):
                return False
            raise
        finally:
            fs.delete(side, False)

    def delete_if_empty(self, path: str) -> None:
        fs, p = self._open(path)
        if fs.exists(p) and not fs.listStatus(p):
            try:
                fs.delete(p, False)
            except Exception as error:  # noqa: BLE001  another writer began in between
                if "not empty" not in str(error).lower():
                    raise

    def _side(self, fs, path: str, text: str):
        """The text in a file beside ``path``."""
        side = self._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        out = fs.create(side, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return side

    def _options(self, name: str):
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway().new_array(rename, 1)
        options[0] = rename.valueOf(name)
        return options

    def _gateway(self):
        from pyspark import SparkContext

        return SparkContext._gateway
