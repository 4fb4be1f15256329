"""Immutable JSON artifacts and completion markers in the store of a dataset."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import SparkSession

#: Name space of identities that follow from what they identify.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "tidemark")


def identity(*parts: str) -> uuid.UUID:
    """The same identity for the same parts, so that a replay makes the same rows."""
    return uuid.uuid5(NAMESPACE, "\x1f".join(parts))


class ArtifactConflict(RuntimeError):
    """Another content is there already."""


class Artifacts:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._jvm, self.path, self._path = jvm, path.rstrip("/"), jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    def _read(self, name: str) -> str | None:
        p = self._path(f"{self.path}/{name}")
        if not self._fs.exists(p):
            return None
        stream = self._fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, content: dict) -> str:
        """Write once; the digest of the canonical JSON.  The same content again is no error."""
        text = json.dumps(content, sort_keys=True, separators=(",", ":"))
        held = self._read(name)
        if held is None and not self._create(name, text):  # another writer was first
            held = self._read(name)
        if held is not None and held != text:
            raise ArtifactConflict(name)
        return hashlib.sha256(text.encode()).hexdigest()

    def _create(self, name: str, text: str) -> bool:
        """Write aside and rename without replacing: readers see all of it or nothing, and one writer wins."""
        aside, target = self._path(f"{self.path}/aside-{uuid.uuid4().hex}"), self._path(f"{self.path}/{name}")
        out = self._fs.create(aside, False)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.mkdirs(target.getParent())
        try:
            self._context.rename(aside, target, self._plain)
        except Exception as failed:
            self._fs.delete(aside, False)
            if "FileAlreadyExistsException" not in str(failed):
                raise
            return False
        return True

    def get(self, name: str) -> dict | None:
        held = self._read(name)
        return None if held is None else json.loads(held)

    def complete(self, route: str, window: int, digest: str) -> bool:
        """Mark a window of a route complete; False if it is or a later one is.  Another digest for the same window is an error."""
        last = self.get(f"marker-{route}-{window}.json")
        if last is not None:
            if last["digest"] != digest:
                raise ArtifactConflict(f"window {window} of {route}")
            return False
        root = self._path(self.path)
        names = [s.getPath().getName() for s in self._fs.listStatus(root)] if self._fs.exists(root) else []
        done = [int(n.rsplit("-", 1)[1][:-5]) for n in names if n.startswith(f"marker-{route}-")]
        if done and max(done) > window:
            return False
        self.put(f"marker-{route}-{window}.json", {"window": window, "digest": digest})
        return True
