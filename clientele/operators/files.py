"""Small control files on whatever file system a path lives on."""

import os
import uuid

from pyspark.sql import SparkSession

#: How a file is published by scheme, each a step that fails where the name is taken. Another scheme
#: can be named by the setting `spark.clientele.publish.SCHEME`.
#: link: a hard link; rename: the file system's rename that never replaces; create: a create that never
#: replaces, whose content appears when it is closed; conditional: the same, where it must be asked for.
PUBLISH = {
    "file": "link",
    "hdfs": "rename",
    "abfs": "rename",
    "abfss": "rename",
    "gs": "create",
    "s3a": "conditional",
}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; empty when the folder is absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder; 0 when it is absent."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else 0


def copy_start(spark: SparkSession, folder: str, to: str, share: float) -> None:
    """The first part of each data file of a folder, as a transfer that broke off leaves it."""
    fs, p = _fs(spark, folder)
    api = spark._jvm
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        source, target = fs.open(status.getPath()), fs.create(api.org.apache.hadoop.fs.Path(f"{to}/{name}"), False)
        try:
            target.write(source.readNBytes(int(status.getLen() * share)))
        finally:
            source.close()
            target.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _write(stream, text: str) -> None:
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def publish_local(path: str, text: str) -> None:
    """`write_text` on a local path: a hard link appears whole and never replaces."""
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    hidden = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with open(hidden, "x", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(hidden, path)
    finally:
        os.remove(hidden)


def _renamed(spark: SparkSession, fs, p, text: str) -> None:
    """A file of its own, then a rename that the file system refuses if the name is taken."""
    fs_api = spark._jvm.org.apache.hadoop.fs
    hidden = fs_api.Path(p.getParent(), f"_{p.getName()}.{uuid.uuid4().hex}")
    _write(fs.create(hidden, False), text)
    never = spark._sc._gateway.new_array(getattr(fs_api, "Options$Rename"), 1)
    never[0] = getattr(fs_api, "Options$Rename").NONE
    context = fs_api.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(hidden, p, never)
    finally:
        fs.delete(hidden, False)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Publish a file: readers see all of it or nothing, and of several writers one succeeds.

    Writers may be in different processes and on different machines. A taken name is a
    FileExistsError. On a file system not known to have such a step nothing is written: a check
    before a rename would lose one of two files.
    """
    fs, p = _fs(spark, path)
    p = fs.makeQualified(p)
    if fs.getScheme() == "viewfs":  # a view of other file systems
        fs.mkdirs(p.getParent())
        p = spark._jvm.org.apache.hadoop.fs.Path(fs.resolvePath(p.getParent()), p.getName())
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    scheme = p.toUri().getScheme()
    how = spark.conf.get(f"spark.clientele.publish.{scheme}", PUBLISH.get(scheme))
    if how == "link":
        publish_local(p.toUri().getPath(), text)
        return
    if how not in ("rename", "create", "conditional"):
        raise ValueError(
            f"no safe way to publish on {scheme}: set spark.clientele.publish.{scheme} to rename, create or "
            "conditional, whichever never replaces a file there"
        )
    try:
        if how == "rename":
            fs.mkdirs(p.getParent())
            _renamed(spark, fs, p, text)
        elif how == "create":
            _write(fs.create(p, False), text)
        else:
            builder = fs.createFile(p).overwrite(False).recursive()
            _write(builder.must("fs.option.create.conditional.overwrite", "true").build(), text)
    except Exception as e:
        # also where the answer got lost: the file tells whose it is
        if not fs.exists(p):
            raise
        if read_text(spark, path) != text:
            raise FileExistsError(f"{path} is there already") from e
