"""Numbered publications: a version is one small file that only one writer can create.

A folder holds ``v<number>.json`` files, each a record. Publishing creates the file of the next number and
fails if somebody else created it first, so versions have one order that no clock decides, and of two
writers that start from the same version only one wins. Readers see a record whole or not at all.
"""

from __future__ import annotations

import json
import os
import posixpath
import re
import uuid

from pyspark.sql import SparkSession

NAME = "v{:020d}.json"
_NUMBER = re.compile(r"^v([0-9]{20})\.json$")


class VersionConflict(RuntimeError):
    """Another writer published first."""


def _link(path: str, payload: bytes) -> bool:
    """A hard link to a finished file is atomic and refuses an existing name."""
    os.makedirs(posixpath.dirname(path), exist_ok=True)
    own = f"{posixpath.dirname(path)}/.{uuid.uuid4().hex}"
    with open(own, "wb") as out:
        out.write(payload)
    try:
        os.link(own, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(own)


def _rename(spark: SparkSession, uri: str, payload: bytes) -> bool:
    """On a Hadoop file system: a finished file renamed with the option that refuses an existing name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(uri)
    own = jvm.org.apache.hadoop.fs.Path(path.getParent(), "." + uuid.uuid4().hex)
    out = own.getFileSystem(conf).create(own, False)
    out.write(bytearray(payload))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), conf)
    try:
        context.rename(own, path, options)
        return True
    except Exception as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        own.getFileSystem(conf).delete(own, False)
        return False


def put_if_absent(spark: SparkSession, uri: str, payload: bytes) -> bool:
    """Create a file with this content unless it exists; whether it was created."""
    from pyarrow import fs as pafs

    from ledgerline.sinks.archives import filesystem

    fs, path = filesystem(uri)
    return _link(path, payload) if isinstance(fs, pafs.LocalFileSystem) else _rename(spark, uri, payload)


def versions(folder: str) -> list[tuple[int, dict]]:
    """Number and record of every version, oldest first (one listing of a folder of small files)."""
    from pyarrow import fs as pafs

    from ledgerline.sinks.archives import filesystem

    fs, base = filesystem(folder.rstrip("/"))
    found = []
    for info in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
        number = _NUMBER.match(info.base_name)
        if number:
            with fs.open_input_stream(info.path) as f:
                found.append((int(number[1]), json.loads(f.read())))
    return sorted(found, key=lambda v: v[0])


def newest(folder: str) -> tuple[int, dict | None]:
    """The newest version and its record; (0, None) if nothing is published."""
    from pyarrow import fs as pafs

    from ledgerline.sinks.archives import filesystem

    fs, base = filesystem(folder.rstrip("/"))
    names = [i.base_name for i in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))]
    number = max((int(m[1]) for m in map(_NUMBER.match, names) if m), default=0)
    if not number:
        return 0, None
    with fs.open_input_stream(f"{base}/{NAME.format(number)}") as f:
        return number, json.loads(f.read())


def publish(spark: SparkSession, folder: str, record: dict, after: int | None = None) -> int:
    """Publish a record and return its number. ``after``: the version that the record was made from; if
    another one has come since, nothing is published and ``VersionConflict`` is raised. Without it the
    record takes the next free number."""
    number = newest(folder)[0] if after is None else after
    while True:
        number += 1
        if put_if_absent(spark, f"{folder.rstrip('/')}/{NAME.format(number)}", json.dumps(record).encode()):
            return number
        if after is not None:
            raise VersionConflict(f"version {number} of {folder} is taken")
