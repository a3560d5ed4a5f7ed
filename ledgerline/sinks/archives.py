"""Tar archive sink: a Python data source whose tasks each stream their archives to a folder of their
own attempt; the job commit writes a manifest of them and moves no file.

Input rows: ``archive`` (path of the archive relative to the target folder), ``member`` (member
name), ``content`` (string or binary; null for an explicit directory entry) and optional ``mtime``
(epoch seconds). A row without a member names its archive only: the archive is written even if nothing
else is in it, and the manifest counts such rows (the companies that a batch lists).
Rows must arrive clustered by archive and sorted by member
(``repartition(archive).sortWithinPartitions(archive, member)``): an archive is written in one
pass with constant memory. Parent directories of each file are added as directory members (as a
recursive add would), once per archive. Member order, mode, owner and mtime are fixed, so an
archive is byte-for-byte reproducible and a retried task writes the same bytes.

Files go through ``pyarrow.fs``, so the target may be any file system the Python workers can
reach (local/NFS mount, HDFS, object store). See ``ledgerline.sinks.manifest`` for the layout and for what
readers see; commit and abort remove the folders of attempts that do not count.
"""

from __future__ import annotations

import datetime
import functools
import posixpath
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ledgerline.sinks.manifest import job_folder, publish, write_entries

FORMAT = "ledgerline_tar"
DIR_MODE = 0o755
FILE_MODE = 0o644
WRITER_TASK_BYTES = 512 << 20  # content bytes per writer task
WRITE_ROWS = 256               # rows that are Python objects at a time
WRITE_BUFFER = 1 << 20         # bytes gathered before they go to the file
_ZEROS = bytes(tarfile.BLOCKSIZE)


def filesystem(uri: str):
    """(pyarrow file system, path) for a URI or plain path."""
    from pyarrow import fs as pafs

    if uri.startswith("file:"):
        path = uri[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return pafs.LocalFileSystem(), path
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


@dataclass
class ArchiveCommit(WriterCommitMessage):
    attempt: str = ""
    entries: list = field(default_factory=list)  # manifest rows of the attempt's archives


def _pieces(batch):
    """A batch in slices of a few rows, as only these become Python objects: a whole batch of long texts is large."""
    for at in range(0, batch.num_rows, WRITE_ROWS):
        yield batch.slice(at, WRITE_ROWS)


def _tobuf(name, kind, mode, mtime, size):
    info = tarfile.TarInfo(name)
    info.type, info.mode, info.mtime, info.size = kind, mode, mtime, size
    return info.tobuf(tarfile.PAX_FORMAT, "utf-8", "surrogateescape")


def byte_sum(block):
    """The sum of up to 256 bytes, which the low half of their Adler-32 holds (plus one): several times as fast as ``sum``."""
    return (zlib.adler32(block) & 0xFFFF) - 1


@functools.cache
def _form(kind, mode):
    """The header of a member without name, size and time: what lies between the fields, and its sum of bytes."""
    h = _tobuf("", kind, mode, 0, 0)
    between, after = h[100:124], h[156:]
    return between, after, sum(between) + 8 * ord(" ") + sum(after)


def _header(name, kind, mode, mtime, size):
    """The header as ``tarfile`` makes it. Usual ones (short ASCII names, numbers that fit) are filled into a
    form: most members are directories and small files, and their headers would be most of the work."""
    plain = name + "/" if kind == tarfile.DIRTYPE and not name.endswith("/") else name
    if not (plain.isascii() and len(plain) <= tarfile.LENGTH_NAME and 0 <= mtime < 8 ** 11 and 0 <= size < 8 ** 11):
        return _tobuf(name, kind, mode, mtime, size)
    between, after, total = _form(kind, mode)
    plain, numbers = plain.encode("ascii"), b"%011o\0%011o\0" % (size, mtime)
    return b"%b%b%b%06o\0 %b" % (plain.ljust(tarfile.LENGTH_NAME, b"\0"), between, numbers, total + byte_sum(plain + numbers), after)


class _Archive:
    """One archive being written. Headers come from ``tarfile``; its writer is not used, as it keeps every member
    that it has written. What is kept here are the directories that a later member may still be under."""

    def __init__(self, fs, path, name, file):
        fs.create_dir(posixpath.dirname(path), recursive=True)
        self.out = fs.open_output_stream(path, buffer_size=WRITE_BUFFER)
        self.name, self.file = name, file
        self.bytes = self.members = self.files = self.content = self.listed = self.companies = 0
        self.company, self.dirs, self.folder = None, set(), None
        self.blocks, self.held = [], 0

    def _flush(self):
        self.out.write(b"".join(self.blocks))
        self.bytes += self.held
        self.blocks, self.held = [], 0

    def _add(self, name, kind, mode, mtime, data=b""):
        size = len(data)
        header, fill = _header(name, kind, mode, mtime, size), -size % tarfile.BLOCKSIZE
        self.blocks += (header, data, _ZEROS[:fill]) if size else (header,)
        self.held += len(header) + size + fill
        self.members += 1
        if self.held >= WRITE_BUFFER:
            self._flush()

    def add_dir(self, name, mtime):
        if name not in self.dirs:
            self._add(name, tarfile.DIRTYPE, DIR_MODE, mtime)
            self.dirs.add(name)

    def add_parents(self, member, depth, mtime):
        """The company of a member and the directories above it that are not there yet. Members come sorted, so
        that nothing below ``d/`` follows a member from ``d0`` on ('0' is the character after '/'): ``d`` is let go.
        A member right behind one of the same folder has both."""
        folder, _, last = member.rpartition("/")
        if last and folder == self.folder:
            return
        parts = member.strip("/").split("/")
        name = "/".join(parts[:1 + depth])
        if name != self.company:  # members are sorted: a company's are neighbours
            self.company = name
            self.companies += 1
        self.dirs = {d for d in self.dirs if member < d + "0"}
        if len(parts) > 1 + depth:
            self.add_dir(name, mtime)
            for part in parts[1 + depth:-1]:
                name = f"{name}/{part}"
                self.add_dir(name, mtime)
        # a member that is its own company says nothing of the next one
        self.folder = folder if last and len(parts) > 1 + depth else None

    def add_file(self, name, mtime, data):
        self._add(name, tarfile.REGTYPE, FILE_MODE, mtime, data)
        self.files += 1
        self.content += len(data)

    def close(self):
        """Ends the archive (two zero blocks, filled up to a whole record); returns its manifest row."""
        self._flush()
        end = 2 * tarfile.BLOCKSIZE
        end += -(self.bytes + end) % tarfile.RECORDSIZE
        self.out.write(b"\0" * end)
        self.out.close()
        now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        return (self.name, self.file, self.bytes + end, self.members, self.files, self.content, self.companies,
                self.listed, now)


class TarArchiveWriter(DataSourceArrowWriter):
    def __init__(self, options, job_id: str):
        self.root = options.get("path").rstrip("/")
        self.job_id = options.get("job") or job_id
        # leading path segments that are not added as directory members (the staging root)
        self.root_depth = int(options.get("root_depth", "1"))

    def _open(self, fs, base, attempt, name):
        below = posixpath.join(attempt, name)
        return _Archive(fs, posixpath.join(job_folder(base, self.job_id), below), name,
                        posixpath.join(job_folder(self.root, self.job_id), below))

    def write(self, iterator: Iterator) -> ArchiveCommit:
        from pyspark import TaskContext

        ctx = TaskContext.get()
        attempt = f"{ctx.partitionId()}-{ctx.attemptNumber()}-{uuid.uuid4().hex[:8]}" if ctx else uuid.uuid4().hex[:8]
        fs, base = filesystem(self.root)
        entries, cur, name_now = [], None, None
        try:
            for batch in iterator:
                cols = batch.schema.names
                for piece in _pieces(batch):
                    archive = piece.column(cols.index("archive")).to_pylist()
                    member = piece.column(cols.index("member")).to_pylist()
                    content = piece.column(cols.index("content")).to_pylist()
                    mtimes = piece.column(cols.index("mtime")).to_pylist() if "mtime" in cols else [0] * len(archive)
                    for a, m, c, t in zip(archive, member, content, mtimes):
                        if a != name_now:
                            if cur is not None:
                                entries.append(cur.close())
                            cur, name_now = self._open(fs, base, attempt, a), a
                        if m is None:
                            cur.listed += 1
                            continue
                        t = int(t or 0)
                        cur.add_parents(m, self.root_depth, t)
                        if c is None:
                            cur.add_dir(m.strip("/"), t)
                            continue
                        cur.add_file(m, t, c.encode("utf-8") if isinstance(c, str) else bytes(c))
            if cur is not None:
                entries.append(cur.close())
                cur = None
        except BaseException:
            if cur is not None:
                cur.out.close()
            own = posixpath.join(job_folder(base, self.job_id), attempt)
            if cur is not None or entries:
                fs.delete_dir(own)
            raise
        return ArchiveCommit(attempt, entries)

    def commit(self, messages) -> None:
        """Write the manifest of the attempts that count; the folders of all others go."""
        from pyarrow import fs as pafs

        fs, base = filesystem(self.root)
        done = [m for m in messages if m]
        write_entries(fs, base, self.job_id, [e for m in done for e in m.entries])
        keep = {m.attempt for m in done if m.entries}
        for info in fs.get_file_info(pafs.FileSelector(job_folder(base, self.job_id), allow_not_found=True)):
            if info.base_name not in keep:
                fs.delete_dir(info.path)

    def abort(self, messages) -> None:
        from pyarrow import fs as pafs

        fs, base = filesystem(self.root)
        own = job_folder(base, self.job_id)
        if fs.get_file_info(own).type == pafs.FileType.Directory:
            fs.delete_dir(own)


class TarArchiveSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        return TarArchiveWriter(self.options, uuid.uuid4().hex[:12])


def register(spark) -> None:
    from ledgerline.session import ship_package

    ship_package(spark)
    spark.dataSource.register(TarArchiveSource)


def write_archives(df, root: str, archive: str = "archive", member: str = "member", content: str = "content",
                   mtime: str | None = "mtime", num_partitions: int | None = None, root_depth: int = 1) -> str:
    """Pack rows into tar archives under ``root``: one archive per distinct ``archive`` value. Nothing is
    visible until the job's manifest is published, at the end; returns the job's id.

    The rows are clustered by archive (one shuffle) and sorted by member inside each task; the
    content column is carried through that shuffle only once, when writing.
    """
    from pyspark.sql import functions as F

    register(df.sparkSession)
    # as bytes: text would be decoded for Python and encoded again for the file
    cols = [F.col(archive).alias("archive"), F.col(member).alias("member"), F.col(content).cast("binary").alias("content")]
    cols.append((F.col(mtime) if mtime else F.lit(0)).cast("bigint").alias("mtime"))
    rows = df.select(*cols)
    # explicit count (AQE would coalesce a by-column repartition into a few large writer tasks),
    # sized from the measured content bytes (one narrow aggregate, no shuffle) so a writer task
    # handles a bounded share of the data
    from ledgerline.session import partitions_for_size

    if num_partitions:
        n = num_partitions
    else:
        total = rows.select(F.sum(F.octet_length("content"))).first()[0]
        n = partitions_for_size(df.sparkSession, total, WRITER_TASK_BYTES)
    rows = rows.repartition(n, "archive")
    job = uuid.uuid4().hex[:12]
    (rows.sortWithinPartitions("archive", "member").write.format(FORMAT).mode("append")
     .option("root_depth", str(root_depth)).option("job", job).save(root))
    publish(df.sparkSession, root, job)
    return job


class FileTreeWriter(DataSourceArrowWriter):
    """Writes each row's content as its own file at ``root/member`` (the staged-tree layout).
    A retried task rewrites the same bytes to the same paths, so the result is idempotent."""

    def __init__(self, options):
        self.root = options.get("path").rstrip("/")

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        import os

        fs, base = filesystem(self.root)
        local = type(fs).__name__ == "LocalFileSystem"
        made = None
        for batch in iterator:
            cols = batch.schema.names
            for piece in _pieces(batch):
                member = piece.column(cols.index("member")).to_pylist()
                content = piece.column(cols.index("content")).to_pylist()
                mtimes = piece.column(cols.index("mtime")).to_pylist() if "mtime" in cols else [None] * len(member)
                for m, c, t in zip(member, content, mtimes):
                    path = posixpath.join(base, m)
                    parent = posixpath.dirname(path)
                    if parent != made:
                        fs.create_dir(parent, recursive=True)
                        made = parent
                    data = c.encode("utf-8") if isinstance(c, str) else bytes(c or b"")
                    with fs.open_output_stream(path) as out:
                        out.write(data)
                    if local and t is not None:
                        os.utime(path, (int(t), int(t)))
        return WriterCommitMessage()


class FileTreeSource(DataSource):
    @classmethod
    def name(cls):
        return "ledgerline_files"

    def writer(self, schema, overwrite):
        return FileTreeWriter(self.options)


def write_tree(df, root: str, member: str = "member", content: str = "content", mtime: str | None = "mtime") -> None:
    """Write one file per row under ``root`` (no shuffle: each task writes the rows it holds)."""
    from pyspark.sql import functions as F

    from ledgerline.session import ship_package

    ship_package(df.sparkSession)
    df.sparkSession.dataSource.register(FileTreeSource)
    cols = [F.col(member).alias("member"), F.col(content).cast("binary").alias("content"),
            (F.col(mtime) if mtime else F.lit(None)).cast("bigint").alias("mtime")]
    df.select(*cols).write.format("ledgerline_files").mode("append").save(root)


def _remove_folders(batches):
    import pyarrow as pa
    from pyarrow import fs as pafs

    for batch in batches:
        for folder in batch.column(0).to_pylist():
            fs, path = filesystem(folder)
            if fs.get_file_info(path).type == pafs.FileType.Directory:  # a retried task finds some gone
                fs.delete_dir(path)
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["removed"])


def remove_tree(spark, root: str) -> None:
    """Remove a tree that was written to be read once. Its folders go by tasks, as they were written."""
    from pyarrow import fs as pafs

    from ledgerline.session import ship_package

    ship_package(spark)
    fs, base = filesystem(root)
    scheme = root[:len(root) - len(base)] if root.endswith(base) else ""
    folders = [(scheme + i.path,) for i in fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
               if i.type == pafs.FileType.Directory]
    if folders:
        n = min(len(folders), spark.sparkContext.defaultParallelism * 4)
        dirs = spark.createDataFrame(folders, "folder string").repartition(n, "folder")
        dirs.mapInArrow(_remove_folders, "removed bigint").agg({"removed": "sum"}).collect()
    if fs.get_file_info(base).type == pafs.FileType.Directory:
        fs.delete_dir(base)
