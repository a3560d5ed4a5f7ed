"""Landing data as a sequence of files in time order (a test/replay helper).

File streams pick up files by modification time. The rows are range-partitioned on the order
columns into at least ``min_chunks`` slices of at most ``max_chunk_rows`` rows (Spark samples the
keys, so slices are balanced), each slice is written by its own task as one file, and the files
are then stamped with ascending modification times (Hadoop FileSystem ``setTimes``, a metadata
call) in slice order. One write job, no driver loop over data.

A stream takes the files in micro-batches, and each of these sends the results of all its tasks to the
driver whatever its size. A slice is therefore as large as one task sorts with ease: slices for a few
thousand rows would make the driver's part as large as the data's.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame

MAX_CHUNK_ROWS = 1_000_000


def land_in_order(df: DataFrame, root: str, order: Sequence[str], min_chunks: int = 4,
                  max_chunk_rows: int = MAX_CHUNK_ROWS) -> int:
    """Write ``df`` into ``root`` as time-ordered files, stamped later than any file already
    there (so a later landing is a later arrival). Returns the number of files written."""
    spark = df.sparkSession
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def parts():
        if not fs.exists(path):
            return {}
        return {str(s.getPath().getName()): s for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")}

    before = parts()
    total = df.count()
    n = max(1, min_chunks, -(-total // max_chunk_rows))
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .write.mode("append").option("maxRecordsPerFile", 0).parquet(root))
    new = sorted((name, st.getPath()) for name, st in parts().items() if name not in before)
    latest = max((st.getModificationTime() for st in before.values()), default=None)
    start = latest if latest is not None else int(time.time() * 1000) - 1000 * (len(new) + 1)
    for i, (_, p) in enumerate(new):  # names carry the slice index: slice i holds the i-th range
        fs.setTimes(p, start + 1000 * (i + 1), -1)
    return len(new)
