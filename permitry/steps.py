"""Steps of a job whose tables outlive it: a job that was stopped goes on behind its last finished step."""

import hashlib
import json
import uuid

from pyspark.sql import functions as F

from permitry.session import cut


def fresh(name, make):
    """A step that is not kept: written once, deleted when the application ends."""
    return cut(make())


def state_of(spark, path):
    """Number, bytes and a digest of the files of an input, from their names, sizes and times. No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    own = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.agg(F.count("*"), F.sum("length"), F.sum(own)).first()
    return [str(value) for value in row]


class Steps:
    """Steps of one job over ``inputs`` (paths) with ``parameters``, kept below ``folder``.

    A step's table is found again if name, parameters and the files of all inputs are as they were. It counts as
    finished by a mark that is moved into place when its table is complete; what a stopped job has left behind
    without a mark is never read. If two jobs make the same step, one mark stays, and both go on from a whole table.
    Tables are not deleted. Take a new folder after a change of the code that changes results.
    """

    def __init__(self, spark, folder, inputs, **parameters):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.of = [parameters, [state_of(spark, path) for path in inputs]]

    def _path(self, name):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def __call__(self, name, make):
        """The table of a step; ``make`` gives it and is only called if no finished one is there."""
        key = hashlib.sha256(json.dumps([name, *self.of], sort_keys=True).encode()).hexdigest()[:24]
        place = f"{self.folder}/{name}-{key}"
        mark, files = self._path(f"{place}/_finished")
        if not files.exists(mark):
            attempt = uuid.uuid4().hex
            make().write.parquet(f"{place}/{attempt}")
            note, _ = self._path(f"{place}/_{attempt}")
            out = files.create(note, False)
            out.write(attempt.encode())
            out.close()
            files.rename(note, mark)
        stream = files.open(mark)
        attempt = bytes(stream.readAllBytes()).decode()
        stream.close()
        return self.spark.read.parquet(f"{place}/{attempt}")
