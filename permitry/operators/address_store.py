"""The address cache as a base in key buckets and small deltas: an update writes what it changes.

A store is a folder. ``data/`` holds Parquet tables that are never changed: the base, dealt into buckets by a hash of the
keys, and one delta for each update. ``versions/`` holds one small file a version that names the tables it consists of.
A version's file is created exclusively, so of two writers that start from one version the second fails and leaves
nothing visible behind; this needs a file system with exclusive creation (HDFS, ABFS, local). A file without content is a
version that is being written or whose writer was lost: reading goes on with the version before, writing stops until the
file is deleted. Tables of old versions stay for their readers.

Each address has one row; of several deltas the last one counts. Compaction rewrites the buckets that deltas touch.
"""

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from permitry.operators.address import address_keys, one_per_key
from permitry.schemas import ADDRESS_KEYS, address_cache

BUCKETS = 256
#: Deltas that a version may hold before the next update compacts them.
DELTAS = 16


class VersionConflict(RuntimeError):
    """Somebody else wrote, or is writing, the version that follows the one an update started from."""


class AddressStore:
    def __init__(self, spark, path, keys=ADDRESS_KEYS, deltas=DELTAS):
        self.spark, self.path, self.keys, self.deltas = spark, path.rstrip("/"), list(keys), deltas
        self.schema = address_cache(keys)
        self._files = self._place("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _place(self, inside):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{inside}")

    def _names(self, inside):
        place = self._place(inside)
        return [one.getPath().getName() for one in self._files.listStatus(place)] if self._files.exists(place) else []

    def versions(self):
        """Numbers of all versions, also of one that is being written."""
        return sorted(int(name) for name in self._names("versions") if name.isdigit())

    def _state(self, version):
        raw = self._files.open(self._place(f"versions/{version}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(raw, "UTF-8")
        finally:
            raw.close()
        return json.loads(text) if text else None

    def _latest(self):
        """Number and tables of the last complete version; 0 and an empty store if there is none."""
        for version in reversed(self.versions()):
            if state := self._state(version):
                return version, state
        return 0, None

    def _claim(self, version, state):
        try:
            out = self._files.create(self._place(f"versions/{version}"), False)
        except Py4JJavaError as error:
            raise VersionConflict(f"version {version} of {self.path} is already there") from error
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        return version

    def _bucket(self, buckets):
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def _rows(self, paths):
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _base(self, state, only=None):
        wanted = [(b, table) for b, table in state["base"].items() if only is None or int(b) in only]
        return self._rows([f"{self.path}/data/{table}/bucket={b}" for b, table in wanted])

    def _changes(self, state):
        """The last delta's row of every changed address."""
        changed = None
        for place, table in enumerate(state["deltas"]):
            rows = self._rows([f"{self.path}/data/{table}"]).withColumn("__place", F.lit(place))
            changed = rows if changed is None else changed.unionByName(rows)
        cells = [c for c in self.schema.names if c not in self.keys]
        last = changed.groupBy(*self.keys).agg(F.max_by(F.struct(*cells), "__place").alias("__last"))
        return last.select(*self.keys, "__last.*").select(*self.schema.names)

    def _with(self, base, changes):
        return base.join(changes.select(*self.keys), self.keys, "left_anti").select(*self.schema.names).unionByName(changes)

    def _write_buckets(self, rows, buckets):
        """Bucket numbers and the table they were written to, a file for each bucket."""
        table = uuid.uuid4().hex
        rows.withColumn("bucket", self._bucket(buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{table}")
        return {name.removeprefix("bucket="): table for name in self._names(f"data/{table}") if name.startswith("bucket=")}

    def create(self, cache, buckets=BUCKETS):
        """First version from a cache table, one row for each address; ``buckets`` stays with the store."""
        base = self._write_buckets(one_per_key(address_keys(cache, self.keys), self.keys), buckets)
        return self._claim(1, {"buckets": buckets, "base": base, "deltas": []})

    def read(self, version=None):
        """The cache at a version, by default the last one. Only the keys of the deltas are compared with the base."""
        state = self._state(version) if version else self._latest()[1]
        if not state:
            raise FileNotFoundError(f"no complete version {version or ''} in {self.path}")
        return self._with(self._base(state), self._changes(state)) if state["deltas"] else self._base(state)

    def _update(self, rows_from):
        """Write the rows made from the last version as its next version's delta."""
        version, state = self._latest()
        if not state:
            raise FileNotFoundError(f"no complete version in {self.path}")
        if len(state["deltas"]) >= self.deltas:
            version, state = self.compact(), self._latest()[1]
        table = uuid.uuid4().hex
        rows_from(self.read(version)).select(*self.schema.names).write.parquet(f"{self.path}/data/{table}")
        return self._claim(version + 1, {**state, "deltas": [*state["deltas"], table]})

    def insert(self, addresses, mode="keep"):
        """Add addresses as pending; known ones are kept, or with ``replace`` start over. Returns the new version."""
        if mode not in ("keep", "replace"):
            raise ValueError(f"unknown mode {mode!r}")
        asked = address_keys(addresses, self.keys).select(*self.keys).distinct()
        unknown = F.lit(None).cast("double")

        def pending(cache):
            new = asked.join(cache.select(*self.keys), self.keys, "left_anti") if mode == "keep" else asked
            return new.select(F.lit(False).alias("IsUpdated"), *self.keys, unknown.alias("Latitude"), unknown.alias("Longitude"))

        return self._update(pending)

    def apply(self, results):
        """Write geocodes of addresses that the cache has and mark them done. Returns the new version."""
        done = one_per_key(address_keys(results, self.keys).withColumn("IsUpdated", F.lit(True)), self.keys)
        return self._update(lambda cache: done.join(cache.select(*self.keys), self.keys, "left_semi"))

    def compact(self):
        """Merge the deltas into the base buckets they touch; the other buckets stay as written. Returns the new version."""
        version, state = self._latest()
        if not state or not state["deltas"]:
            return version
        changes = self._changes(state)
        touched = {row[0] for row in changes.select(self._bucket(state["buckets"])).distinct().collect()}
        merged = self._with(self._base(state, touched), changes)
        return self._claim(version + 1, {**state, "base": state["base"] | self._write_buckets(merged, state["buckets"]), "deltas": []})
