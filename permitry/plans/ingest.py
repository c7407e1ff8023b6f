"""Yearly snapshot files to one snapshot table."""

from permitry.sources.archives import read_zipped_snapshots
from permitry.sources.members import read_zip_members
from permitry.sources.readers import read_yearly_snapshots, typed_snapshots


def ingest(spark, folder, default_year, zipped=True, whole_archives=False, **options):
    """Snapshots of all years from a folder of zip archives or of CSV files.

    Archives are read member by member; ``whole_archives`` reads each as one row through Spark, for file systems that
    only Spark opens.
    """
    read = (read_zipped_snapshots if whole_archives else read_zip_members) if zipped else read_yearly_snapshots
    return typed_snapshots(read(spark, folder, default_year, **options))
