"""Tables that are replaced in one step: a folder for each version and a log of commits.

A version is written to a folder of its own. It becomes the table when its commit, a small file named for its
number, is moved into the log, which either happens or does not. Until then readers see the version before; a
write that fails leaves no commit, so it changes nothing. Readers that have planned a query go on reading the
folder they found, which stays until ``vacuum`` is told otherwise.

Layout: ``root/_commits/0000000007`` (JSON: folder and facts of the writer) and ``root/v-0000000007-<random>/``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flightlake.sources.windows import _list, _path

LOG = "_commits"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    facts: dict


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def history(spark: SparkSession, root: str) -> list[Version]:
    """Committed versions, oldest first."""
    root = root.rstrip("/")
    found = []
    for name in sorted(n for n in _list(spark, f"{root}/{LOG}") if n.isdigit()):
        entry = json.loads(_read_text(spark, f"{root}/{LOG}/{name}"))
        found.append(Version(int(name), f"{root}/{entry['folder']}", entry["facts"]))
    return found


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest committed version; None if there is none."""
    names = sorted(n for n in _list(spark, f"{root.rstrip('/')}/{LOG}") if n.isdigit())
    if not names:
        return None
    entry = json.loads(_read_text(spark, f"{root.rstrip('/')}/{LOG}/{names[-1]}"))
    return Version(int(names[-1]), f"{root.rstrip('/')}/{entry['folder']}", entry["facts"])


def begin(spark: SparkSession, root: str) -> Version:
    """The next version, not committed: a number and a fresh folder to write to."""
    last = current(spark, root)
    number = last.number + 1 if last else 1
    return Version(number, f"{root.rstrip('/')}/v-{number:010d}-{uuid.uuid4().hex[:12]}", {})


def commit(spark: SparkSession, root: str, version: Version, **facts) -> Version:
    """Make ``version`` the table. An error if another writer has committed this number meanwhile."""
    root, jvm = root.rstrip("/"), spark.sparkContext._jvm
    fs, log = _path(spark, f"{root}/{LOG}")
    fs.mkdirs(log)
    entry = json.dumps({"folder": version.folder.rsplit("/", 1)[1], "facts": facts}).encode()
    draft = jvm.org.apache.hadoop.fs.Path(log, f"_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(entry)
    out.close()
    to = jvm.org.apache.hadoop.fs.Path(log, f"{version.number:010d}")
    # Without an option a rename fails if the target exists; the file appears whole or not at all.
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(to), options)
    except Exception as e:
        fs.delete(draft, False)
        raise RuntimeError(f"version {version.number} of {root} was not committed") from e
    return Version(version.number, version.folder, facts)


def replace_table(df: DataFrame, root: str, **facts) -> Version:
    """Write ``df`` as the new version of the table and commit it."""
    spark = df.sparkSession
    version = begin(spark, root)
    df.write.parquet(version.folder)
    return commit(spark, root, version, **facts)


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version."""
    version = current(spark, root)
    if version is None:
        raise ValueError(f"no table at {root}")
    return spark.read.parquet(version.folder)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove the folders of all but the ``keep`` newest versions, and of writes that were given up: folders
    numbered no higher than the newest version that no kept commit names. Returns how many went."""
    root = root.rstrip("/")
    versions = history(spark, root)
    if not versions:
        return 0
    kept = {v.folder.rsplit("/", 1)[1] for v in versions[-max(keep, 1):]}
    gone = [n for n in _list(spark, root) if n.startswith("v-") and n not in kept and int(n.split("-")[1]) <= versions[-1].number]
    for name in gone:
        fs, path = _path(spark, f"{root}/{name}")
        fs.delete(path, True)
    for v in versions[: -max(keep, 1)]:
        fs, path = _path(spark, f"{root}/{LOG}/{v.number:010d}")
        fs.delete(path, False)
    return len(gone)
